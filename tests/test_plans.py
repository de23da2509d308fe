"""Plan equivalences and plan shapes."""

import re

from pyspark.sql import functions as F

from sample_data import SMALL_SF
from vigilo.operators import alerts as al
from vigilo.operators import enrich, kpis
from vigilo.plans import catalog
from vigilo.sources import reference_tables as ref
from vigilo.sources import testdata as td


def _rows(df):
    cols = sorted(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def _both(spark, patients):
    s, c = td.signals(spark, SMALL_SF), td.sensors(spark, SMALL_SF)
    first = kpis.all_kpis(kpis.patient_day_stats_from_sources(s, c, patients, aggregate_first=False))
    agg_first = kpis.all_kpis(kpis.patient_day_stats_from_sources(s, c, patients))
    return first, agg_first


def test_aggregate_first_equals_join_first(spark):
    a, b = _both(spark, td.patients(spark, SMALL_SF))
    assert a.count() > 0
    assert _rows(a) == _rows(b)


def test_aggregate_first_with_duplicate_patients(spark):
    p = td.patients(spark, SMALL_SF)
    # every patient twice, and one patient id with a second attribute set
    dup = p.unionByName(p).unionByName(
        p.filter(F.col("patient_id") == "PAT0001").withColumn("nom", F.lit("Autre nom")))
    a, b = _both(spark, dup)
    assert _rows(a) == _rows(b)
    r = a.filter(F.col("patient_id") == "PAT0002").select("nb_mesures").collect()
    assert all(x[0] % 2 == 0 for x in r)


def _main_plan(df) -> str:
    """Physical plan text without the subquery branches (lines starting with ':')."""
    text = df._jdf.queryExecution().executedPlan().toString()
    return "\n".join(l for l in text.splitlines() if not l.lstrip().startswith(":"))


def test_alert_plans_are_narrow(spark):
    for key in ["alerts_batch", "classify_level", "normalise_patient_id", "vitals_long"]:
        plan = _main_plan(catalog.QUERIES[key](spark, SMALL_SF))
        assert "Exchange" not in plan and "Join" not in plan, (key, plan)


def test_no_cartesian_anywhere(spark):
    for key, q in catalog.QUERIES.items():
        if key.startswith("stream_") or key == "alert_history":
            continue
        text = q(spark, SMALL_SF)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in text and "NestedLoopJoin" not in text, key


def test_kpis_single_aggregation_and_no_self_join(spark):
    df = catalog.QUERIES["dashboard_view"](spark, SMALL_SF)
    text = df._jdf.queryExecution().optimizedPlan().toString()
    # one aggregation of measurements (patient, date) and one of patients; one join
    assert text.count("Aggregate") == 2
    assert text.count("Join Inner") == 2   # sensor join + patient join


def test_rule_row_is_one_row(spark):
    r = spark.range(1).select(al.rules_row(ref.thresholds(spark)).alias("r")).first()["r"]
    assert len(r) == 7 and r["glycemie"]["seuil_warning_min"] == r["glycemie"]["seuil_warning_min"]


def test_literal_rules_equal_table_rules(spark):
    msgs = catalog.messages(spark, SMALL_SF)
    a = al.alerts(msgs, ref.thresholds(spark))
    b = al.alerts(msgs, ref.THRESHOLD_ROWS)
    assert a.count() > 0 and _rows(a) == _rows(b)
    wa = al.with_alerts(msgs, ref.thresholds(spark)).select("mesure_id", "nb_alertes", "niveau_max")
    wb = al.with_alerts(msgs, ref.THRESHOLD_ROWS).select("mesure_id", "nb_alertes", "niveau_max")
    assert _rows(wa) == _rows(wb)


def test_literal_rules_missing_and_duplicate_signal(spark):
    rows = [r for r in ref.THRESHOLD_ROWS if r[0] != "spo2"]
    rows.append(("glycemie", 0.6, 1.2, 0.4, 2.6, "g/L", "dup"))
    msgs = catalog.messages(spark, SMALL_SF)
    tdf = spark.createDataFrame(rows, "signal string, seuil_warning_min float, seuil_warning_max float, "
                                "seuil_critique_min float, seuil_critique_max float, unite string, description string")
    a = al.classify_levels(msgs, tdf)
    b = al.classify_levels(msgs, rows)
    assert _rows(a) == _rows(b)
    assert a.filter("signal = 'spo2' AND niveau <> 'NORMAL'").count() == 0


def test_row_counts_from_stats_equal_explicit_counts(spark):
    st = catalog._stats(spark, SMALL_SF)
    a = kpis.table_row_counts(st)
    b = kpis.table_row_counts(st, catalog._enriched(spark, SMALL_SF))
    assert _rows(a) == _rows(b)


def test_hot_patient_holding_a_third_of_rows(spark):
    """One patient gets every third measurement: both KPI plans still agree, and the
    aggregate-first plan pre-aggregates map-side before its only fact shuffle."""
    s = td.signals(spark, SMALL_SF)
    hot = s.withColumn("patient_id", F.when(F.col("mesure_id").substr(-1, 1).isin("0", "3", "6"),
                                            F.lit("PAT0001")).otherwise(F.col("patient_id")))
    c, p = td.sensors(spark, SMALL_SF), td.patients(spark, SMALL_SF)
    first = kpis.all_kpis(kpis.patient_day_stats(enrich.enriched(hot, c, p)))
    agg_first = kpis.all_kpis(kpis.patient_day_stats_from_sources(hot, c, p))
    assert _rows(first) == _rows(agg_first)
    n_hot = agg_first.filter("patient_id = 'PAT0001'").agg(F.sum("nb_mesures")).first()[0]
    assert n_hot > 0.25 * first.agg(F.sum("nb_mesures")).first()[0]
    plan = agg_first._jdf.queryExecution().executedPlan().toString()
    # partial aggregation sits below the exchange keyed on (patient, day)
    part = plan.index("partial_count")
    exch = plan.index("Exchange hashpartitioning(patient_id")
    assert exch < part


def test_stored_enriched_scan_prunes_and_pushes_down(spark, workdir):
    from vigilo.sources import files
    path = f"{workdir}/enriched"
    files.write_table(catalog._enriched(spark, SMALL_SF), path)
    q = (files.scan_enriched(spark, path).filter(F.col("date_mesure") == "2024-01-05")
         .select("patient_id", "spo2"))
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(date_mesure), EqualTo(date_mesure,2024-01-05)]" in plan
    assert "ReadSchema: struct<patient_id:string,date_mesure:string,spo2:float>" in plan


def test_presentation_orders(spark):
    st = catalog._stats(spark, SMALL_SF)
    k2 = kpis.kpi2_hypertension(st).orderBy(*kpis.presentation_order("kpi2")).collect()
    rates = [r["taux_hypertension_pct"] for r in k2]
    assert rates == sorted(rates, reverse=True)
    summary = al.alert_summary_patient_day(al.to_history(al.alerts(catalog.messages(spark, SMALL_SF),
                                                                   ref.THRESHOLD_ROWS)))
    rows = summary.orderBy(*al.summary_order()).collect()
    keys = [(r["date_alerte"], r["nb_critiques"]) for r in rows]
    assert keys == sorted(keys, key=lambda k: (k[0], k[1]), reverse=True)


def test_aqe_splits_a_hot_patient_in_the_patient_join(spark):
    """Without broadcast (as at cluster scale), the patient join is a sort-merge
    join; a patient holding a third of the measurements is split by AQE into
    several tasks and the result is unchanged."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        sf = "/root/testdata/sf0.01"
        s = td.signals(spark, sf)
        hot = s.withColumn("patient_id", F.when(F.col("mesure_id").substr(-1, 1).isin("0", "3", "6"),
                                                F.lit("PAT0001")).otherwise(F.col("patient_id")))
        e = enrich.enriched(hot, td.sensors(spark, sf), td.patients(spark, sf))
        rows = e.collect()
        plan = e._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in plan
        assert len(rows) == enrich.enriched(s, td.sensors(spark, sf), td.patients(spark, sf)).count()
        assert sum(r["patient_id"] == "PAT0001" for r in rows) > len(rows) / 4
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_hot_patient_spread_in_the_profile_left_join(spark):
    """patient_updates: the profile side comes out of an aggregation, so a join on the
    id alone has no exchange on that side and AQE cannot split a hot patient; the
    salted join gives both sides a shuffle and AQE splits the hot partition."""
    from vigilo.operators import profiles
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.shuffle.partitions": "32"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        sf = "/root/testdata/sf0.01"
        # several map tasks, as any large input has (AQE splits along map outputs)
        m = catalog.messages(spark, sf).repartition(8)
        hot = m.withColumn("patient_id", F.when(F.col("mesure_id").substr(-1, 1).isin("0", "3", "6"),
                                                F.lit("PAT0001")).otherwise(F.col("patient_id")))
        salted = profiles.updates_from_messages(hot, ref.THRESHOLD_ROWS, td.patients(spark, sf))
        rows = salted.collect()
        assert "SortMergeJoin(skew=true)" in salted._jdf.queryExecution().executedPlan().toString()
        assert len(rows) == m.count()
        assert sum(r["patient_id"] == "PAT0001" for r in rows) > len(rows) / 4
        plain = profiles.updates_from_messages(hot, ref.THRESHOLD_ROWS, td.patients(spark, sf),
                                               salt_buckets=1)
        plain.collect()
        assert "SortMergeJoin(skew=true)" not in plain._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_forced_skew_split_for_join_then_group(spark):
    """Join, then group by patient: the aggregation reuses the join partitioning, so
    AQE splits a hot patient only with forceOptimizeSkewedJoin (recommended setting)."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "12k",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "12k",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.shuffle.partitions": "32",
            "spark.sql.adaptive.forceOptimizeSkewedJoin": "true"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        sf = "/root/testdata/sf0.01"
        s = td.signals(spark, sf).repartition(8)
        hot = s.withColumn("patient_id", F.when(F.col("mesure_id").substr(-1, 1).isin("0", "3", "6"),
                                                F.lit("PAT0001")).otherwise(F.col("patient_id")))
        df = kpis.all_kpis(kpis.patient_day_stats_from_sources(
            hot, td.sensors(spark, sf), td.patients(spark, sf), aggregate_first=False))
        rows = df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert "SortMergeJoin(skew=true) [patient_id" in plan
        ref_rows = kpis.all_kpis(kpis.patient_day_stats_from_sources(
            hot, td.sensors(spark, sf), td.patients(spark, sf))).collect()
        assert sorted(map(repr, rows)) == sorted(map(repr, ref_rows))
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_rank_over_many_partitions(spark, workdir):
    """The ranks are gapless and every row is there where the full rows and the order
    columns alone would be coalesced to different partitions."""
    n = 150_000
    df = (spark.range(n, numPartitions=8)
          .select((F.col("id") * 7919 % n).alias("key"), F.sha2(F.col("id").cast("string"), 512).alias("wide")))
    catalog.ranked(df, [F.col("key").desc()]).write.parquet(f"{workdir}/ranked")
    out = spark.read.parquet(f"{workdir}/ranked")
    assert out.columns == ["key", "wide", "position"]
    assert out.count() == n
    assert out.filter(F.col("position") != n - F.col("key")).isEmpty()


def test_counts_of_stored_tables_come_from_footers(spark, workdir):
    from vigilo import schemas
    from vigilo.sources import files, versions
    path = f"{workdir}/t"
    enriched = catalog._enriched(spark, SMALL_SF)
    files.replace_table(enriched, path, partition_by="date_mesure")
    day = enriched.select(F.min("date_mesure")).first()[0]
    files.replace_table(enriched.where(F.col("date_mesure") == day).limit(3), path, partition_by="date_mesure", only=[day])
    own = files.footer_session(spark)
    counts = kpis.stored_counts({"t": versions.scans(own, path, schemas.ENRICHED)})
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PushedAggregation: [COUNT(*)]") == 2 and "ReadSchema: struct<count(*)" in plan.replace("`", "")
    want = files.read_table(spark, path, schemas.ENRICHED)
    assert counts.first()["nb_lignes"] == want.count() == enriched.where(F.col("date_mesure") != day).count() + 3
    assert spark.conf.get("spark.sql.sources.useV1SourceList") != own.conf.get("spark.sql.sources.useV1SourceList")


def test_plan_choice_by_density(spark):
    """Sparse input: join, then group; dense input: aggregate first. The same table either way."""
    s, c, p = td.signals(spark, SMALL_SF), td.sensors(spark, SMALL_SF), td.patients(spark, SMALL_SF)
    one_day = s.withColumn("date", F.lit("2025-01-01")).withColumn("patient_id", F.concat(F.lit("PAT000"), F.pmod(F.hash("mesure_id"), F.lit(7)) + 1))
    sparse, dense = kpis.readings_per_patient_day(s), kpis.readings_per_patient_day(one_day)
    assert sparse < kpis.DENSE <= dense
    for signals, first in ((s, False), (one_day, True)):
        chosen = kpis.patient_day_stats_from_sources(signals, c, p, aggregate_first=None)
        fixed, other = (kpis.patient_day_stats_from_sources(signals, c, p, aggregate_first=x) for x in (first, not first))
        shape = lambda df: re.findall(r"^[\s+\-:*()\d]*([A-Z]\w+)", df._jdf.queryExecution().sparkPlan().toString(), re.M)
        assert shape(chosen) == shape(fixed) != shape(other)
        assert _rows(kpis.all_kpis(chosen)) == _rows(kpis.all_kpis(other))
