"""Every registered query against its DuckDB oracle on the smallest scale (the
driver runs the same comparison at sf0.01)."""

import pytest

import __spark_entry__ as E
from sample_data import SMALL_SF
from tools.check_oracle import compare, duck_connection

# the training-data queries have their own tests
KEYS = list(E.catalog.QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck_connection(SMALL_SF)


def test_every_query_has_an_oracle():
    assert set(E.oracle.oracle_sql()) == set(KEYS)
    assert len(KEYS) >= 35


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    ok, msg = compare(E.queries()[key](spark, SMALL_SF), con, E.oracle_sql()[key])
    assert ok, msg


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "score_stabilite_cardiaque" in df.columns


def test_adapter_reaches_every_label(spark):
    """Every label of the KPI rules occurs in the adapter's data, and ids without a profile."""
    from pyspark.sql import functions as F

    from vigilo.operators import kpis
    sf = "/root/testdata/sf0.01"
    view = E.queries()["dashboard_view"](spark, sf).persist()
    counts = lambda c: {r[0]: r[1] for r in view.groupBy(c).count().collect()}
    for column, labels in (("classification_oms", [g[2] for g in kpis.OMS_GRADES] + [kpis.OMS_NORMAL]),
                           ("statut_cardiaque", kpis.CARDIAC_LABELS), ("niveau_oxygenation", kpis.O2_LABELS)):
        found = counts(column)
        assert set(found) == set(labels) and min(found.values()) > 100
    view.unpersist()
    for scale, unmatched in (("0.001", 11), ("0.01", 104)):
        u = E.queries()["patient_updates"](spark, f"/root/testdata/sf{scale}")
        assert u.filter(F.col("ville") == "Inconnue").count() == unmatched


def test_alert_values_have_ties(spark):
    """The data hold values halfway between two hundredths, so rounding half to even shows."""
    from vigilo.sources import testdata as td
    obs = td.observations(spark, SMALL_SF)
    assert obs.where("temperature_C * 1000 % 10 = 5").count() > 100
    alerts = E.queries()["alerts_batch"](spark, SMALL_SF).where("signal = 'temperature_C'")
    assert {round(r.valeur_mesuree % 1, 2) for r in alerts.collect()} >= {0.12, 0.38, 0.62, 0.88}


def test_numbers_are_plain_digits(spark):
    from vigilo.functions.render import js_number
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(12345678.9,), (0.0001234,), (3.0,), (36.6,), (None,)], "x double")
    assert [r[0] for r in df.select(js_number(F.col("x"))).collect()] == ["12345678.9", "0.0001234", "3", "36.6", None]


def test_small_profiles_are_not_salted(spark):
    from vigilo.operators import profiles
    from vigilo.sources import testdata as td
    profile = profiles.profile_lookup(td.patients(spark, SMALL_SF))
    measured = td.observations(spark, SMALL_SF)
    plan = profiles.salted_profile_join(measured, profile)._jdf.queryExecution().optimizedPlan().toString()
    assert "explode" not in plan
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = profiles.salted_profile_join(measured, profile)._jdf.queryExecution().optimizedPlan().toString()
        assert "explode" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_bench_headline_keys_are_registered():
    import bench
    assert set(bench.HEADLINE) <= set(E.queries()) and set(bench.HEADLINE) <= set(E.oracle_sql())
