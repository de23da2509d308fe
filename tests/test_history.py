"""Compaction of the alert history: files by size, same rows, readers and the writer go on."""

import os

from pyspark.sql import functions as F

from vigilo import schemas
from vigilo.streaming import history, jobs


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def _alerts(spark, n, days):
    """Alerts with the batch they come in."""
    fields = [F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.ALERT_HISTORY.fields
              if f.name not in ("alerte_id", "date_alerte")]
    return spark.range(n).select(F.concat(F.lit("a"), "id").alias("alerte_id"),
                                 F.concat(F.lit("2025-01-0"), (F.col("id") % days + 1).cast("string")).alias("date_alerte"), *fields,
                                 F.lit("r").alias("run_id"), (F.col("id") / days % 200).cast("long").alias("batch_id"))


def test_two_hundred_batches(spark, workdir):
    table = os.path.join(workdir, "alertes")
    all_rows = _alerts(spark, 400, 1)
    all_rows.coalesce(1).write.partitionBy("run_id", "batch_id", "date_alerte").parquet(table)     # as 200 batches leave it
    read = lambda: jobs.read_output(spark, workdir, "alertes")
    want = rows(read())
    assert len(want) == 400 and min(history.days(spark, table, "date_alerte").values()) >= 200
    before = history.days(spark, table, "date_alerte")["2025-01-01"]
    reader = read()
    size = max(history._files(spark, table).values())
    made = jobs.compact_history(spark, workdir, target=25 * size)
    left = history.days(spark, table, "date_alerte")
    newest = {f for f in history._counting(spark, table) if "batch_id=199" in f}
    assert made and max(left.values()) <= before / 20 + 1 + len(newest) and rows(read()) == want
    assert rows(reader) == want                       # resolved before: its files are still there
    assert newest
    # another batch arrives, the next compaction takes up the files of the first and deletes what it replaced
    jobs.write_alert_history(all_rows.where("batch_id = 3").drop("run_id", "batch_id").select(*schemas.ALERT_HISTORY.fieldNames()),
                             workdir, 200, "r")
    more = sorted(want + [r for r in rows(all_rows.where("batch_id = 3").select(*schemas.ALERT_HISTORY.fieldNames()))], key=repr)
    assert rows(read()) == more
    jobs.compact_history(spark, workdir)
    assert rows(read()) == more
    assert max(history.days(spark, table, "date_alerte").values()) <= 3
    jobs.compact_history(spark, workdir)              # nothing left to pack but the files of before go
    assert len(history._files(spark, table)) == sum(history.days(spark, table, "date_alerte").values())
    day = read().filter("date_alerte = '2025-01-01'")
    assert "PartitionFilters: [isnotnull(date_alerte" in day._jdf.queryExecution().executedPlan().toString()


def test_a_failed_compaction_changes_nothing(spark, workdir, monkeypatch):
    import pytest
    table = os.path.join(workdir, "alertes")
    _alerts(spark, 60, 1).withColumn("batch_id", F.col("batch_id") % 5).write.partitionBy("run_id", "batch_id", "date_alerte").parquet(table)
    want = rows(jobs.read_output(spark, workdir, "alertes"))
    jobs.compact_history(spark, workdir)
    with monkeypatch.context() as m:
        m.setattr(history.Log, "append", lambda *_: (_ for _ in ()).throw(OSError("driver lost")))
        jobs.write_alert_history(jobs.read_output(spark, workdir, "alertes").limit(0), workdir, 9, "r")
        jobs.write_alert_history(jobs.read_output(spark, workdir, "alertes").limit(5), workdir, 10, "r")
        jobs.write_alert_history(jobs.read_output(spark, workdir, "alertes").limit(0), workdir, 11, "r")
        with pytest.raises(OSError):
            jobs.compact_history(spark, workdir)
    assert len(rows(jobs.read_output(spark, workdir, "alertes"))) == len(want) + 5
    jobs.compact_history(spark, workdir)
    assert len(rows(jobs.read_output(spark, workdir, "alertes"))) == len(want) + 5


def test_bins():
    sizes = {"a": 60, "b": 50, "c": 30, "d": 30, "e": 20, "f": 99, "g": 1}
    assert history.pack(sizes, 120) == [["b", "c", "d", "g"]]      # a and f are large, e has no partner
    assert sorted(map(sorted, history.pack({str(i): 10 for i in range(25)}, 100))) == sorted(
        map(sorted, [[str(i) for i in sorted(range(25), key=str)][k:k + 10] for k in (0, 10, 20)]))
    assert history.pack({"only": 3}, 100) == [] and history.pack({}, 9) == []
