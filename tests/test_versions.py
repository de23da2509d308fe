"""Tables replaced by version: failed writes, readers of an older version, partitions, conflicts."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from vigilo.sources import files, versions

SCHEMA = StructType([StructField("id", LongType()), StructField("jour", StringType()), StructField("x", IntegerType())])


def table(spark, days, x, n=4):
    return (spark.range(n * len(days)).withColumn("jour", F.element_at(F.array(*map(F.lit, days)), (F.col("id") % len(days) + 1).cast("int")))
            .withColumn("x", F.lit(x)))


def rows(df):
    return sorted(map(tuple, df.collect()))


def failing(df):
    """Fails while it is written, after other rows were written."""
    bad = F.raise_error(F.lit("midway")).cast("int")
    return df.withColumn("x", F.when(F.col("id") == 2, bad).otherwise(F.col("x")))


@pytest.mark.parametrize("only", [None, ["2025-01-02"]])
def test_a_failed_write_leaves_the_table(spark, workdir, only):
    path = os.path.join(workdir, "t")
    days = ["2025-01-01", "2025-01-02"]
    files.replace_table(table(spark, days, 1), path, partition_by="jour")
    before = rows(files.read_table(spark, path, SCHEMA))
    worse = failing(table(spark, days if only is None else only, 2))
    with pytest.raises(Exception, match="midway"):
        files.replace_table(worse, path, partition_by="jour", only=only)
    assert rows(files.read_table(spark, path, SCHEMA)) == before and len(before) == 8
    assert versions.Log(spark, f"{path}/_commits").numbers() == [1]
    versions.vacuum(spark, path)
    assert rows(files.read_table(spark, path, SCHEMA)) == before
    assert len([d for d in os.listdir(path) if d.startswith("v-")]) == 1


def test_a_write_that_dies_before_publishing(spark, workdir, monkeypatch):
    path = os.path.join(workdir, "t")
    files.replace_table(table(spark, ["a"], 1), path, partition_by="jour")

    def dies(*_):
        raise OSError("driver lost")
    with monkeypatch.context() as m:
        m.setattr(versions.Log, "append", dies)
        with pytest.raises(OSError):
            files.replace_table(table(spark, ["a"], 2), path, partition_by="jour")
    assert {r.x for r in files.read_table(spark, path, SCHEMA).collect()} == {1}
    assert len(versions.vacuum(spark, path)) == 1
    files.replace_table(table(spark, ["a"], 3), path, partition_by="jour")       # the run again
    assert {r.x for r in files.read_table(spark, path, SCHEMA).collect()} == {3}


def test_partitions_are_replaced_and_emptied(spark, workdir):
    path = os.path.join(workdir, "t")
    files.replace_table(table(spark, ["d1", "d 2/é", "d3"], 1), path, partition_by="jour")
    files.replace_table(table(spark, ["d 2/é"], 2, n=3), path, partition_by="jour", only=["d 2/é", "d3"])
    got = files.read_table(spark, path, SCHEMA)
    assert {(r.jour, r.x): r["count"] for r in got.groupBy("jour", "x").count().collect()} == {("d1", 1): 4, ("d 2/é", 2): 3}
    assert got.columns == ["id", "jour", "x"] and dict(got.dtypes)["jour"] == "string"
    with pytest.raises(ValueError, match="outside"):
        files.replace_table(table(spark, ["d1", "d3"], 9), path, partition_by="jour", only=["d3"])
    files.replace_table(table(spark, ["d1"], 5).limit(0), path, partition_by="jour", only=["d1", "d 2/é"])
    assert files.read_table(spark, path, SCHEMA).count() == 0


def test_readers_keep_their_version_and_old_ones_go(spark, workdir):
    path = os.path.join(workdir, "t")
    for x in range(1, 5):
        files.replace_table(table(spark, ["a", "b"], x), path, partition_by="jour")
        if x == 3:
            reader = files.read_table(spark, path, SCHEMA)      # resolved at version 3, run at version 4
    assert {r.x for r in reader.collect()} == {3} and {r.x for r in files.read_table(spark, path, SCHEMA).collect()} == {4}
    assert versions.Log(spark, f"{path}/_commits").numbers() == [3, 4]
    assert len([d for d in os.listdir(path) if d.startswith("v-")]) == 2


def test_two_writers_of_one_version(spark, workdir):
    path = os.path.join(workdir, "t")
    log = versions.Log(spark, f"{path}/_commits")
    log.append(1, {"parts": {}, "made": {}})
    with pytest.raises(versions.Conflict):
        log.append(1, {"parts": {"x": "y"}, "made": {}})
    assert log.latest() == (1, {"parts": {}, "made": {}})
    assert not [f for f in os.listdir(f"{path}/_commits") if f.startswith(".1-") and not f.endswith(".crc")]


def test_text_tables_and_pruned_days(spark, workdir):
    path = os.path.join(workdir, "t")
    files.replace_table(table(spark, ["d1", "d2"], 1), path, partition_by="jour")
    files.replace_table(table(spark, ["d3"], 2), path, partition_by="jour", only=["d3"])
    day = files.read_table(spark, path, SCHEMA).filter("jour = 'd3'")
    assert "PartitionFilters: [isnotnull(jour" in day._jdf.queryExecution().executedPlan().toString()
    assert day.count() == 4
