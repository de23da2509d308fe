"""Ids of handled measurements: exact answers, what is read, how many files stay."""

import os

from pyspark.sql import functions as F

from vigilo.streaming import seen
from vigilo.streaming.seen import Seen


def ids(spark, pairs):
    return spark.createDataFrame(pairs, "mesure_id string, jour string")


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_thirty_days_and_fifty_batches(spark, workdir, monkeypatch):
    """Windows of days that move on, each batch delivering some ids of earlier ones again."""
    monkeypatch.setattr(seen, "FANOUT", 4)
    days = [f"2025-01-{d:02d}" for d in range(1, 31)]
    store, known = Seen(spark, workdir), set()
    for batch in range(50):
        mine = [days[(batch + k) % 30] for k in (0, 7)]
        new = {(f"m{batch}-{i}", mine[i % 2]) for i in range(40)}
        again = set(sorted(known)[batch::11])
        other_day = {(m, "2025-02-01") for m, _ in sorted(again)[:3]}      # the same id on another day is new
        arrived = sorted(new | again | other_day)
        if batch % 6 == 5:
            found = store.replays(ids(spark, arrived), "r", batch)
            assert rows(found) == sorted(set(arrived) & known), batch
            found.unpersist()
        fresh = sorted(set(arrived) - known)
        store.remember(ids(spark, fresh), "r", batch)
        known |= set(fresh)
    for kind in ("ids", "filtres"):
        files = [f for _, _, names in os.walk(os.path.join(workdir, seen.TABLE, kind)) for f in names if f.endswith(".parquet")]
        # under FANOUT segments of each of two levels and the newest, instead of one per batch and day
        for day in [*days, "2025-02-01"]:
            assert len(store.segments(day)) <= 3 + 3 + 3 + 1
        assert len(files) <= sum(len(store.segments(d)) for d in [*days, "2025-02-01"]) * 2
    stored = [(s["name"], d) for d in days for s in store.segments(d)]
    assert rows(store._read("ids", seen._IDS, [(d, s) for s, d in stored]).select("mesure_id", "jour")) == sorted(
        k for k in known if k[1] != "2025-02-01")


def test_only_hit_segments_are_read(spark, workdir, monkeypatch):
    store, opened = Seen(spark, workdir), []
    for b in range(4):
        store.remember(ids(spark, [(f"m{b}-{i}", "2025-01-01") for i in range(3000)]), "r", b)
    read = Seen._read

    def noted(self, kind, schema, of):
        opened.append((kind, len(of)))
        return read(self, kind, schema, of)
    monkeypatch.setattr(Seen, "_read", noted)
    assert rows(store.replays(ids(spark, [("m2-17", "2025-01-01")]), "r", 9)) == [("m2-17", "2025-01-01")]
    assert opened == [("filtres", 4), ("ids", 1)]
    opened.clear()
    assert rows(store.replays(ids(spark, [("m2-17", "2025-01-02"), ("x", "-")]), "r", 9)) == []
    assert opened == []                                     # days without ids: nothing is read
    assert rows(store.replays(ids(spark, [("m2-17", "2025-01-01")]), "r", 2)) == []      # its own batch


def test_filters_let_few_others_through(spark, workdir):
    store = Seen(spark, workdir)
    own = spark.range(30_000).select(F.concat(F.lit("a"), "id").alias("mesure_id"), F.lit("d").alias("jour"))
    store.remember(own, "r", 0)
    blocs = store.segments("d")[0]["blocs"]
    assert blocs == 12
    filters = store._read("filtres", seen._FILTERS, [("d", "r-0")])

    def held(name):
        probes = spark.range(30_000).select(F.concat(F.lit(name), "id").alias("mesure_id"))
        return (probes.withColumn("bloc", seen._block(F.lit(blocs))).join(filters, "bloc")
                .where(seen._may_hold(F.col("bits"))).count())
    assert held("a") == 30_000 and held("b") < 300


def test_days_of_odd_timestamps(spark):
    df = spark.createDataFrame([("2025-01-02T10:00:00",), ("soon",), ("",), (None,)], "timestamp string")
    assert [r[0] for r in df.select(seen.day_of()).collect()] == ["2025-01-02", "-", "-", "-"]
