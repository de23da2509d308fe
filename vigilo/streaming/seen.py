"""Which measurements were handled before (T10): ids by day, behind Bloom filters.

Every batch adds one segment: its new ids and, per day, a blocked Bloom filter. An id falls
into one block of its day's filter (``IDS_A_BLOCK`` ids to ``BITS`` bits) and sets ``HASHES``
bits there. A later batch looks its ids up in the filters of its own days; only the segments
in which some id may occur are opened, and what they hold is compared exactly. So a batch
without replays reads filters alone, about 13 bits an id, and nothing of other days.

Segments of a day are merged by level: ``FANOUT`` of one level become one of the next, so a
day has at most ``FANOUT`` segments for each power of ``FANOUT`` of its batches, and each id is
rewritten once a level. Which segments a day has is the newest entry of its log, one atomic
record; a segment that no entry names doesn't count.
"""

from __future__ import annotations

import uuid
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilo.session import remove
from vigilo.sources.versions import Log

TABLE = "mesures_vues"
# Fixed value: bits of a bitmap of Spark's bitmap functions.
BITS = 32_768
IDS_A_BLOCK, HASHES = 2_500, 6
FANOUT = 8

_IDS = "mesure_id string, segment string, jour string"
_FILTERS = "bloc long, bits binary, segment string, jour string"


def day_of() -> Column:
    """The day of a message; all timestamps that don't begin with a date count as one day."""
    day = F.substring("timestamp", 1, 10)
    return F.when(day.rlike(r"^\d{4}-\d{2}-\d{2}$"), day).otherwise(F.lit("-"))


class Seen:
    """The ids stored below ``out``."""

    def __init__(self, spark: SparkSession, out: str):
        self.spark, self.root = spark, f"{out.rstrip('/')}/{TABLE}"

    # ---------------------------------------------------------------- days and segments

    def _log(self, day: str) -> Log:
        return Log(self.spark, f"{self.root}/_jours/{quote(day, safe='')}")

    def segments(self, day: str) -> list[dict]:
        """``name, level, blocs, run, batch`` of the day's segments."""
        return (self._log(day).latest()[1] or {"segments": []})["segments"]

    def _publish(self, day: str, segments: list[dict]) -> None:
        log = self._log(day)
        numbers = log.numbers()
        log.append(numbers[-1] + 1 if numbers else 1, {"segments": segments})
        for n in numbers[:-1]:
            log.forget(n)

    def _paths(self, kind: str, of: list[tuple[str, str]]) -> list[str]:
        return [f"{self.root}/{kind}/segment={s}/jour={d}" for d, s in of]

    def _read(self, kind: str, schema: str, of: list[tuple[str, str]]) -> DataFrame:
        if not of:
            return self.spark.createDataFrame([], schema)
        return (self.spark.read.schema(schema).option("basePath", f"{self.root}/{kind}")
                .parquet(*self._paths(kind, of)))

    # ---------------------------------------------------------------- looking up

    def replays(self, ids: DataFrame, run: str, batch: int) -> DataFrame:
        """The rows of ``ids(mesure_id, jour)`` stored by another batch than this one. Days of
        the batch are listed in the driver."""
        days = [r[0] for r in ids.select("jour").distinct().collect()]
        stored = [(d, s["name"], s["blocs"]) for d in days for s in self.segments(d)
                  if (s["run"], s["batch"]) != (run, batch)]
        if not stored:
            return ids.limit(0)
        # one row per day of the batch and segment
        known = self.spark.createDataFrame(stored, "jour string, segment string, blocs long")
        probes = ids.join(F.broadcast(known), "jour").withColumn("bloc", _block(F.col("blocs")))
        filters = self._read("filtres", _FILTERS, [(d, s) for d, s, _ in stored])
        maybe = (probes.join(filters, ["jour", "segment", "bloc"]).where(_may_hold(F.col("bits")))
                 .select("mesure_id", "jour", "segment").persist())
        try:
            hit = [(r.jour, r.segment) for r in maybe.select("jour", "segment").distinct().collect()]
            if not hit:
                return ids.limit(0)
            found = self._read("ids", _IDS, hit).join(maybe, ["jour", "segment", "mesure_id"]).select("mesure_id", "jour")
            found = found.distinct().persist()      # only ids that did occur
            found.count()                           # while the filters' answer is at hand
            return found
        finally:
            maybe.unpersist()

    # ---------------------------------------------------------------- storing

    def remember(self, ids: DataFrame, run: str, batch: int) -> None:
        """Stores ``ids(mesure_id, jour)`` as the segment of the batch; a batch handled again
        replaces its own. Merges what became too much, this segment aside."""
        name = f"{run}-{batch}"
        sizes = self._write(ids, name)
        for day, n in sizes.items():
            kept = [s for s in self.segments(day) if s["name"] != name]
            self._publish(day, [*kept, {"name": name, "level": 0, "blocs": _blocks(n), "run": run, "batch": batch}])
        self._merge(list(sizes), but=name)

    def _write(self, ids: DataFrame, name: str) -> dict[str, int]:
        """Writes ids and filters of a segment; ids per day."""
        counts = ids.groupBy("jour").agg(F.count(F.lit(1)).alias("n"))
        sizes = {r.jour: r.n for r in counts.collect()}     # one row per day of the batch
        if not sizes:
            return {}
        blocks = self.spark.createDataFrame([(d, _blocks(n)) for d, n in sizes.items()], "jour string, blocs long")
        bits = F.explode(F.array(*[_bit(k) for k in range(HASHES)]))
        filters = (ids.join(F.broadcast(blocks), "jour").select("jour", _block(F.col("blocs")).alias("bloc"), bits.alias("bit"))
                   .groupBy("jour", "bloc").agg(F.bitmap_construct_agg("bit").alias("bits")))
        for df, kind in ((ids.select("mesure_id", "jour"), "ids"), (filters, "filtres")):
            (df.hint("rebalance", "jour").write.mode("overwrite").partitionBy("jour")
             .parquet(f"{self.root}/{kind}/segment={name}"))
        return sizes

    def _merge(self, days: list[str], but: str) -> None:
        while True:
            due = {}
            for day in days:
                by: dict[int, list[str]] = {}
                for s in self.segments(day):
                    if s["name"] != but:
                        by.setdefault(s["level"], []).append(s["name"])
                full = sorted(level for level, names in by.items() if len(names) >= FANOUT)
                if full:
                    due[day] = (full[0], by[full[0]])
            if not due:
                return
            name = f"m-{uuid.uuid4().hex[:16]}"
            old = [(d, s) for d, (_, names) in due.items() for s in names]
            sizes = self._write(self._read("ids", _IDS, old).select("mesure_id", "jour"), name)
            for day, (level, names) in due.items():
                kept = [s for s in self.segments(day) if s["name"] not in names]
                self._publish(day, [*kept, {"name": name, "level": level + 1, "blocs": _blocks(sizes[day]), "run": "", "batch": -1}])
            for path in self._paths("ids", old) + self._paths("filtres", old):
                remove(self.spark, path)


def _blocks(n: int) -> int:
    return -(-n // IDS_A_BLOCK)


def _block(blocks: Column) -> Column:
    return F.pmod(F.xxhash64("mesure_id", F.lit(-1)), blocks)


def _bit(k: int) -> Column:
    return F.pmod(F.xxhash64("mesure_id", F.lit(k)), F.lit(BITS)).cast("long")


def _may_hold(bits: Column) -> Column:
    """Whether all bits of the row's id are set in its block."""
    held = None
    for k in range(HASHES):
        byte = F.substring(bits, (F.shiftright(_bit(k), 3) + 1).cast("int"), F.lit(1))
        one = F.getbit(F.conv(F.hex(byte), 16, 10).cast("long"), (_bit(k) % 8).cast("int")) == 1
        held = one if held is None else held & one
    return held
