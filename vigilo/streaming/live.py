"""The live view (O8, O9, O10, A11): recent alerts and latest states, committed batch by batch.

Every micro-batch makes one entry of a log: the folder with the newest alerts (a bounded top-k:
the ``LOG_LINES`` newest of the stored ones and of the batch), and the folders whose rows are the
latest messages of the patients. The entry is written last and atomically, so a reader that
resolves one entry sees alerts and states of the same batch, whatever is written meanwhile,
and a batch handled again after its entry stands does nothing.

The work of a batch doesn't depend on the history: it reads the stored top-k, writes the
latest message of its own patients, and merges folders by level (``FANOUT`` of a level become
one of the next, each row is rewritten once a level).
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StringType, StructField, StructType

from vigilo import schemas
from vigilo.functions.ids import normalise_patient_id
from vigilo.operators import alerts as al
from vigilo.operators import monitor, profiles
from vigilo.session import remove
from vigilo.sources.stream import decode_messages
from vigilo.sources.versions import Log
from vigilo.streaming.jobs import BATCH_INTERVAL, _trigger, run_id_of

FANOUT = 8
#: Entries that stay readable beside the newest.
KEEP = 20

_STATE = StructType([StructField("patient_key", StringType()), StructField("lot", LongType()), *schemas.MESSAGE.fields])


class Snapshot:
    """What one entry names. ``lot`` picks an entry (default: the newest)."""

    def __init__(self, spark: SparkSession, out: str, thresholds: al.Thresholds, lot: int | None = None):
        self.spark, self.out, self.thresholds = spark, out.rstrip("/"), thresholds
        log = _log(spark, self.out)
        self.lot, self.entry = log.latest() if lot is None else (lot, log.read(lot))

    def alerts(self, n: int = monitor.RECENT_ALERTS) -> DataFrame:
        """The ``n`` newest alerts (at most ``LOG_LINES``), newest first."""
        return monitor.recent_alerts(_alerts(self.spark, self.out, self.entry, self.thresholds), n)

    def latest_messages(self) -> DataFrame:
        return _newest(_states(self.spark, self.out, self.entry)).drop("patient_key", "lot")

    def latest_updates(self, patients: DataFrame) -> DataFrame:
        """The latest patient update of every patient, with its alerts."""
        return profiles.patient_updates(al.with_alerts(self.latest_messages(), self.thresholds), patients, salt_buckets=1)

    def replay(self, patients: DataFrame, n: int = monitor.REPLAY_ALERTS) -> DataFrame:
        """What a new reader receives."""
        return monitor.recent_alerts_replay(self.alerts(n), self.latest_updates(patients), n)


def _log(spark: SparkSession, out: str) -> Log:
    return Log(spark, f"{out}/_lots")


def _alert_schema(spark: SparkSession, thresholds: al.Thresholds) -> StructType:
    return al.alerts(spark.createDataFrame([], schemas.MESSAGE), thresholds).schema


def _alerts(spark, out: str, entry: dict | None, thresholds: al.Thresholds) -> DataFrame:
    schema = _alert_schema(spark, thresholds)
    if not entry:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{out}/{entry['alertes']}")


def _states(spark, out: str, entry: dict | None, names: list[str] | None = None) -> DataFrame:
    names = names if names is not None else [s["name"] for s in (entry or {"etats": []})["etats"]]
    if not names:
        return spark.createDataFrame([], _STATE)
    return spark.read.schema(_STATE).parquet(*[f"{out}/{n}" for n in names])


def _newest(states: DataFrame) -> DataFrame:
    """One row per patient: the latest message, of equal ones that of the later batch."""
    fields = [c for c in states.columns if c != "patient_key"]
    return (states.groupBy("patient_key").agg(F.max_by(F.struct(*fields), F.struct("timestamp", "mesure_id", "lot")).alias("m"))
            .select("patient_key", "m.*"))


def commit_batch(msgs: DataFrame, run: str, batch: int, out: str, thresholds: al.Thresholds) -> int:
    """Adds a batch of decoded messages; the number of its entry."""
    spark, out = msgs.sparkSession, out.rstrip("/")
    log = _log(spark, out)
    n, before = log.latest()
    if before and (before["run"], before["batch"]) == (run, batch):
        return n            # committed before the stream could note it
    lot, part = n + 1, uuid.uuid4().hex[:12]
    valid = msgs.filter(al.is_valid(msgs)).persist()
    try:
        recent = monitor.recent_alerts(_alerts(spark, out, before, thresholds).unionByName(
            monitor.recent_alerts(al.alerts(valid, thresholds), monitor.LOG_LINES)), monitor.LOG_LINES)
        mine = (monitor.latest_messages(valid).withColumn("patient_key", normalise_patient_id(F.col("patient_id")))
                .withColumn("lot", F.lit(lot).cast("long")).select(*_STATE.fieldNames()))
        folders = {"alertes": (recent, f"alertes/lot-{lot}-{part}"), "etats": (mine, f"etats/lot-{lot}-{part}")}
        with ThreadPoolExecutor(max_workers=2) as pool:
            for done in [pool.submit(df.write.parquet, f"{out}/{name}") for df, name in folders.values()]:
                done.result()
    finally:
        valid.unpersist()
    states = [*(before or {"etats": []})["etats"], {"name": folders["etats"][1], "level": 0}]
    entry = {"run": run, "batch": batch, "alertes": folders["alertes"][1], "etats": _merged(spark, out, states, lot)}
    log.append(lot, entry)
    _forget(log, out)
    return lot


def _merged(spark: SparkSession, out: str, states: list[dict], lot: int) -> list[dict]:
    """``states`` with every full level merged into one folder of the next."""
    while True:
        by: dict[int, list[dict]] = {}
        for s in states:
            by.setdefault(s["level"], []).append(s)
        full = sorted(level for level, own in by.items() if len(own) >= FANOUT)
        if not full:
            return states
        old = by[full[0]]
        name = f"etats/lot-{lot}-niveau-{full[0] + 1}-{uuid.uuid4().hex[:12]}"
        _newest(_states(spark, out, None, [s["name"] for s in old])).select(*_STATE.fieldNames()).write.parquet(f"{out}/{name}")
        states = [*[s for s in states if s not in old], {"name": name, "level": full[0] + 1}]


def _forget(log: Log, out: str) -> None:
    """Entries older than ``KEEP`` before the newest go, with the folders that only they name."""
    numbers = log.numbers()
    old, kept = numbers[:-KEEP - 1], numbers[-KEEP - 1:]
    if not old:
        return
    named = lambda e: {e["alertes"], *(s["name"] for s in e["etats"])}
    used = set().union(*(named(log.read(k)) for k in kept))
    for k in old:
        for name in named(log.read(k)) - used:
            remove(log.spark, f"{out}/{name}")
        log.forget(k)


def live_stream(records: DataFrame, out: str, checkpoint: str, thresholds: al.Thresholds,
                trigger: str | None = BATCH_INTERVAL) -> StreamingQuery:
    """Starts the live view on a stream of wire records (or decoded messages)."""
    msgs = decode_messages(records) if "value" in records.columns else records
    run = run_id_of(records.sparkSession, checkpoint)
    w = (msgs.writeStream.foreachBatch(lambda b, i: commit_batch(b, run, i, out, thresholds) and None)
         .option("checkpointLocation", checkpoint))
    return _trigger(w, trigger).start()
