"""Structured Streaming jobs (T1–T10, K4–K6, A11 streaming).

``alert_stream``: decode each micro-batch, classify, enrich with the profile
and write four outputs — alert history (partitioned by day), patient
updates, rejected messages, the batch's measurement count. Each output of
batch ``N`` of a run goes to its own ``run_id=R/batch_id=N`` folder in
overwrite mode, so a batch replayed after a failure (executor lost, driver
restart from the checkpoint) replaces its own files: no loss, no duplicate.
The run id is kept next to the checkpoint; a reset checkpoint starts a new
run, whose batches stand beside those of the runs before. Nothing is
collected to the driver; the batch is persisted once and the writes run as
concurrent jobs over it. Optionally, measurements delivered again are left
out; no measurement is dropped for being late.

``latest_state_stream`` / ``counters_stream``: stateful aggregations per
patient in update mode; the state holds one row per patient (bounded by the
patient count, not by the event count). Changed rows of each batch are
written per run and batch, the readers resolve the latest row per patient,
and ``compact_state`` replaces older batches by one snapshot.
"""

from __future__ import annotations

import contextlib
import threading
import time
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import LongType, StringType, StructField, StructType

from vigilo import schemas
from vigilo.functions.ids import normalise_patient_id
from vigilo.operators import alerts as al
from vigilo.operators import profiles
from vigilo.session import remove
from vigilo.sources.stream import decode_messages, encode_messages
from vigilo.streaming import history
from vigilo.streaming.metrics import BatchCounts, observed
from vigilo.streaming.seen import Seen, day_of

BATCH_INTERVAL = "5 seconds"


def _trigger(writer, trigger: str | None):
    if trigger in (None, "availableNow"):
        return writer.trigger(availableNow=True)
    if trigger == "once":
        return writer.trigger(once=True)
    return writer.trigger(processingTime=trigger)


def run_id_of(spark: SparkSession, checkpoint: str) -> str:
    """The id of the run that a checkpoint belongs to: made when the checkpoint is new,
    then read from beside its offsets. Ids sort by the time they were made."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{checkpoint.rstrip('/')}/vigilo_run")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(path):
        stream = fs.open(path)
        try:
            return stream.readUTF()
        finally:
            stream.close()
    run = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    stream = fs.create(path, False)
    try:
        stream.writeUTF(run)
    finally:
        stream.close()
    return run


def process_batch(batch: DataFrame, batch_id: int, out: str, thresholds: al.Thresholds,
                  patients: DataFrame | None = None, profile: DataFrame | None = None,
                  run_id: str = "0", dedup: bool = False) -> None:
    """Handle one micro-batch of wire records (``value`` column) or decoded messages.

    ``profile`` is the prepared one-row-per-patient lookup (see ``prepare_profile``);
    when only ``patients`` is given it is derived here. With ``dedup`` measurements
    already stored by another batch of ``out`` (of any run) are left out.
    """
    if profile is None:
        profile = profiles.profile_lookup(patients)
    msgs = decode_messages(batch) if "value" in batch.columns else batch
    store, replays = Seen(msgs.sparkSession, out), None
    if dedup:
        msgs = msgs.persist()       # decoded once for the ids and the rows
        arrived = msgs
        msgs, replays = without_replays(msgs, store, run_id, batch_id)
    msgs = msgs.persist()
    try:
        n = msgs.count()   # fills the cache once; the outputs then read it
        valid = msgs.filter(al.is_valid(msgs))
        outputs = {
            "alertes": al.to_history(al.alerts(valid, thresholds)),
            "patient_updates": batch_updates(valid, thresholds, profile),
            "rejets": msgs.filter(~al.is_valid(msgs)),
            "comptages": msgs.sparkSession.range(1).select(
                F.lit(batch_id).cast("long").alias("lot"), F.lit(n).cast("long").alias("nb_mesures")),
        }
        # independent outputs are submitted together so they share the executors
        with ThreadPoolExecutor(max_workers=len(outputs)) as pool:
            done = [pool.submit(_write_partition, df, out, name, batch_id, run_id) for name, df in outputs.items()]
            for f in done:
                f.result()   # re-raise a failed write: the batch is then replayed whole
        if dedup:   # last: ids stored without their alerts would make another run drop these
            store.remember(msgs.filter(F.col("mesure_id").isNotNull()).select("mesure_id", day_of().alias("jour")),
                           run_id, batch_id)
    finally:
        msgs.unpersist()
        if dedup:
            replays.unpersist()
            arrived.unpersist()


def without_replays(msgs: DataFrame, store: Seen, run_id: str, batch_id: int) -> tuple[DataFrame, DataFrame]:
    """Messages without those whose measurement was handled before (T10), in this batch or in
    another one; and the replays found (cached; the caller releases them). One of several
    deliveries stays, however late it comes; messages without a measurement id all stay. The
    ids stored by this very batch don't count, so a replayed batch gives the same rows."""
    with_id = F.col("mesure_id").isNotNull()
    day = "_jour"
    named = msgs.withColumn(day, day_of())
    rest = named.filter(~with_id)
    once = named.filter(with_id).dropDuplicates(["mesure_id", day])
    replays = store.replays(named.filter(with_id).select("mesure_id", F.col(day).alias("jour")).distinct(), run_id, batch_id)
    seen = replays.select(F.col("mesure_id").alias("_vue"), F.col("jour").alias("_vue_jour"))
    once = once.join(seen, (F.col("mesure_id") == F.col("_vue")) & (F.col(day) == F.col("_vue_jour")), "left_anti")
    return once.unionByName(rest).drop(day), replays


def batch_updates(valid: DataFrame, thresholds: al.Thresholds, profile: DataFrame) -> DataFrame:
    """Patient updates of one micro-batch. The static profile is first reduced to
    the patients present in the batch (a semi-join whose small side AQE
    broadcasts by measured size), so each batch touches its own patients rather
    than shuffling the whole profile table; a micro-batch is small, so the join
    needs no salting."""
    keyed = al.with_patient_key(valid)
    present = keyed.select(F.col("patient_id").alias("_present")).distinct()
    mine = profile.join(present, profile["patient_id"] == present["_present"], "left_semi")
    return profiles.patient_updates(keyed, profile=mine, thresholds=thresholds, salt_buckets=1)


def prepare_profile(patients: DataFrame) -> DataFrame:
    """The profile lookup, computed once when the stream starts and kept on the
    executors (memory, spilling to disk): dimensions are read once, as a static
    side of every micro-batch. A lost executor recomputes its blocks from the
    patient table."""
    return profiles.profile_lookup(patients).persist(StorageLevel.MEMORY_AND_DISK)


# Tables partitioned by a column inside each batch folder (a day's alerts are
# read without touching other days), with the declared schema used to read them
# back so that partition values keep their string type.
DATE_PARTITIONED = {"alertes": ("date_alerte", schemas.ALERT_HISTORY)}


def _folder(out: str, table: str, batch_id: int, run_id: str) -> str:
    return f"{out}/{table}/run_id={run_id}/batch_id={batch_id}"


def _write_partition(df: DataFrame, out: str, table: str, batch_id: int, run_id: str = "0") -> None:
    """Overwrite the batch's folder of a table (idempotent on replay)."""
    by = {"alertes": "date_alerte"}.get(table)
    if by:   # rows of a day together: files by size, not one per task and day
        df.hint("rebalance", by).write.mode("overwrite").partitionBy(by).parquet(_folder(out, table, batch_id, run_id))
    else:
        df.write.mode("overwrite").parquet(_folder(out, table, batch_id, run_id))


def write_alert_history(history: DataFrame, out: str, batch_id: int, run_id: str = "0") -> None:
    """Persist alert history rows as batch ``batch_id`` of ``<out>/alertes`` (K6)."""
    _write_partition(history, out, "alertes", batch_id, run_id)


def alert_stream(records: DataFrame, out: str, checkpoint: str, thresholds: al.Thresholds,
                 patients: DataFrame | None = None, trigger: str | None = BATCH_INTERVAL,
                 profile: DataFrame | None = None, dedup: bool = False, counts: BatchCounts | None = None) -> StreamingQuery:
    """Start the alert job on a stream of wire records (or decoded messages).
    Pass ``patients`` (prepared here and released when the query ends) or a
    ``profile`` from ``prepare_profile`` (released by the caller). ``dedup``
    leaves out measurements that are delivered again. With ``counts`` (a listener of the
    session) the measurements of every batch are stored as it reports them (A13)."""
    own = prepare_profile(patients) if profile is None else None
    used = own if profile is None else profile
    run = run_id_of(records.sparkSession, checkpoint)
    if counts is not None:
        records = observed(decode_messages(records) if "value" in records.columns else records)
    w = (records.writeStream
         .foreachBatch(lambda b, i: process_batch(b, i, out, thresholds, profile=used, run_id=run, dedup=dedup))
         .option("checkpointLocation", checkpoint))
    if counts is not None:
        name = f"alertes-{run}"
        counts.watch(name, f"{out}/{COUNTS}/run_id={run}")
        w = w.queryName(name)
    query = _trigger(w, trigger).start()
    if own is not None:
        threading.Thread(target=_release_after, args=(query, own), daemon=True).start()
    return query


#: Folder of the counts that a listener stores.
COUNTS = "lots"


def _release_after(query: StreamingQuery, profile: DataFrame) -> None:
    try:
        query.awaitTermination()
    finally:
        profile.unpersist()


def latest_state_stream(records: DataFrame, out: str, checkpoint: str,
                        trigger: str | None = BATCH_INTERVAL) -> StreamingQuery:
    """Start the latest-message-per-patient job (A11, T9) in update mode."""
    msgs = decode_messages(records) if "value" in records.columns else records
    valid = msgs.filter(al.is_valid(msgs))
    fields = valid.columns
    state = (valid.groupBy(normalise_patient_id(F.col("patient_id")).alias("patient_key"))
             .agg(F.max_by(F.struct(*fields), F.struct("timestamp", "mesure_id")).alias("m")))

    run = run_id_of(records.sparkSession, checkpoint)

    def sink(b: DataFrame, i: int) -> None:
        _write_partition(b.select("patient_key", "m.*"), out, "latest", i, run)

    w = (state.writeStream.outputMode("update").foreachBatch(sink)
         .option("checkpointLocation", checkpoint))
    return _trigger(w, trigger).start()


_PLACE = [StructField("run_id", StringType(), True), StructField("batch_id", LongType(), True)]


def read_output(spark: SparkSession, out: str, table: str) -> DataFrame:
    """A table written by the stream, all runs, without the run and batch columns."""
    if table in DATE_PARTITIONED:
        schema = DATE_PARTITIONED[table][1]
        full = StructType(schema.fields + _PLACE)
        if history.is_compacted(spark, f"{out}/{table}"):
            return history.read(spark, f"{out}/{table}", full).select(*schema.fieldNames())
        # partition values come back last; restore the declared column order
        return spark.read.schema(full).parquet(f"{out}/{table}").select(*schema.fieldNames())
    return spark.read.parquet(f"{out}/{table}").drop("run_id", "batch_id")


def compact_history(spark: SparkSession, out: str, target: int = history.TARGET) -> int:
    """Packs the small files of each day of the alert history (K6); files made. Run it now and
    then, also beside the stream."""
    if not _exists(spark, f"{out}/alertes"):
        return 0
    column, schema = DATE_PARTITIONED["alertes"]
    return history.compact(spark, f"{out}/alertes", StructType(schema.fields + _PLACE), column, target)


def _latest_rows(rows: DataFrame, table: str) -> DataFrame:
    """The row that counts for each key of a state table, with its run and batch."""
    key, order = STATE_TABLES[table]
    fields = [c for c in rows.columns if c != key]
    return rows.groupBy(key).agg(F.max_by(F.struct(*fields), F.struct(*order)).alias("m")).select(key, "m.*")


# State tables: key, and what makes a row later than another.
STATE_TABLES = {
    "latest": ("patient_key", ["timestamp", "mesure_id", "run_id", "batch_id"]),
    "compteurs": ("patient_id", ["run_id", "batch_id"]),
}


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def _read_state(spark: SparkSession, out: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{out}/{table}").withColumn("run_id", F.col("run_id").cast("string"))


def compact_state(spark: SparkSession, out: str, table: str) -> None:
    """Replace all batches of a state table but the newest by one snapshot of what counts.

    The snapshot is added to the second newest batch's folder first and the folders before it
    are removed afterwards: at every moment the readers find at least one copy of each row,
    and copies don't matter to them. Run it now and then beside the stream: it doesn't touch
    the newest batch, which may still be written."""
    if not _exists(spark, f"{out}/{table}"):
        return
    rows = _read_state(spark, out, table)
    # one row per folder
    places = sorted((r[0], r[1]) for r in rows.select("run_id", "batch_id").distinct().collect())
    if len(places) < 3:
        return
    run, batch = places[-2]
    older = (F.col("run_id") < run) | ((F.col("run_id") == run) & (F.col("batch_id") < batch))
    snapshot = _latest_rows(rows.filter(older), table).drop("run_id", "batch_id")
    newer = rows.filter((F.col("run_id") == run) & (F.col("batch_id") == batch))
    key = STATE_TABLES[table][0]
    if table == "compteurs":   # a later row of the same patient wins by its place, so an older one mustn't move there
        snapshot = snapshot.join(newer.select(key), key, "left_anti")
    snapshot.write.mode("append").parquet(_folder(out, table, batch, run))
    for old_run, old_batch in places[:-2]:
        remove(spark, _folder(out, table, old_batch, old_run))


def read_latest_messages(spark: SparkSession, out: str) -> DataFrame:
    """Latest message per patient across all batches written by ``latest_state_stream``."""
    return _latest_rows(_read_state(spark, out, "latest"), "latest").drop("patient_key", "run_id", "batch_id")


def counters_stream(records: DataFrame, out: str, checkpoint: str, thresholds: al.Thresholds,
                    trigger: str | None = BATCH_INTERVAL) -> StreamingQuery:
    """Live counters (A9, A10): cumulative alert counts per patient in update mode.
    State is one row per patient; the reader sums the latest row of each patient,
    which also counts the patients monitored exactly (a streaming distinct count
    is not available, a per-key state is)."""
    msgs = decode_messages(records) if "value" in records.columns else records
    lv = al.with_patient_key(msgs.filter(al.is_valid(msgs))).select(
        "patient_id", *al.level_columns(thresholds))
    c = al.level_counts()
    state = lv.groupBy("patient_id").agg(
        F.sum(c["nb_alertes"]).cast("long").alias("alertes_total"),
        F.sum(c["nb_critiques"]).cast("long").alias("alertes_critiques"),
        F.sum(c["nb_warnings"]).cast("long").alias("alertes_warning"))

    run = run_id_of(records.sparkSession, checkpoint)

    def sink(b: DataFrame, i: int) -> None:
        _write_partition(b, out, "compteurs", i, run)

    w = (state.writeStream.outputMode("update").foreachBatch(sink)
         .option("checkpointLocation", checkpoint))
    return _trigger(w, trigger).start()


def read_counters(spark: SparkSession, out: str) -> DataFrame:
    """Totals over the latest cumulative row of every patient."""
    last = _latest_rows(_read_state(spark, out, "compteurs"), "compteurs")
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c)
    return last.agg(total("alertes_total"), total("alertes_critiques"), total("alertes_warning"),
                    F.count("patient_id").alias("patients_surveilles"))


# ------------------------------------------------------------------ latest state that survives a reset

# What runs in Python workers is made inside functions: it is then sent to them whole, and they
# need none of this package.

def latest_processor() -> StatefulProcessor:
    """Keeps the latest message of a patient and emits it when it changes. The state is one
    message a patient; it starts from a stored snapshot where there is one."""
    schema, names = schemas.MESSAGE, schemas.MESSAGE.fieldNames()
    at = [names.index(c) for c in ("timestamp", "mesure_id")]

    def order(message) -> tuple:
        # as max_by orders: missing values first
        return tuple((message[i] is not None, message[i] or "") for i in at)

    class Latest(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.last = handle.getValueState("last", schema)

        def handleInputRows(self, key, rows, timerValues):  # noqa: N802, N803 - Spark's names
            newest = max((tuple(r[n] for n in names) for r in rows), key=order)
            held = self.last.get() if self.last.exists() else None
            if held is None or order(held) < order(newest):
                self.last.update(newest)
                yield Row(**dict(zip(["patient_key", *names], (key[0], *newest))))

        def handleInitialState(self, key, initialState, timerValues) -> None:  # noqa: N802, N803
            self.last.update(tuple(initialState[n] for n in names))

        def close(self) -> None:
            pass

    return Latest()


def latest_of_batches():
    """A function that keeps the latest message of each patient in every Arrow batch: a patient
    with a third of all messages sends one row a batch to its state, not all of them."""
    keys = [(c, "ascending") for c in ("patient_key", "timestamp", "mesure_id")]

    def run(batches):
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            if len(rows):
                rows = rows.take(pc.sort_indices(rows, sort_keys=keys, null_placement="at_start"))
                # as numbers: messages without a patient are one patient's, as in a grouping
                key = rows.column("patient_key").combine_chunks().dictionary_encode(null_encoding="encode").indices
                last = pc.not_equal(key.slice(1), key.slice(0, len(key) - 1)).to_pylist() + [True]
                yield from rows.filter(pa.array(last)).to_batches()

    return run


def resumable_state_stream(records: DataFrame, out: str, checkpoint: str,
                           trigger: str | None = BATCH_INTERVAL) -> StreamingQuery:
    """The latest-message job (A11, T9) on Spark's arbitrary stateful operator. Under a new
    checkpoint its state starts from what ``out`` holds (all runs before, compacted or not), so
    after a reset it goes on as if never interrupted: messages older than the stored ones change
    and write nothing. State and snapshot have one row per patient."""
    spark = records.sparkSession
    msgs = decode_messages(records) if "value" in records.columns else records
    names = schemas.MESSAGE.fieldNames()
    keyed = msgs.filter(al.is_valid(msgs)).select(normalise_patient_id(F.col("patient_id")).alias("patient_key"), *names)
    row = StructType([StructField("patient_key", StringType()), *schemas.MESSAGE.fields])
    stored = _snapshot(spark, out).select(*row.fieldNames())
    changed = (keyed.mapInArrow(latest_of_batches(), row).groupBy("patient_key")
               .transformWithState(latest_processor(), row, "Update", "None", initialState=stored.groupBy("patient_key")))
    run = run_id_of(spark, checkpoint)

    def sink(b: DataFrame, i: int) -> None:
        _write_partition(b, out, "latest", i, run)

    w = changed.writeStream.outputMode("update").foreachBatch(sink).option("checkpointLocation", checkpoint)
    with store_with_column_families(spark):
        return _trigger(w, trigger).start()


_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_PROVIDERS = "org.apache.spark.sql.execution.streaming.state."
_starting = threading.Lock()


@contextlib.contextmanager
def store_with_column_families(spark: SparkSession) -> Iterator[None]:
    """Queries started inside use RocksDB where the session has Spark's default state store: the
    arbitrary stateful operator needs column families, which the default lacks. A query keeps
    the settings it started with; those of the session come back, and another store that was
    chosen stays."""
    with _starting:     # the setting is the session's: two queries starting at once must not undo each other's
        before = spark.conf.get(_PROVIDER, f"{_PROVIDERS}HDFSBackedStateStoreProvider")
        if before != f"{_PROVIDERS}HDFSBackedStateStoreProvider":
            yield
            return
        spark.conf.set(_PROVIDER, f"{_PROVIDERS}RocksDBStateStoreProvider")
        try:
            yield
        finally:
            spark.conf.set(_PROVIDER, before)


def _snapshot(spark: SparkSession, out: str) -> DataFrame:
    """One row per patient of the stored state, empty if there is none."""
    if _exists(spark, f"{out}/latest"):
        return _latest_rows(_read_state(spark, out, "latest"), "latest")
    return spark.createDataFrame([], StructType([StructField("patient_key", StringType()), *schemas.MESSAGE.fields]))


# ------------------------------------------------------------------ publishing messages in order

def publish_stream(observations: DataFrame, out: str, checkpoint: str, partitions: int = 32,
                   trigger: str | None = BATCH_INTERVAL, sink=None) -> StreamingQuery:
    """Publishes observations as wire records keyed by patient (K3, T8). All records of a key
    are in one of ``partitions`` partitions, in the order of time; a batch published again
    replaces itself. ``sink(records, run, batch)`` writes (default: files below
    ``<out>/messages``; a broker's writer takes the same ``key`` and ``value``)."""
    run = run_id_of(observations.sparkSession, checkpoint)
    write = sink or (lambda records, run, batch: _write_partition(records, out, "messages", batch, run))
    w = (observations.writeStream.foreachBatch(lambda b, i: write(ordered_records(b, partitions), run, i))
         .option("checkpointLocation", checkpoint))
    return _trigger(w, trigger).start()


def ordered_records(observations: DataFrame, partitions: int) -> DataFrame:
    """``key, value, partition, position``: encoded messages dealt by key; within a partition
    ``position`` rises in the order of key and time. The records of a key are one run."""
    time = F.from_json("value", schemas.MESSAGE)
    dealt = (encode_messages(observations).withColumn("_m", F.struct(time["timestamp"], time["mesure_id"]))
             .repartition(partitions, "key").sortWithinPartitions("key", "_m"))
    place = F.monotonically_increasing_id()
    return dealt.withColumn("_at", place).select(
        "key", "value", F.shiftright("_at", 33).cast("int").alias("partition"),
        F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)).alias("position"))


def read_published(spark: SparkSession, out: str) -> DataFrame:
    """The published records with their place: ``run_id, batch_id, partition, position`` order the
    records of a key as they were published."""
    schema = "key string, value string, partition int, position long, run_id string, batch_id long"
    return spark.read.schema(schema).parquet(f"{out}/messages")
