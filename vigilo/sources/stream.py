"""Measurement stream: sources, wire encoding and decoding.

On the wire a measurement is a JSON object keyed by patient id. Production
reads it from Kafka; tests and the registered queries replay files through
the same encode → decode path (the Kafka connector jar is not bundled).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType, IntegerType

from vigilo import schemas
from vigilo.functions.vitals import DEFAULT_SOURCE
from vigilo.session import fresh_path

TOPIC = "mesures-patients"
# Bounds of one micro-batch: Kafka records, and bytes of replayed files.
MAX_OFFSETS = 20_000_000
MAX_BYTES = 16 << 30


def kafka_values(spark: SparkSession, bootstrap: str, topic: str = TOPIC,
                 starting_offsets: str = "latest", min_partitions: int | None = None,
                 max_offsets_per_trigger: int | None = MAX_OFFSETS) -> DataFrame:
    """Raw Kafka records (``key``, ``value`` binary) as a stream.
    Needs the spark-sql-kafka connector on the classpath at submit time.
    ``min_partitions`` splits large topic partitions into several Spark tasks
    (a one-partition topic otherwise runs each micro-batch in one task) without
    a shuffle. ``max_offsets_per_trigger`` bounds a micro-batch after a backlog; nothing
    is lost, the rest comes in the next ones."""
    r = (spark.readStream.format("kafka")
         .option("kafka.bootstrap.servers", bootstrap)
         .option("subscribe", topic)
         .option("startingOffsets", starting_offsets))
    if min_partitions:
        r = r.option("minPartitions", min_partitions)
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return r.load()


def file_stream(spark: SparkSession, path: str, schema, fmt: str = "parquet",
                max_files_per_trigger: int | None = None, max_bytes_per_trigger: int = MAX_BYTES,
                **options) -> DataFrame:
    """Files arriving in a folder (or matching a glob) as a stream (S14); a micro-batch
    is bounded by bytes, or by a number of files where that is given."""
    r = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    else:
        r = r.option("maxBytesPerTrigger", max_bytes_per_trigger)
    for k, v in options.items():
        r = r.option(k, v)
    return r.load(path)


def encode_messages(observations: DataFrame, source: str = DEFAULT_SOURCE) -> DataFrame:
    """Observation rows → (``key`` = patient id, ``value`` = JSON message) (K3).

    The message carries the 16 stream fields; a field whose column is absent
    gets the typed default (``""`` or ``0``; the id ``RT_%05d`` by position).
    Values are cast with ``try_cast`` so a malformed cell gives null.
    ``source`` is always set to the producer's constant.
    """
    cols = set(observations.columns)
    df = observations
    if "mesure_id" not in cols:
        df = with_row_index(df, "_pos")
    fields = []
    for f in schemas.MESSAGE.fields:
        if f.name == "source":
            fields.append(F.lit(source).alias("source"))
        elif f.name in cols:
            fields.append(F.col(f.name).try_cast(f.dataType).alias(f.name))
        elif f.name == "mesure_id":
            fields.append(F.format_string("RT_%05d", F.col("_pos")).alias("mesure_id"))
        elif isinstance(f.dataType, (FloatType, IntegerType)):
            fields.append(F.lit(0).cast(f.dataType).alias(f.name))
        else:
            fields.append(F.lit("").alias(f.name))
    msg = F.struct(*fields)
    return df.select(
        msg["patient_id"].alias("key"),
        F.to_json(msg, {"ignoreNullFields": "false"}).alias("value"),
    )


def decode_messages(records: DataFrame) -> DataFrame:
    """``value`` (bytes or string) → the 16 typed message columns.
    Malformed JSON gives an all-null row; a wrongly typed field gives null."""
    return (records.select(F.from_json(F.col("value").cast("string"), schemas.MESSAGE,
                                       {"mode": "PERMISSIVE"}).alias("m"))
            .select("m.*"))


def with_row_index(df: DataFrame, name: str) -> DataFrame:
    """Sequential 0-based position in scan order, computed without a single-task
    window: count rows per partition, prefix-sum the (few) partition counts,
    add the offset inside each partition.

    The rows are written with their partition and place first, and counted from the
    written table: a second evaluation of ``df`` (with fewer columns, or after AQE
    coalesced otherwise) need not have the same partitions."""
    spark = df.sparkSession
    tagged = _stored(df.withColumn("_mid", F.monotonically_increasing_id()), fresh_path(spark, "indexed"))
    part = F.shiftright("_mid", 33)        # the id holds partition and place in it
    starts = _stored(tagged.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
                     .select("_part", (F.sum("_n").over(_by_part()) - F.col("_n")).alias("_start")),
                     fresh_path(spark, "indexed-starts"))          # one row per partition
    return (tagged.withColumn("_part", part).join(starts, "_part")
            .withColumn(name, F.col("_start") + F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1)))
            .select(*df.columns, name))


def _stored(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _by_part():
    from pyspark.sql import Window
    return Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
