"""File sources and sinks of the batch pipeline.

Delimited text is read with an explicit schema (columns bind by position,
no inference). Text inputs are converted once; everything downstream reads
Parquet (vectorised, predicate pushdown, column pruning).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilo import schemas
from vigilo.operators.quality import drop_header_rows
from vigilo.sources import versions


# Null marker of stored text tables (Hive's text default), so '' and null stay distinct.
TEXT_NULL = "\\N"


def read_delimited(spark: SparkSession, path: str, schema, sep: str = ";",
                   header: bool = True, null_value: str | None = None) -> DataFrame:
    """Typed delimited text. Unparsable fields become null (permissive mode)."""
    r = (spark.read.schema(schema).option("sep", sep).option("header", header)
         .option("mode", "PERMISSIVE").option("encoding", "UTF-8"))
    if null_value is not None:
        r = r.option("nullValue", null_value)
    return r.csv(path)


def scan_patients(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    return drop_header_rows(read_delimited(spark, path, schemas.PATIENTS, ";", header), "patient_id")


def scan_signals(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    return drop_header_rows(read_delimited(spark, path, schemas.SIGNALS, ";", header), "mesure_id")


def scan_sensors(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    return drop_header_rows(read_delimited(spark, path, schemas.SENSORS, ";", header), "capteur_id")


def scan_observations(spark: SparkSession, path: str) -> DataFrame:
    """Replayable observation file: ``,``-separated with a header, 20 columns."""
    return drop_header_rows(read_delimited(spark, path, schemas.OBSERVATIONS, ",", True), "mesure_id")


def scan_enriched(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The enriched measurement table (S5): Parquet (possibly partitioned by day),
    or ``;`` text without header."""
    if fmt == "parquet":
        return read_table(spark, path, schemas.ENRICHED)
    return read_delimited(spark, path, schemas.ENRICHED, ";", False, null_value=TEXT_NULL)


def read_table(spark: SparkSession, path: str, schema) -> DataFrame:
    """A Parquet table read with its declared schema: partition values keep their
    declared type (no inference) and columns come back in declared order."""
    if versions.is_versioned(spark, path):
        return versions.read(spark, path, schema)
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())


def _save(writer, path: str, fmt: str) -> None:
    if fmt == "parquet":
        writer.parquet(path)
    else:
        writer.option("sep", ";").option("header", False).option("nullValue", TEXT_NULL).csv(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: str | None = None) -> None:
    """Persist a result (K1). ``fmt='text'`` writes ``;``-separated rows with no header.

    ``partition_by`` lays the table out in one folder per value (a day), so a
    reader filtering on it prunes the other folders; rows of a day are brought
    together first (``rebalance``: large days are split by size, small ones
    merged), so a day has few files however many tasks write.
    """
    w = df.hint("rebalance", partition_by).write.partitionBy(partition_by) if partition_by else df.write
    _save(w.mode(mode), path, fmt)


def replace_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: str | None = None,
                  only: list[str] | None = None) -> int:
    """Drop and create as (K2): ``df`` becomes the next version of the table, published by one
    atomic entry after it is written; a failed write leaves the table as it was. With ``only``
    (partition values) just those partitions are replaced, one without rows any more is gone."""
    return versions.replace(df, path, partition_by, only, write=lambda w, folder: _save(w, folder, fmt))


def ingest_signals(signals: DataFrame, path: str, days: list[str] | None = None) -> None:
    """Measurements (as scanned from text) kept as Parquet by day, so that a later run on some
    days reads those days only. ``days``: replace only these."""
    replace_table(signals.filter(F.col("date").isin(days)) if days is not None else signals, path,
                  partition_by="date", only=days)


def scan_ingested_signals(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, schemas.SIGNALS)


def footer_session(spark: SparkSession) -> SparkSession:
    """A session of the same application in which a count of a Parquet table comes from the
    files' footers (aggregate push-down of the version 2 source): no column is read."""
    own = spark.newSession()
    version1 = own.conf.get("spark.sql.sources.useV1SourceList").split(",")
    own.conf.set("spark.sql.sources.useV1SourceList", ",".join(s for s in version1 if s.strip() != "parquet"))
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return own


def load_optional(spark: SparkSession, path: str | None, schema, reader=None) -> DataFrame:
    """A dimension that may be missing (profiles, centres: T7): an empty DataFrame of
    the right schema when the path does not exist or cannot be read."""
    if path:
        try:
            df = reader(spark, path) if reader else spark.read.schema(schema).parquet(path)
            df.schema  # resolve now so a missing path fails here
            return df
        except Exception as e:  # noqa: BLE001 - a missing dimension is tolerated by design
            if "PATH_NOT_FOUND" not in str(e) and "does not exist" not in str(e):
                raise
    return spark.createDataFrame([], schema)
