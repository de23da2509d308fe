"""The streaming application: measurements in, alert tables and live state out.

    python -m vigilo.streaming.app --bootstrap HOST:9092 --patients P --out DIR
    python -m vigilo.streaming.app --source-dir DIR --source-format csv ...   (replay files)

Starts four queries on the same source, each with its own checkpoint below
``--checkpoint`` (default: ``<spark.checkpoint.dir>/vigilo-stream``):

* alerts          alert history, patient updates, rejects, per-batch counts
* latest state    latest message per patient (stateful, update mode)
                  with ``--resumable`` on the stateful operator that starts from the stored state
* counters        cumulative alert counters per patient (stateful, update mode)
* live view       recent alerts and latest states, committed together batch by batch

Every ``--compact-minutes`` the stored tables are compacted beside the queries.
The patient profile is read once at start (CSV with header, or Parquet).
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from vigilo import schemas
from vigilo.session import shared_dir
from vigilo.sources import files, stream
from vigilo.sources.reference_tables import THRESHOLD_ROWS
from vigilo.streaming import jobs, live


def source(spark: SparkSession, a) -> DataFrame:
    """Wire records from Kafka, or replayed files (JSON wire records / CSV observations)."""
    if a.bootstrap:
        return stream.kafka_values(spark, a.bootstrap, a.topic, a.starting_offsets, a.min_partitions,
                                   a.max_offsets)
    if a.source_format == "csv":
        obs = stream.file_stream(spark, a.source_dir, schemas.OBSERVATIONS, fmt="csv",
                                 max_files_per_trigger=a.max_files, header=True, sep=",")
        return stream.encode_messages(obs)
    return stream.file_stream(spark, a.source_dir, "key string, value string", fmt="json",
                              max_files_per_trigger=a.max_files)


def patients_table(spark: SparkSession, path: str | None) -> DataFrame:
    """Profiles: CSV (`;`, header) or Parquet; an absent table gives no profile."""
    if path and path.endswith(".csv"):
        return files.load_optional(spark, path, schemas.PATIENTS, reader=files.scan_patients)
    return files.load_optional(spark, path, schemas.PATIENTS)


def thresholds_table(spark: SparkSession, path: str | None):
    """Thresholds from a table (Parquet, or comma-separated text without header as
    the original table is stored); the built-in fixed rows when no path is given."""
    if not path:
        return THRESHOLD_ROWS
    if path.endswith(".parquet"):
        return files.read_table(spark, path, schemas.THRESHOLDS)
    return files.read_delimited(spark, path, schemas.THRESHOLDS, sep=",", header=False)


def start(spark: SparkSession, a) -> list:
    ck = (a.checkpoint or f"{shared_dir(spark)}/vigilo-stream").rstrip("/")
    trigger = a.trigger
    rules = thresholds_table(spark, a.thresholds)
    q_alerts = jobs.alert_stream(source(spark, a), f"{a.out}/alertes_job", f"{ck}/alertes",
                                 rules, patients_table(spark, a.patients), trigger=trigger,
                                 dedup=a.dedup)
    latest = jobs.resumable_state_stream if a.resumable else jobs.latest_state_stream
    q_state = latest(source(spark, a), f"{a.out}/etat", f"{ck}/etat", trigger=trigger)
    q_count = jobs.counters_stream(source(spark, a), f"{a.out}/compteurs_job", f"{ck}/compteurs",
                                   rules, trigger=trigger)
    q_live = live.live_stream(source(spark, a), f"{a.out}/direct", f"{ck}/direct", rules, trigger=trigger)
    return [q_alerts, q_state, q_count, q_live]


def compact(spark: SparkSession, out: str) -> None:
    """Compacts what the queries have stored so far; they may go on meanwhile."""
    jobs.compact_history(spark, f"{out}/alertes_job")
    jobs.compact_state(spark, f"{out}/etat", "latest")
    jobs.compact_state(spark, f"{out}/compteurs_job", "compteurs")


def parse(argv: list[str] | None = None):
    ap = argparse.ArgumentParser(description=__doc__.split("\n\n")[0])
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--bootstrap", help="Kafka bootstrap servers")
    src.add_argument("--source-dir", help="folder of replayed files")
    ap.add_argument("--topic", default=stream.TOPIC)
    ap.add_argument("--starting-offsets", default="latest")
    ap.add_argument("--min-partitions", type=int, help="Spark tasks per micro-batch at least")
    ap.add_argument("--source-format", default="json", choices=["json", "csv"])
    ap.add_argument("--max-files", type=int, help="files of a micro-batch (default: bounded by bytes)")
    ap.add_argument("--max-offsets", type=int, default=stream.MAX_OFFSETS, help="Kafka records of a micro-batch")
    ap.add_argument("--patients")
    ap.add_argument("--thresholds", help="thresholds table (default: the built-in fixed rows)")
    ap.add_argument("--out", required=True)
    ap.add_argument("--checkpoint")
    ap.add_argument("--trigger", default=jobs.BATCH_INTERVAL,
                    help="processing-time interval, or availableNow")
    ap.add_argument("--dedup", action="store_true", help="leave out measurements delivered again")
    ap.add_argument("--resumable", action="store_true", help="latest state that goes on after a lost checkpoint")
    ap.add_argument("--compact-minutes", type=float, default=60.0, help="time between compactions")
    return ap.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    a = parse(argv)
    spark = SparkSession.builder.appName("vigilo-stream").getOrCreate()
    queries = start(spark, a)
    if a.trigger == "availableNow":
        for q in queries:
            q.awaitTermination()
        compact(spark, a.out)
    else:
        while not spark.streams.awaitAnyTermination(int(60 * a.compact_minutes)):
            compact(spark, a.out)


if __name__ == "__main__":
    main()
