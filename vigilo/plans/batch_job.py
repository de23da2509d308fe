"""The batch pipeline as one Spark job: ETL, KPI tables, dashboard view, counts.

    python -m vigilo.plans.batch_job --patients P --signals S --sensors C --out DIR

Inputs are the `;`-separated files with a header row (patients, vital
signals, sensors). With ``--ingest DIR`` the signals are first kept there as
Parquet by day; ``--signals DIR --ingested`` then reads them from there, and a
run on some days reads those days only (text can't be skipped). Outputs (Parquet, or `;` text with ``--format text``):

* ``mesures_patients``        enriched measurements (36 columns)         K1
* ``kpi1_moyennes_vitaux`` … ``kpi4_oxygenation``                        K2
* ``vue_dashboard_patient``   patient-day dashboard
* ``comptages``               row count per table                         A12

The enriched table is written once and read back (the lineage is cut there,
as between the two original jobs); the shared patient-day aggregation is
written once as well, and every KPI table and the view are projections of it.
Tables are partitioned by day; ``--days`` recomputes only those days and
replaces only their partitions (a day without rows any more loses its
partition). Each write is a single Spark job (a lost executor only reruns its
tasks) that makes a new version of its table, published by one atomic entry when
it has ended: a run that fails leaves every table it didn't finish as it was.
``read`` gives the newest version of a table, ``register`` all of them as views.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from vigilo import schemas
from vigilo.operators import enrich, kpis
from vigilo.sources import files, versions

VIEW = "vue_dashboard_patient"
KPI_TABLES = {
    "kpi1_moyennes_vitaux": kpis.kpi1_daily_vitals,
    "kpi2_hypertension": kpis.kpi2_hypertension,
    "kpi3_stabilite_cardiaque": kpis.kpi3_cardiac_stability,
    "kpi4_oxygenation": kpis.kpi4_oxygenation,
    VIEW: kpis.dashboard_view,
}

COUNTS = StructType([StructField("table_name", StringType()), StructField("nb_lignes", LongType())])


def run(spark: SparkSession, patients: DataFrame, signals: DataFrame, sensors: DataFrame,
        out: str, fmt: str = "parquet", days: list[str] | None = None) -> dict[str, str]:
    """Run the batch job; returns table name → path.

    Tables are partitioned by day (``date_mesure``). KPI groups are patient-days,
    so a day's rows depend only on that day's measurements: with ``days`` only
    those days are recomputed and only their partitions are replaced (the
    measurement filter reaches the scan); without, everything is rebuilt.
    """
    out = out.rstrip("/")
    day = "date_mesure"
    if days is not None:
        days = list(days)
        signals = signals.filter(F.col("date").isin(days))
    some = lambda df: df if days is None else df.filter(F.col(day).isin(days))

    paths = {"mesures_patients": f"{out}/mesures_patients"}
    files.replace_table(enrich.enriched(signals, sensors, patients), paths["mesures_patients"],
                        partition_by=day, only=days)
    stored = some(files.scan_enriched(spark, paths["mesures_patients"]))          # partition pruning

    stats_path = f"{out}/_patient_day_stats"
    new_stats = kpis.patient_day_stats(stored)
    files.replace_table(new_stats, stats_path, partition_by=day, only=days)
    stats = some(files.read_table(spark, stats_path, new_stats.schema))

    footers = files.footer_session(spark)
    counted = {"mesures_patients": versions.scans(footers, paths["mesures_patients"], schemas.ENRICHED)}
    for name, build in KPI_TABLES.items():
        paths[name] = f"{out}/{name}"
        table = build(stats)
        files.replace_table(table, paths[name], fmt=fmt, partition_by=day, only=days)
        if name != VIEW:
            counted[name] = (versions.scans(footers, paths[name], table.schema) if fmt == "parquet"
                             else [read_kpi_table(footers, paths[name], table.schema, fmt)])
    paths["comptages"] = f"{out}/comptages"
    files.replace_table(kpis.stored_counts(counted), paths["comptages"], fmt=fmt)
    if fmt != "parquet":
        files.replace_table(stored, f"{out}/mesures_patients_texte", fmt=fmt, partition_by=day, only=days)
    return paths


def read_kpi_table(spark: SparkSession, path: str, schema, fmt: str = "parquet") -> DataFrame:
    """A KPI table as written by :func:`run`."""
    if fmt == "parquet":
        return files.read_table(spark, path, schema)
    # the partition column stands in the folder names, not in the lines
    lines = [f for f in schema.fields if f.name != "date_mesure"] + [schema["date_mesure"]]
    return versions.read(spark, path, schema, load=lambda r, folders: r.schema(type(schema)(lines)).option("sep", ";")
                         .option("header", False).option("nullValue", files.TEXT_NULL).csv(folders))


def read(spark: SparkSession, out: str, name: str) -> DataFrame:
    """The newest version of a stored Parquet table of :func:`run`."""
    return files.read_table(spark, f"{out.rstrip('/')}/{name}", table_schemas(spark)[name])


def table_schemas(spark: SparkSession) -> dict:
    stats = kpis.patient_day_stats(spark.createDataFrame([], schemas.ENRICHED))
    found = {"mesures_patients": schemas.ENRICHED, "_patient_day_stats": stats.schema}
    found |= {name: build(stats).schema for name, build in KPI_TABLES.items()}
    return found | {"comptages": COUNTS}


def register(spark: SparkSession, out: str) -> list[str]:
    """The newest versions of the stored tables as temporary views of the same names."""
    names = [n for n in table_schemas(spark) if not n.startswith("_")]
    for name in names:
        read(spark, out, name).createOrReplaceTempView(name)
    return names


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.split("\n\n")[0])
    ap.add_argument("--patients", required=True)
    ap.add_argument("--signals", required=True)
    ap.add_argument("--sensors", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--format", default="parquet", choices=["parquet", "text"])
    ap.add_argument("--days", help="comma-separated yyyy-MM-dd days to recompute (default: all)")
    ap.add_argument("--ingest", help="folder in which to keep the signals as Parquet by day first")
    ap.add_argument("--ingested", action="store_true", help="--signals is such a folder")
    a = ap.parse_args(argv)
    spark = SparkSession.builder.appName("vigilo-batch").getOrCreate()
    days = [d.strip() for d in a.days.split(",")] if a.days else None
    if a.ingest:
        files.ingest_signals(files.scan_signals(spark, a.signals), a.ingest, days)
    if a.ingest or a.ingested:
        signals = files.scan_ingested_signals(spark, a.ingest or a.signals)
    else:
        signals = files.scan_signals(spark, a.signals)
    paths = run(spark, files.scan_patients(spark, a.patients), signals,
                files.scan_sensors(spark, a.sensors), a.out, a.format, days)
    for name, path in paths.items():
        print(f"{name}\t{path}")


if __name__ == "__main__":
    main()
