"""Compaction of the alert history (K6), safe beside its writer and its readers.

A stream leaves a small file per batch and day. ``compact`` packs a day's small files into bins
of about ``TARGET`` bytes (first fit, largest first), rewrites each bin as one file, and makes
one entry of a log: the files that count no more and the folders that now count. Readers go by
the newest entry. The files of an entry are deleted by the next compaction, so a reader that
resolved the table before goes on. The newest batch is left alone: it may be written again.
"""

from __future__ import annotations

import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilo.sources.versions import Log

#: Bytes of a packed file; files of half of that or more stay as they are.
TARGET = 128 << 20
_MADE = "run_id=merged"


def _log(spark: SparkSession, table: str) -> Log:
    return Log(spark, f"{table}/_commits")


def _files(spark: SparkSession, table: str) -> dict[str, int]:
    """Data files below ``table`` (relative) and their bytes."""
    path = spark._jvm.org.apache.hadoop.fs.Path(table)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    root = fs.makeQualified(path).toString().rstrip("/") + "/"
    found, out = fs.listFiles(path, True), {}
    while found.hasNext():
        f = found.next()
        name = f.getPath().toString().removeprefix(root)
        if not any(part.startswith(("_", ".")) for part in name.split("/")):
            out[name] = f.getLen()
    return out


def _counting(spark: SparkSession, table: str) -> dict[str, int]:
    """The files that make up the table."""
    entry = _log(spark, table).latest()[1] or {"gone": [], "made": []}
    gone, made = set(entry["gone"]), tuple(f"{m}/" for m in entry["made"])
    return {f: n for f, n in _files(spark, table).items()
            if f not in gone and (not f.startswith(f"{_MADE}/") or f.startswith(made))}


def is_compacted(spark: SparkSession, table: str) -> bool:
    return bool(_log(spark, table).numbers())


def read(spark: SparkSession, table: str, schema) -> DataFrame:
    """The table as of the newest entry, with ``run_id`` and ``batch_id`` in ``schema``."""
    there, counting = _by_batch(_files(spark, table)), _by_batch(_counting(spark, table))
    # a batch's folder as a whole where all of its files count
    paths = [p for folder, own in sorted(counting.items()) for p in ([folder] if own == there[folder] else own)]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", table).parquet(*[f"{table}/{p}" for p in paths])


def _by_batch(names) -> dict[str, list[str]]:
    out: dict[str, list[str]] = {}
    for name in sorted(names):
        out.setdefault("/".join(name.split("/")[:2]), []).append(name)
    return out


def _place(name: str) -> tuple[str, int]:
    run, batch = name.split("/")[:2]
    return run, int(batch.split("=")[1])


def pack(sizes: dict[str, int], target: int) -> list[list[str]]:
    """First fit, largest first: bins of at most ``target`` bytes with two files or more."""
    bins: list[tuple[int, list[str]]] = []
    for name in sorted((f for f, n in sizes.items() if 2 * n < target), key=lambda f: (-sizes[f], f)):
        for i, (used, own) in enumerate(bins):
            if used + sizes[name] <= target:
                bins[i] = (used + sizes[name], [*own, name])
                break
        else:
            bins.append((sizes[name], [name]))
    return [own for _, own in bins if len(own) > 1]


def compact(spark: SparkSession, table: str, schema, by: str, target: int = TARGET) -> int:
    """Packs the small files of every value of ``by`` (a partition folder); files made."""
    log = _log(spark, table)
    n, before = log.latest()
    counting = _counting(spark, table)
    before = before or {"gone": [], "made": []}
    for name in before["gone"]:
        log.fs.delete(log.jvm.org.apache.hadoop.fs.Path(f"{table}/{name}"), False)
    written = [_place(f) for f in counting if not f.startswith(_MADE)]
    newest = max(written, default=None)
    groups: dict[str, dict[str, int]] = {}
    for name, size in counting.items():
        if _place(name) != newest:
            value = next(p for p in name.split("/") if p.startswith(f"{by}="))
            groups.setdefault(value, {})[name] = size
    bins = [b for _, sizes in sorted(groups.items()) for b in pack(sizes, target)]
    if not bins:
        return 0
    folder = f"{_MADE}/batch_id={n + 1}"
    aside = f"{table}/{folder}"
    if log.fs.exists(log.jvm.org.apache.hadoop.fs.Path(aside)):      # left by a compaction that failed
        folder = f"{_MADE}/batch_id={n + 1}{uuid.uuid4().int % 10 ** 8:08d}"
        aside = f"{table}/{folder}"
    # one row per file that is packed
    of = spark.createDataFrame([(f, i) for i, own in enumerate(bins) for f in own], "_file string, _bin int")
    names = [f for own in bins for f in own]
    rows = spark.read.schema(schema).option("basePath", table).parquet(*[f"{table}/{f}" for f in names])
    path = F.col("_metadata.file_path")
    # the part of the path below the table, as it was listed
    rows = rows.withColumn("_file", _decoded(F.element_at(F.split(path, f"/{_name(table)}/"), -1)))
    rows = rows.join(F.broadcast(of), "_file").drop("_file", "run_id", "batch_id")
    (rows.repartitionByRange(len(bins), "_bin").drop("_bin").write.partitionBy(by).parquet(aside))
    log.append(n + 1, {"gone": names, "made": [*before["made"], folder]})
    for k in log.numbers()[:-2]:
        log.forget(k)
    return len(bins)


def _name(table: str) -> str:
    return table.rstrip("/").rsplit("/", 1)[-1]


def _decoded(path):
    """A file path of the scan (a URI) as the file system lists it."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def days(spark: SparkSession, table: str, by: str) -> dict[str, int]:
    """Files per value of ``by``."""
    out: dict[str, int] = {}
    for f in _counting(spark, table):
        value = unquote(next(p for p in f.split("/") if p.startswith(f"{by}=")).split("=", 1)[1])
        out[value] = out.get(value, 0) + 1
    return out
