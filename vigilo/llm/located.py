"""Rows by the place they are read from: a few marked rows of a table found again in a later
scan without moving the others.

A row of a Parquet table is named by its file and its position in it (hidden columns of the
scan). Marks, one long per marked row, are written as short sorted lists by file below the
shared folder; a scan task loads the lists of its own files and looks its rows up. So neither
the marks pass through the driver nor do texts through a shuffle.
"""

from __future__ import annotations

import io
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilo.llm import common
from vigilo.llm.common import Scratch

#: Positions of a file that share a list.
BLOCK = 1 << 20
#: Lists that a worker keeps.
MOST_LISTS = 16


def scanned(table: DataFrame, scratch: Scratch) -> DataFrame:
    """``table`` itself if its rows are read from Parquet files as they stand, else a written copy.

    A table derived from a scan by selecting columns and rows keeps the places; one that
    repeats rows of a scan (explode, union) must be written before."""
    try:
        place(table)
        return table
    except AnalysisException:
        return scratch.written(table, "scanned")


def place(table: DataFrame) -> DataFrame:
    """``table`` of a scan with the columns ``_file`` and ``_row`` (named otherwise if taken)."""
    file, row = names(table)
    hidden = table.metadataColumn("_metadata")
    return table.select("*", hidden["file_path"].alias(file), hidden["row_index"].alias(row))


def names(table: DataFrame) -> tuple[str, str]:
    return common.unused(table, "_file"), common.unused(table, "_row")


def _list_name(file: str, block: int) -> str:
    raw = file.encode()
    return f"{zlib.crc32(raw):08x}{zlib.adler32(raw):08x}-{len(raw)}-{block}"


def write_lists(marks: DataFrame, folder: str) -> None:
    """Writes ``marks(file, row, value)`` as lists. A list holds its file's name, so that two
    files whose lists would have the same name are noticed."""
    def write(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        from pyarrow import fs
        file, block = key
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        frame = frame.sort_values("row")
        data = io.BytesIO()
        np.savez(data, of=np.frombuffer(file.encode(), np.uint8), row=frame.row.to_numpy(np.int64),
                 value=frame.value.to_numpy(np.int64))
        name = f"{root}/{_list_name(file, int(block))}"
        own = f"{name}-{TaskContext.get().taskAttemptId()}"
        with store.open_output_stream(own) as out:
            out.write(data.getvalue())
        # a repeated task has the same list: whichever stands there is right
        if store.get_file_info(name).type == fs.FileType.NotFound:
            store.move(own, name)
        return pd.DataFrame({"name": [f"{file}#{block}"], "list": [_list_name(file, int(block))]})

    made = (marks.withColumn("block", F.floor(F.col("row") / F.lit(BLOCK)).cast("long"))
            .groupBy("file", "block").applyInPandas(write, "name string, list string"))
    made.write.parquet(f"{folder}-names")
    twice = marks.sparkSession.read.schema(made.schema).parquet(f"{folder}-names").groupBy("list").count().where("count > 1")
    if not twice.isEmpty():
        raise ValueError("two files have lists of the same name")


def marked(folder: str):
    """A function of the columns file and row: the row's mark, null without one."""
    held: dict[tuple[str, int], tuple[np.ndarray, np.ndarray]] = {}

    def load(file: str, block: int):
        from pyarrow import fs
        if (file, block) not in held:
            while len(held) >= MOST_LISTS:
                held.pop(next(iter(held)))
            store, root = fs.FileSystem.from_uri(folder)
            try:
                with store.open_input_file(f"{root}/{_list_name(file, block)}") as f:
                    found = np.load(io.BytesIO(f.read()))
                mine = found["of"].tobytes() == file.encode()
            except FileNotFoundError:
                mine = False
            # without a list none of the rows is marked
            none = np.zeros(0, np.int64)
            held[file, block] = (found["row"], found["value"]) if mine else (none, none)
        return held[file, block]

    @F.pandas_udf("long")
    def value(file: pd.Series, row: pd.Series) -> pd.Series:
        out = np.zeros(len(row), np.int64)
        none = np.ones(len(row), bool)
        at = row.to_numpy(np.int64)
        codes, files = pd.factorize(file)
        blocks = at // BLOCK
        for code, block in sorted(set(zip(codes.tolist(), blocks.tolist()))):
            rows, values = load(files[code], block)
            mine = np.flatnonzero((codes == code) & (blocks == block))
            if len(rows):
                found = np.minimum(np.searchsorted(rows, at[mine]), len(rows) - 1)
                hit = rows[found] == at[mine]
                out[mine[hit]], none[mine[hit]] = values[found[hit]], False
        return pd.Series(pd.array(out, dtype="Int64")).mask(none)

    return value


def without(table: DataFrame, marks: DataFrame, scratch: Scratch) -> DataFrame:
    """``table`` (of :func:`scanned`) without the rows ``marks(file, row)``."""
    folder = scratch.path("lists")
    write_lists(marks.withColumn("value", F.lit(1).cast("long")), folder)
    file, row = names(table)
    return place(table).where(marked(folder)(F.col(file), F.col(row)).isNull()).drop(file, row)
