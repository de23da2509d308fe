"""Measurements per micro-batch (A13): observed while the batch runs, stored when it is reported.

``observed`` adds aggregates to a stream that Spark computes along with the batch (no second
pass, no job of their own). A listener receives them with the progress of every batch and
keeps them as numbered entries, one folder a run; a batch reported again has the same entry.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from vigilo.operators import alerts as al
from vigilo.sources.versions import Conflict, Log

NAME = "mesures"
_SCHEMA = "lot long, nb_mesures long, nb_rejets long, run_id string"


def observed(msgs: DataFrame) -> DataFrame:
    """A stream of decoded messages whose batches report their measurements and rejects."""
    one = F.lit(1)
    return msgs.observe(NAME, F.count(one).alias("nb_mesures"), F.count_if(~al.is_valid(msgs)).alias("nb_rejets"))


class BatchCounts(StreamingQueryListener):
    """Stores the counts of the batches of the queries it is told of."""

    def __init__(self, spark: SparkSession):
        self.spark, self.of, self.ended = spark, {}, {}

    def watch(self, name: str, folder: str) -> None:
        """The query of this name, before it starts; its counts go to ``folder``."""
        self.of[name] = Log(self.spark, folder)

    def onQueryStarted(self, event) -> None:  # noqa: N802 - Spark's names
        if event.name in self.of:
            self.ended[str(event.id)] = threading.Event()

    def onQueryProgress(self, event) -> None:  # noqa: N802
        progress = event.progress
        counts = progress.observedMetrics.get(NAME)
        if progress.name not in self.of or counts is None:
            return
        entry = {"lot": progress.batchId, **counts.asDict()}
        try:
            self.of[progress.name].append(progress.batchId, entry)
        except Conflict:        # reported again, with the same counts
            pass

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        done = self.ended.get(str(event.id))
        if done:
            done.set()

    def wait(self, query, seconds: float = 60) -> None:
        """Until everything about an ended query has been reported."""
        done = self.ended.get(str(query.id))
        if done and not done.wait(seconds):
            raise TimeoutError(f"no end of query {query.id} was reported")


def read_counts(spark: SparkSession, folder: str) -> DataFrame:
    """The stored counts below ``folder``: one row per run and batch."""
    return spark.read.schema(_SCHEMA).json(folder)

