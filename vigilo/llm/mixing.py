"""Mixing sources to target weights by Efraimidis-Spirakis sampling (operator 7).

DataFrame functions only. Every source gets a word target by weight, capped at ``MOST``
times its own words, with the excess shared again by weight. A source's documents are taken
whole as many times as its words fit into the target (complete epochs); the rest of the
target is a weighted sample without replacement: exponential keys ``-ln(u) / weight`` in
rising order, prefix-summed up to the budget. Rows with equal keys (copies) are ordered by a
hash of their place in the files, so that a budget can end between copies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vigilo.llm import located
from vigilo.llm.common import Scratch, unused

#: Weights of the sources in code point order, repeating; null is the last source.
WEIGHTS = (5, 2, 1)
MOST = 3
#: Rows that are sorted one by one, and parts into which a range of keys is cut until the budget
#: ends in a part of no more rows.
CELL_ROWS, PARTS = 20_000, 1000
# Symbols that prose hardly has.
SYMBOLS = "#$%&*|<>{}[]\\^~`=+_@"

_SPACE = r"[\x20\x09-\x0D]"


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in ``text``; 0 for null."""
    edge = lambda c: F.ascii(c).isin(32, 9, 10, 11, 12, 13).cast("long")
    parts = F.size(F.split(text, _SPACE + "+")).cast("long")
    words = parts - edge(F.substring(text, 1, 1)) - edge(F.substring(text, -1, 1))
    return F.when(text.isNull() | (text == ""), F.lit(0).cast("long")).otherwise(words)


def quality_weight(text: Column) -> Column:
    """Sampling weight of a text, 0.05 to 1: falls with the share of its symbols."""
    n = F.greatest(F.length(text), F.lit(1))
    symbols = n - F.greatest(F.length(F.translate(text, SYMBOLS, "")), F.lit(0))
    return F.coalesce(F.greatest(F.lit(0.05), 1 - 10 * symbols / n), F.lit(0.05))


def _keyed(docs: DataFrame, names: dict[str, str], id_col: str, text_col: str, source_col: str,
           seed: int, weight: Column | None) -> DataFrame:
    """``docs`` (of :func:`located.scanned`) plus source, size, sampling key and tie-breaker."""
    text = F.col(text_col)
    of = lambda c: F.col(names[c])
    file, row = located.names(docs)
    by = located.place(docs).withColumns({
        names["source"]: F.coalesce(F.concat(F.lit("s"), F.col(source_col).cast("string")), F.lit("")),
        names["size"]: word_count(text),
        names["key"]: _uniform(F.xxhash64(F.col(id_col).cast("long"), F.xxhash64(text), F.lit(seed))),
        names["tie"]: _uniform(F.xxhash64(file, row)),
    }).drop(file, row)
    w = F.greatest(F.coalesce(weight if weight is not None else quality_weight(text), F.lit(0.0)), F.lit(1e-6))
    return by.withColumn(names["key"], -F.log(of("key")) / w)


def _uniform(hashed: Column) -> Column:
    """A hash as a number above 0 and below 1."""
    return (F.shiftrightunsigned(hashed, 11) + F.lit(0.5)) / F.lit(2.0 ** 53)


def _targets(narrow: DataFrame, scratch: Scratch) -> DataFrame:
    """One row per source: words, target, epochs and the budget of the fractional selection."""
    sums = scratch.written(narrow.groupBy("source").agg(F.sum("size").alias("source_size"),
                                                        F.count("*").alias("rows")).coalesce(1), "sources")
    # one row per source from here on
    by_name = Window.orderBy(F.when(F.col("source") == "", 1).otherwise(0), F.col("source"))
    weights = F.array(*[F.lit(float(w)) for w in WEIGHTS])
    every = Window.partitionBy(F.lit(0))
    ranked = (sums.withColumn("w", F.element_at(weights, (F.row_number().over(by_name) - 1) % len(WEIGHTS) + 1))
              .withColumn("all", F.sum("source_size").over(every))
              .withColumn("cap", F.col("source_size") * F.lit(float(MOST)))
              .withColumn("ratio", F.col("cap") / F.col("w")))
    by_ratio = Window.partitionBy(F.lit(0)).orderBy("ratio", "source")
    before = F.coalesce(F.sum("cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    left = F.sum("w").over(by_ratio.rowsBetween(0, Window.unboundedFollowing))
    level = (F.col("all") - before) / left
    shared = ranked.withColumn("level", level)
    share = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "source", "level"))).over(every)["level"]
    size = F.col("source_size")
    out = (shared.withColumn("target", F.least(F.col("cap"), F.coalesce(share, F.lit(float("inf"))) * F.col("w")))
           .withColumn("epochs", F.when(size > 0, F.least(F.floor(F.col("target") / size), F.lit(MOST))).otherwise(0).cast("int"))
           .withColumn("budget", F.greatest(F.col("target") - F.col("epochs") * size, F.lit(0.0))))
    return scratch.written(out.select("source", "source_size", "target", "epochs", "budget", "rows")
                           .coalesce(1), "targets")


def _cuts(narrow: DataFrame, targets: DataFrame, scratch: Scratch) -> DataFrame:
    """Per source the last place (key, tie) of the fractional selection.

    A source's range of keys is cut into ``PARTS`` equal parts; the part in which the budget
    ends is the next range, and where all its keys are equal (copies) its ties are cut. Only a
    range of at most ``CELL_ROWS`` rows is sorted row by row, so a source of any size, weights
    or repeated rows spreads over tasks. A range has one row per source.
    """
    own = narrow.join(targets.where("budget > 0").select("source", "budget"), "source")
    ranges = scratch.written(
        own.groupBy("source").agg(F.first("budget").alias("budget"), F.lit(0).cast("long").alias("before"), *_bounds())
        .where("words > budget").coalesce(1), "range")
    while True:
        large = (F.col("rows") > CELL_ROWS) & ((F.col("high") > F.col("low")) | (F.col("high_tie") > F.col("low_tie")))
        if ranges.where(large).isEmpty():
            break
        ranges = scratch.written(_ending(_within(narrow, ranges), ranges).coalesce(1), "range")
    order = Window.partitionBy("source").orderBy("key", "tie").rowsBetween(Window.unboundedPreceding, 0)
    middle = F.col("before") + F.sum("size").over(order) - F.col("size") / 2
    last = (_within(narrow, ranges).withColumn("middle", middle).withColumn("place", F.struct("key", "tie"))
            .groupBy("source").agg(F.min("place").alias("first"),
                                   F.max(F.when(F.col("middle") <= F.col("budget"), F.col("place"))).alias("cut")))
    return scratch.written(targets.join(last, "source", "left").coalesce(1), "cuts")


def _bounds() -> list[Column]:
    return [F.sum("size").alias("words"), F.count("*").alias("rows"), F.min("key").alias("low"), F.max("key").alias("high"),
            F.min("tie").alias("low_tie"), F.max("tie").alias("high_tie")]


def _within(narrow: DataFrame, ranges: DataFrame) -> DataFrame:
    """The rows in the range of their source."""
    inside = F.col("key").between(F.col("low"), F.col("high")) & (
        (F.col("low") < F.col("high")) | F.col("tie").between(F.col("low_tie"), F.col("high_tie")))
    return narrow.join(ranges, "source").where(inside)


def _ending(rows: DataFrame, ranges: DataFrame) -> DataFrame:
    """The part of each range in which the budget ends, as a range."""
    def part(value: str, low: str, high: str) -> Column:
        share = (F.col(value) - F.col(low)) / F.greatest(F.col(high) - F.col(low), F.lit(1e-300))
        return F.least(F.floor(share * PARTS), F.lit(PARTS - 1)).cast("int")
    number = F.when(F.col("low") < F.col("high"), part("key", "low", "high")).otherwise(part("tie", "low_tie", "high_tie"))
    parts = rows.select("source", "size", "key", "tie", "budget", "before", number.alias("part")).groupBy("source", "part").agg(
        F.first("budget").alias("budget"), F.first("before").alias("start"), *_bounds())
    # at most PARTS rows a source
    upto = F.col("start") + F.sum("words").over(Window.partitionBy("source").orderBy("part"))
    whole = parts.withColumn("upto", upto).withColumn("before", F.col("upto") - F.col("words")).where("upto > budget")
    fields = [c for c in ranges.columns if c != "source"]
    return (whole.groupBy("source").agg(F.min(F.struct("part", *fields)).alias("m"))
            .select("source", *[F.col(f"m.{c}").alias(c) for c in fields]))


def _with_copies(keyed: DataFrame, cuts: DataFrame, names: dict[str, str], id_col: str, name: str) -> DataFrame:
    """``keyed`` next to its source's row of the cuts (columns ``_mix_cut_*``), and in
    ``name`` how often each row is taken."""
    of = lambda c: F.col(names[c])
    cut = lambda c: F.col("_mix_cut_" + c)
    cuts = cuts.select(*[F.col(c).alias("_mix_cut_" + c) for c in cuts.columns])
    place = F.struct(of("key").alias("key"), of("tie").alias("tie"))
    # without a range the budget holds all rows
    chosen = (cut("budget") > 0) & (cut("first").isNull() | (place < cut("first")) | (place <= cut("cut")))
    return (keyed.join(cuts, of("source") == cut("source"))
            .withColumn(name, cut("epochs") + F.coalesce(chosen, F.lit(False)).cast("int")))


_PLAIN = {c: c for c in ("source", "size", "key", "tie")}


def plan_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
             seed: int = 7, weight: Column | None = None) -> DataFrame:
    """Per row of ``docs``: ``doc_id, size, source_size, target, copies, taken`` (words).

    ``weight`` is the quality weight of a row (default: :func:`quality_weight` of its text).
    The document in which a budget ends is taken if more than half of it fits. Null and blank
    texts have size 0; a null source is a source of its own; of rows with equal id and text as
    many are taken as fit; an empty table gives an empty result. Reruns agree: keys are hashes.
    """
    narrow, cuts, scratch = _plan(docs, id_col, text_col, source_col, seed, weight)
    out = _with_copies(narrow, cuts, _PLAIN, "doc_id", "copies")
    return scratch.finish(out.select("doc_id", "size", F.col("_mix_cut_source_size").alias("source_size"),
                                     F.col("_mix_cut_target").alias("target"), "copies",
                                     (F.col("size") * F.col("copies")).alias("taken")))


def _plan(docs, id_col, text_col, source_col, seed, weight):
    scratch = Scratch(docs.sparkSession, "mix")
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                       F.col(source_col).alias("from"), *([weight.alias("weight")] if weight is not None else []))
    slim = located.scanned(slim, scratch)
    narrow = scratch.written(
        _keyed(slim, _PLAIN, "doc_id", "text", "from", seed, None if weight is None else F.col("weight"))
        .select("doc_id", "source", "size", "key", "tie"), "keyed")
    targets = _targets(narrow, scratch)
    return narrow, _cuts(narrow, targets, scratch), scratch


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
          seed: int = 7, weight: Column | None = None) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as :func:`plan_mix` takes it.

    Texts never move: the second pass over ``docs`` only meets one small row per source.
    """
    docs = located.scanned(docs, Scratch(docs.sparkSession, "mix-input"))
    _, cuts, _ = _plan(docs, id_col, text_col, source_col, seed, weight)
    names = {c: unused(docs, "_mix_" + c) for c in _PLAIN}
    keyed = _keyed(docs, names, id_col, text_col, source_col, seed, weight)
    copies = unused(docs, "_mix_copies")
    times = _with_copies(keyed, cuts, names, id_col, copies).where(F.col(copies) > 0)
    return times.withColumn(copies, F.explode(F.sequence(F.lit(1), F.col(copies)))).select(*docs.columns)
