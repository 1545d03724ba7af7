"""Mixing sources to target weights, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import staged

#: Documents that share a bucket of the key range, on average: what one sorted prefix sum covers.
BUCKET_ROWS = 4096
WORD = r"[^\x20\x09-\x0D]+"


def word_size(text_col: str = "text"):
    """Number of words in the text; 0 where it is null."""
    return F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, epochs: int = 3, cycle: int = 3) -> DataFrame:
    """One row a source: ``_source, source_size, n_docs, target, budget``.

    Sources in code point order, null last, weigh 1 .. ``cycle``, repeating.  Their targets share the
    sum of all sizes by weight; none exceeds ``epochs`` times its source's size, and what is above is
    shared out again by weight.  That is the level L at which sum(min(weight * L, limit)) is the total,
    found in one pass over the sources in order of limit / weight.  ``budget`` is the target rounded to
    whole words.  The windows run over sources, of which there are few, not over documents.
    """
    per = sizes.groupBy("_source").agg(F.sum("_size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    ordered = Window.orderBy(F.col("_source").asc_nulls_last())
    per = per.withColumn("_w", (F.pmod(F.row_number().over(ordered) - 1, F.lit(cycle)) + 1).cast("double"))
    per = per.withColumn("_limit", (F.col("source_size") * epochs).cast("double")).withColumn("_r", F.col("_limit") / F.col("_w"))
    every = Window.partitionBy()
    before = Window.orderBy("_r", F.col("_source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    per = per.select(
        "*",
        F.sum("source_size").over(every).cast("double").alias("_total"),
        F.sum("_w").over(every).alias("_all_w"),
        F.coalesce(F.sum("_limit").over(before), F.lit(0.0)).alias("_full"),
        F.coalesce(F.sum("_w").over(before), F.lit(0.0)).alias("_full_w"),
    ).withColumn("_level", (F.col("_total") - F.col("_full")) / (F.col("_all_w") - F.col("_full_w")))
    # The first source, in that order, which its level does not fill sets the level of all after it.
    level = F.min_by("_level", F.when(F.col("_level") <= F.col("_r"), F.col("_r"))).over(every)
    target = F.least(F.col("_limit"), F.coalesce(F.col("_w") * level, F.col("_limit")))
    return per.select("_source", "source_size", "n_docs", target.alias("target"), F.floor(target + 0.5).cast("long").alias("budget"))


def _placed(rows: DataFrame, sizes: DataFrame, targets: DataFrame, *carried: str) -> DataFrame:
    """``rows`` (_id, _source, _size, _key and what is ``carried``) with their source's figures and ``_taken``.

    ``sizes`` are the same rows without what is carried, as staged: sums of ranges need no text.
    """
    place = F.conv(F.substring("_key", 1, 12), 16, 10).cast("double") / float(16**12)
    ranges = F.ceil(F.col("n_docs") / BUCKET_ROWS)
    # A plain key for sources, null ones too, so that the join and the window share one dealing of the rows.
    key = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("null"))
    figures = targets.withColumn("_ts", key("_source")).drop("_source")

    def dealt(some: DataFrame, *columns: str) -> DataFrame:
        chosen = some.select("_id", key("_source").alias("_s"), "_size", "_key", *columns).join(figures, F.col("_s") == F.col("_ts"))
        return chosen.withColumn("_range", F.floor(place * ranges).cast("long")).drop("_ts", "n_docs")

    sums = dealt(sizes).groupBy("_s", "_range").agg(F.sum("_size").alias("_sum"))
    over = Window.partitionBy("_s").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select(F.col("_s").alias("_bs"), F.col("_range").alias("_br"), F.coalesce(F.sum("_sum").over(over), F.lit(0)).alias("_base"))
    joined = dealt(rows, *carried).join(bases, (F.col("_s") == F.col("_bs")) & (F.col("_range") == F.col("_br")))
    inner = Window.partitionBy("_s", "_range").orderBy("_key", "_id", "_size").rowsBetween(Window.unboundedPreceding, -1)
    placed = joined.withColumn("_before", F.col("_base") + F.coalesce(F.sum("_size").over(inner), F.lit(0)))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("budget") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    left = F.col("budget") - whole * F.col("source_size") - F.col("_before")
    return placed.withColumn("_taken", whole * F.col("_size") + F.least(F.col("_size"), F.greatest(F.lit(0).cast("long"), left)))


def _keyed(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: str, *more) -> DataFrame:
    text = F.md5(F.coalesce(F.col(text_col), F.lit("")))
    key = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit("")), text))
    return docs.select(F.col(id_col).alias("_id"), F.col(source_col).alias("_source"), word_size(text_col).alias("_size"), key.alias("_key"), *more)


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", epochs: int = 3, cycle: int = 3, seed: str = "mix") -> DataFrame:
    """One row a document: id, ``size, source_size, target, taken``.

    Each document has a hash-random key (MD5 of seed, id and text).  Key ranges, as many as a source has
    thousands of documents, are the splitters of the range sort within a source; sums of the ranges
    give each its base, and a sorted prefix sum within a range the document's own place.  A source
    whose budget exceeds its size repeats whole epochs first; the last epoch is cut at the exact word,
    so the taken words of a source add up to its rounded target.  A hot source has just more ranges.

    Null text has size 0, null sources form one source.  Rows without an id, or that repeat one, have keys by
    their texts; rows that repeat both lie side by side in the order, each a row of its own.
    An empty table gives none; where all sizes are 0 every target is 0.
    """
    sizes = staged(_keyed(docs, id_col, text_col, source_col, seed), "mix-sizes")
    targets = staged(source_targets(sizes, epochs, cycle), "mix-targets")
    placed = _placed(sizes, sizes, targets)
    return placed.select(F.col("_id").alias(id_col), F.col("_size").alias("size"), "source_size", "target", F.col("_taken").alias("taken"))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", epochs: int = 3, cycle: int = 3, seed: str = "mix") -> DataFrame:
    """The mix itself: each document as often as whole epochs take it, its last copy cut where the budget ends.

    Returns the columns of ``docs``.  A cut copy holds its first words, joined by single spaces (its
    ``n_chars``, where there is such a column, is theirs).  A document of which the mix takes nothing is
    absent; one without words, which adds nothing to any budget, stays once.
    """
    sizes = staged(_keyed(docs, id_col, text_col, source_col, seed), "mix-sizes")
    targets = staged(source_targets(sizes, epochs, cycle), "mix-targets")
    placed = _placed(_keyed(docs, id_col, text_col, source_col, seed, F.struct("*").alias("_row")), sizes, targets, "_row")
    size, taken, zero = F.col("_size"), F.col("_taken"), F.lit(0).cast("long")
    whole = F.array_repeat(size, F.when(size > 0, F.floor(taken / size)).otherwise(1).cast("int"))
    parts = F.when((size > 0) & (taken % size > 0), F.concat(whole, F.array(taken % size))).otherwise(whole)
    out = placed.select("_row", "_size", F.explode(parts).alias("_take"))
    text = F.col(f"_row.`{text_col}`")
    head = F.array_join(F.slice(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), F.lit(1), F.greatest(F.col("_take"), zero + 1).cast("int")), " ")
    part = F.col("_take") < size
    own = {text_col: F.when(part, head).otherwise(text), "n_chars": F.when(part, F.char_length(head).cast("long")).otherwise(F.col("_row.n_chars"))} if "n_chars" in docs.columns else {text_col: F.when(part, head).otherwise(text)}
    return out.select(*[own.get(c, F.col(f"_row.`{c}`")).cast(docs.schema[c].dataType).alias(c) for c in docs.columns])
