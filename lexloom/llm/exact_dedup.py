"""Exact dedup by content sort, in DataFrame operations only.

Rows are range-partitioned by sampled splitters of their normalised text and sorted, externally where that
must spill, so that equal texts lie next to each other; neighbours are compared in full, and of each run
of equals one identifier stays.  The texts are dealt out once, and no row of them is joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import ascii_lower, text_column

#: Characters of a text that a splitter of the range partitioning holds, so that the sample of
#: splitters stays small on the driver; the digest behind it separates longer shared beginnings.
SPLITTER_CHARS = 32
#: A text is hot if more than one in so many rows hold it; so there are fewer hot texts than this.
HOT_SHARE = 1024
#: No text of fewer rows is hot.
HOT_ROWS = 256
#: Parts into which the rows of a hot text are dealt.
PARTS = 1024


def _hot_texts(docs: DataFrame, id_col: str, text: Column, pick, least_rows: int) -> DataFrame:
    """``_hot, _hot_id, _hot_n``: digests of the hot texts, the id that stays and the number of rows.

    Rows are counted by digest, with map-side combine; texts under one hot digest are compared in full.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("_id"), F.sha2(text, 256).alias("_sha"))
    counts = rows.groupBy("_sha").agg(F.count(F.lit(1)).alias("_n"), pick("_id").alias("_best"))
    found = counts.where(F.col("_n") > max(least_rows, docs.count() // HOT_SHARE)).select("_sha", "_best", "_n").collect()  # fewer than HOT_SHARE
    hot = spark.createDataFrame([tuple(r) for r in found], f"_hot string, _hot_id {rows.schema['_id'].dataType.simpleString()}, _hot_n long")
    if found:
        texts = docs.select(text.alias("_t"), F.sha2(text, 256).alias("_sha")).join(F.broadcast(hot.select("_hot")), F.col("_sha") == F.col("_hot"))
        kinds = texts.groupBy("_sha").agg((F.min("_t") == F.max("_t")).alias("_same"))
        if kinds.where("not _same").count():
            raise ValueError("two different texts share a SHA-256")
    return hot


def _sorted_runs(docs: DataFrame, id_col: str, text_col: str, keep: str, normalise, whole_rows: bool, least_rows: int) -> DataFrame:
    """Every row once, out of one range sort, with ``_nth`` in its run (1: first by id) and ``_part``.

    A run is one text, or one part of a hot one; its rows lie partitioned and sorted as its window needs
    them.  What stays of a hot text lies in part 0, with no other id.
    """
    if keep not in ("min", "max"):
        raise ValueError("keep is 'min' or 'max'")
    text = normalise(text_column(text_col))
    hot = _hot_texts(docs, id_col, text, F.min if keep == "min" else F.max, least_rows)
    carried = F.struct(*[F.col(f"`{c}`") for c in docs.columns]) if whole_rows else text
    keyed = docs.select(F.col(id_col).alias("_id"), carried.alias("_held"), F.substring(text, 1, SPLITTER_CHARS).alias("_head"), F.sha2(text, 256).alias("_sha"))
    keyed = keyed.join(F.broadcast(hot), F.col("_sha") == F.col("_hot"), "left")  # fewer than HOT_SHARE rows
    part = F.when(F.col("_hot").isNull() | F.col("_id").eqNullSafe(F.col("_hot_id")), 0).otherwise(1 + F.pmod(F.xxhash64("_id"), F.lit(PARTS)))
    laid = keyed.withColumn("_part", part.cast("int")).repartitionByRange("_head", "_sha", "_part")
    run = Window.partitionBy("_head", "_sha", "_part").orderBy(F.col("_id").asc_nulls_last() if keep == "min" else F.col("_id").desc_nulls_last())
    own = normalise(text_column(f"_held.`{text_col}`")) if whole_rows else F.col("_held")
    near = laid.withColumns({"_nth": F.row_number().over(run), "_first": F.first("_id").over(run), "_before": F.lag(own).over(run)})
    # Results go by digest, so two different texts under one digest must not pass unseen.
    differs = (F.col("_nth") > 1) & (F.col("_before") != own)
    return near.withColumn("_nth", F.when(differs, F.raise_error(F.lit("two different texts share a SHA-256"))).otherwise(F.col("_nth")))


def dedup_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min", normalise=ascii_lower, hot_rows: int = HOT_ROWS) -> DataFrame:
    """One row for each input row, dropped ones too: id, ``keep_id, group_size, kept, text_sha256``.

    ``keep`` is "min" or "max".  Null text is the empty text.  A null id never wins over another; a group of
    only null ids keeps null.  Rows that repeat both id and text give one row each, of which at most one
    is kept.  An empty table gives none.  Only the id and text are read; other columns, whatever their
    names, play no part.

    A text that more than one in ``HOT_SHARE`` rows hold (and ``hot_rows`` at least) is dealt out by parts; only
    rows that repeat the id that stays, or have no id at all, are not told apart and meet in one task.
    """
    runs = _sorted_runs(docs, id_col, text_col, keep, normalise, False, hot_rows)
    slim = runs.select("_id", "_head", "_sha", "_part", "_nth", "_first", "_hot", "_hot_id", "_hot_n")  # without texts
    size = F.count(F.lit(1)).over(Window.partitionBy("_head", "_sha", "_part"))
    cold = F.col("_hot").isNull()
    return slim.select(
        F.col("_id").alias(id_col),
        F.when(cold, F.col("_first")).otherwise(F.col("_hot_id")).alias("keep_id"),
        F.when(cold, size).otherwise(F.col("_hot_n")).alias("group_size"),
        ((F.col("_nth") == 1) & (F.col("_part") == 0)).alias("kept"),
        F.col("_sha").alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min", normalise=ascii_lower, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``docs`` with one row of each group of equal texts, with its own columns and no others.

    Rows that repeat the winning id and text collapse into one of them.  Nulls and hot texts as in
    ``dedup_report``.
    """
    runs = _sorted_runs(docs, id_col, text_col, keep, normalise, True, hot_rows)
    return runs.where("_nth = 1 and _part = 0").select(*[F.col(f"_held.`{c}`").alias(c) for c in docs.columns])
