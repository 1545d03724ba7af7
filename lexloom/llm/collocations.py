"""Phrase collocations by hierarchical pair naming.

Texts become blocks: the words of some documents of one language as block-local numbers, with a zero wherever a
phrase must not go on.  Level 1 counts words over all blocks, and each frequent word gets a 64-bit id.  Level k
replaces adjacent frequent phrases of k-1 words (they overlap in all but their ends) by the pair of their ids;
blocks count their distinct pairs, equal pairs of all blocks meet, and each frequent pair gets an id, which goes
back to the blocks that hold it.  A phrase is only followed where both its parts are frequent, so nothing frequent
is lost.

A pair's two ids are its parents: the phrase without its last word and the one without its first.  Counts of all
beginnings and ends of a phrase, of which its cuts are made, are handed down along them, and what contains a phrase
hands its count up.  Only distinct words and pairs of a block are ever shuffled, one row a block for even the commonest.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import staged, text_column
from .shipping import ship

#: Phrases of 2 to so many words, found so often at least.
MOST_WORDS, LEAST_COUNT = 3, 10
#: A phrase within a longer one that has at least this percentage of its count goes.
SUBSUMED_PERCENT = 50
#: Rows reported for each language, and parts of a language's phrases at most of which each first finds its own.
TOP, TOP_PARTS = 2000, 256
#: Words of a block, and of all blocks that a task has open.
BLOCK_WORDS, OPEN_WORDS = 2 << 20, 6 << 20
#: Distinct words that go out together.
SLICE = 50_000

# Where pieces end; a tab parts words as a space does.
_TABLE = bytes.maketrans(b".,;:!?\n\x0b\x0c\r\t", b"\n" * 10 + b" ")


class _Numbers(dict):
    """Numbers from 1 in order of appearance; the end of a piece is 0."""

    def __init__(self):
        super().__init__({b"\n": 0})

    def __missing__(self, word: bytes) -> int:
        out = self[word] = len(self)
        return out


_BLOCK = pa.schema([("block", pa.int64()), ("lang", pa.string()), ("local", pa.int64()), ("word", pa.string()), ("n", pa.int64()), ("seq", pa.binary())])
_BLOCK_DDL = "block long, lang string, local long, word string, n long, seq binary"


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each block its words with local number and count, and a row of local number 0 with all words in a row."""
    find, done, held = re.compile(rb"[^ \n]+|\n").findall, 0, 0
    open_blocks: dict[str, tuple[_Numbers, array]] = {}

    def out(lang: str) -> Iterator[pa.RecordBatch]:
        nonlocal done, held
        numbers, row = open_blocks.pop(lang)
        held -= len(row)
        block, seq = TaskContext.get().partitionId() << 32 | done, np.frombuffer(row, np.uint32)
        counts = np.bincount(seq, minlength=len(numbers))
        done += 1
        words = list(numbers)
        rest = len(words)
        for at in range(1, rest, SLICE):
            k = min(SLICE, rest - at)
            yield pa.RecordBatch.from_arrays([pa.array([block] * k), pa.array([lang] * k), pa.array(np.arange(at, at + k)), pa.array([w.decode() for w in words[at : at + k]]), pa.array(counts[at : at + k]), pa.nulls(k, pa.binary())], schema=_BLOCK)
        yield pa.RecordBatch.from_pylist([{"block": block, "lang": lang, "local": 0, "word": None, "n": int(len(seq) - counts[0]), "seq": seq.tobytes()}], schema=_BLOCK)

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            numbers, row = open_blocks.setdefault(lang, (_Numbers(), array("I")))
            before = len(row)
            row.extend(map(numbers.__getitem__, find(text.as_py().encode().lower().translate(_TABLE))))
            row.append(0)
            held += len(row) - before
            if len(row) >= BLOCK_WORDS:
                yield from out(lang)
            while held >= OPEN_WORDS:
                yield from out(max(open_blocks, key=lambda x: len(open_blocks[x][1])))
    for lang in list(open_blocks):
        yield from out(lang)


_PAIR_DDL = "block long, local long, left long, right long, n long, seq binary"
_PAIR = pa.schema([("block", pa.int64()), ("local", pa.int64()), ("left", pa.int64()), ("right", pa.int64()), ("n", pa.int64()), ("seq", pa.binary())])


def _paired(batches: Iterator[pa.RecordBatch], rows: bool) -> Iterator[pa.RecordBatch]:
    """The distinct pairs of each block with local number (from 1) and count, or its row of such numbers."""
    for batch in batches:
        for block, seq, names in zip(batch.column("block").to_pylist(), batch.column("seq"), batch.column("names"), strict=True):
            row = np.frombuffer(seq.as_buffer(), np.uint32)
            local, ids = (names.values.field(k).to_numpy() for k in ("local", "id"))
            order = np.argsort(local)
            local, ids = local[order], ids[order]
            compact = np.zeros(int(max(row.max(initial=0), local[-1])) + 1, np.int64)
            compact[local] = np.arange(1, len(local) + 1)
            row = compact[row]
            both = (row[:-1] > 0) & (row[1:] > 0)
            distinct, of, counts = np.unique(row[:-1][both] << 32 | row[1:][both], return_inverse=True, return_counts=True)
            if not len(distinct):
                continue
            if rows:
                after = np.zeros(len(both), np.uint32)
                after[both] = of + 1
                yield pa.RecordBatch.from_arrays([pa.array([block]), *[pa.array([0])] * 4, pa.array([after.tobytes()])], schema=_PAIR)
                continue
            left, right = ids[(distinct >> 32) - 1], ids[(distinct & 0xFFFFFFFF) - 1]
            k = len(distinct)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(k, block)), pa.array(np.arange(1, k + 1)), pa.array(left), pa.array(right), pa.array(counts), pa.nulls(k, pa.binary())], schema=_PAIR)


def _named(rows: DataFrame, by: list[str], least: int, label: str) -> DataFrame:
    """``rows`` of frequent items with their count ``f`` over all blocks and an ``id``; ``own`` marks one row an id.

    Equal items meet in one partition, which names them by the place of their first row there.
    """
    same = Window.partitionBy(*by)
    often = rows.withColumn("f", F.sum("n").over(same)).where(F.col("f") >= least)
    placed = often.withColumn("at", F.monotonically_increasing_id()).withColumn("id", F.min("at").over(same))
    return staged(placed.withColumn("own", F.col("at") == F.col("id")).drop("at", "n"), label)


def _cuts(words: int) -> F.Column:
    """The lowest-scoring cut of a phrase as ``score, k, l, r``, of equal scores the smallest ``k``; exact in decimals."""
    score = "CAST(f AS DECIMAL(16, 0)) * CAST(f AS DECIMAL(16, 0)) * 1000000BD div (CAST(begins[{0}] AS DECIMAL(16, 0)) * CAST(ends[{1}] AS DECIMAL(16, 0)))"
    cut = "named_struct('score', " + score + ", 'k', {2}, 'l', begins[{0}], 'r', ends[{1}])"
    return F.expr("array_min(array(" + ", ".join(cut.format(k - 1, words - k - 1, k) for k in range(1, words)) + "))")


def phrases(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", most_words: int = MOST_WORDS, least_count: int = LEAST_COUNT, subsumed_percent: int = SUBSUMED_PERCENT) -> tuple[DataFrame, DataFrame]:
    """All phrases that stay, ``lang, phrase, a, l, r, score``, and the words of each language, ``lang, n``.

    A-Z are lower-cased, ``[.,;:!?]`` and line ends part pieces, spaces and tabs part words; all is by language.  A
    phrase has 2 to ``most_words`` words and stands within pieces ``a`` >= ``least_count`` times, overlaps included.
    Of its cuts into two parts, found ``l`` and ``r`` times, the one of the lowest score floor(10^6 a a / (l r))
    counts.  A phrase within a longer one that has at least ``subsumed_percent`` of its count is left out.

    Null language is ``und``, null text is empty, repeated rows count again, and tables without words give no rows.
    Only the two named columns are read, whatever others are called.  Counts may reach 10^16.
    """
    if most_words < 2:
        raise ValueError("a phrase has two words at least")
    ship(docs.sparkSession)
    read = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), text_column(text_col).alias("text"))
    blocks = staged(read.mapInArrow(_blocks, _BLOCK_DDL), "phrases-blocks")
    seqs = blocks.where("local = 0").select("block", "seq")
    totals = blocks.where("local = 0").groupBy("lang").agg(F.sum("n").alias("n"))
    held = _named(blocks.where("local > 0").select("block", "local", "lang", "word", "n"), ["lang", "word"], least_count, "phrases-words")
    none = F.array().cast("array<long>")
    grams = held.where("own").select("id", "lang", F.col("word").alias("phrase"), F.col("word").alias("last"), "f", none.alias("begins"), none.alias("ends"))
    levels = []
    for words in range(2, most_words + 1):
        names = held.groupBy("block").agg(F.collect_list(F.struct("local", "id")).alias("names"))  # at most a block's distinct items
        both = seqs.join(names, "block")
        pairs = both.mapInArrow(lambda batches: _paired(batches, False), _PAIR_DDL).select("block", "local", "left", "right", "n")
        held = _named(pairs, ["left", "right"], least_count, "phrases-pairs")
        if words < most_words:
            seqs = staged(both.mapInArrow(lambda batches: _paired(batches, True), _PAIR_DDL).select("block", "seq"), "phrases-rows")
        left = grams.select(F.col("id").alias("left"), "lang", F.col("phrase").alias("head"), F.array_append("begins", F.col("f")).alias("begins"))
        right = grams.select(F.col("id").alias("right"), "last", F.array_append("ends", F.col("f")).alias("ends"))
        own = held.where("own").select("id", "left", "right", "f").join(left, "left").join(right, "right")
        grams = staged(own.select("id", "left", "right", "lang", F.concat_ws(" ", "head", "last").alias("phrase"), "last", "f", "begins", "ends"), "phrases-names")
        levels.append(grams)
    out = []
    for words, level in enumerate(levels, 2):
        told = level
        if words < most_words:
            longer = levels[words - 1]
            most = longer.select(F.col("left").alias("part"), "f").union(longer.select("right", "f")).groupBy("part").agg(F.max("f").alias("most"))
            told = level.join(most, F.col("id") == F.col("part"), "left").where(F.coalesce(100 * F.col("most") < subsumed_percent * F.col("f"), F.lit(True)))
        out.append(told.withColumn("cut", _cuts(words)).select("lang", "phrase", F.col("f").alias("a"), F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), F.col("cut.score").alias("score")))
    kept = out[0]
    for more in out[1:]:
        kept = kept.unionByName(more)
    return kept, totals


def collocations(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", top: int = TOP, **limits) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's first ``top`` phrases by score, then count, then phrase.

    Ties in score and count go by the phrase's bytes.  Each part of a language's phrases first finds its own
    ``top``, so the last task of a language meets ``top`` rows of each part at most.  See ``phrases``.
    """
    kept, totals = phrases(docs, lang_col, text_col, **limits)
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    parts = min(TOP_PARTS, max(8, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    dealt = kept.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(parts)))
    first = dealt.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top)
    best = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


#: The query's rows by plain SQL: all phrases counted, cuts and what contains them looked up by their strings.
ORACLE_SQL = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, regexp_extract_all(unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS w FROM d),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM p GROUP BY lang),
g AS (
  SELECT lang, 1 AS k, w[i:i] AS g FROM (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM p)
  UNION ALL SELECT lang, 2, w[i:i + 1] FROM (SELECT lang, w, unnest(range(1, len(w))) AS i FROM p)
  UNION ALL SELECT lang, 3, w[i:i + 2] FROM (SELECT lang, w, unnest(range(1, len(w) - 1)) AS i FROM p)),
f AS (SELECT lang, k, g, count(*)::BIGINT AS a FROM g GROUP BY ALL HAVING count(*) >= 10),
cuts AS (
  SELECT c.lang, c.g, c.k, c.a, t.k AS cut, l.a AS l, r.a AS r,
         (1000000::HUGEINT * c.a * c.a // (l.a::HUGEINT * r.a))::BIGINT AS score
  FROM f c JOIN (VALUES (1), (2)) t(k) ON t.k < c.k
  JOIN f l ON l.lang = c.lang AND l.g = c.g[1:t.k] JOIN f r ON r.lang = c.lang AND r.g = c.g[t.k + 1:c.k]),
low AS (SELECT lang, g, k, a, first(l ORDER BY score, cut) AS l, first(r ORDER BY score, cut) AS r, min(score) AS score FROM cuts GROUP BY ALL),
longer AS (SELECT lang, part, max(a) AS most FROM (
  SELECT lang, g[1:2] AS part, a FROM f WHERE k = 3 UNION ALL SELECT lang, g[2:3], a FROM f WHERE k = 3) GROUP BY ALL),
kept AS (
  SELECT lang, array_to_string(g, ' ') AS phrase, a, l, r, score FROM low
  WHERE NOT EXISTS (SELECT 1 FROM longer x WHERE x.lang = low.lang AND x.part = low.g AND 100 * x.most >= 50 * low.a)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
