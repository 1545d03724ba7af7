"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sampling import bounded_by_class, held_out
from .simhash import slices
from .shared import text_column
from .shipping import ship

BUCKETS = 1 << 16
#: Labelled rows that the classifier is fitted on, at most.
TRAIN_ROWS = 20_000
SMOOTHING = 0.1
UNDETERMINED = "und"


def gram_buckets(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all 1- to 3-grams of lower-cased characters (three columns), and where each text starts.

    Each text is followed by one zero; grams that touch it fall into bucket ``BUCKETS``.
    """
    points = np.frombuffer("".join(f"{t.lower()}\0" for t in texts).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint32)
    lengths = np.array([len(t.lower().encode("utf-32-le", "surrogatepass")) // 4 + 1 for t in texts])
    out = np.full((len(points), 3), BUCKETS, np.int32)
    with np.errstate(over="ignore"):
        mixed, bad = points.copy(), points == 0
        for n in range(3):
            if n:
                mixed = mixed[:-1] * np.uint32(0x9E3779B1) + points[n:]
                bad = bad[:-1] | (points[n:] == 0)
            hashed = (mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x85EBCA6B + 2 * n)
            out[: len(mixed), n] = np.where(bad, BUCKETS, (hashed >> np.uint32(16)).astype(np.int32))
    return out, np.cumsum(lengths) - lengths


@dataclass(frozen=True)
class LanguageModel:
    """``log_prob``: (BUCKETS + 1) rows, the last all zero, by languages; ``prior``: log share of each."""

    langs: list[str]
    log_prob: np.ndarray
    prior: np.ndarray

    def scores(self, texts: list[str]) -> np.ndarray:
        """Posterior of each language, one row a text."""
        grams, starts = gram_buckets(texts)
        total = np.add.reduceat(self.log_prob[grams].sum(axis=1, dtype=np.float64), starts, axis=0) + self.prior
        odds = np.exp(total - total.max(axis=1, keepdims=True))
        return odds / odds.sum(axis=1, keepdims=True)


def train(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", most: int = TRAIN_ROWS) -> LanguageModel:
    """Fit on rows with a language: shares over all of them, grams over about ``most`` whole texts, as many of each."""
    rows = labelled.where(F.col(lang_col).isNotNull()).select(F.col(id_col).alias("id"), text_column(text_col).alias("text"), F.col(lang_col).alias("lang"))
    share = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row a language
    langs = sorted(share)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, np.ndarray] = {}
        for batch in batches:
            for a, b in slices(batch):
                texts, own = batch.column(1).slice(a, b - a).to_pylist(), np.array(batch.column(2).slice(a, b - a).to_pylist(), object)
                grams, starts = gram_buckets(texts)
                of = np.repeat(np.arange(len(texts)), np.diff(np.append(starts, len(grams))))
                for lang in set(own):
                    tally = np.bincount(grams[(own == lang)[of]].ravel(), minlength=BUCKETS + 1)
                    seen[lang] = seen.get(lang, 0) + tally
        for lang, tally in seen.items():
            some = np.flatnonzero(tally[:BUCKETS])
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(some), pa.string()), pa.array(some), pa.array(tally[some])], names=["lang", "bucket", "n"])

    sample = bounded_by_class(rows, "id", "lang", share, most)
    counts = sample.mapInArrow(count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    table = np.zeros((BUCKETS, len(langs)))
    place = {lang: k for k, lang in enumerate(langs)}
    got = counts.toArrow()  # at most BUCKETS rows a language
    if got.num_rows:
        table[got["bucket"].to_numpy(), [place[x] for x in got["lang"].to_pylist()]] = got["n"].to_numpy()
    table += SMOOTHING
    log_prob = np.concatenate([np.log(table / table.sum(axis=0)), np.zeros((1, len(langs)))]).astype(np.float32)
    n = np.array([share[x] for x in langs], float)
    return LanguageModel(langs, log_prob, np.log(n / n.sum()) if len(n) else n)


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", most: int = TRAIN_ROWS) -> DataFrame:
    """One row a document: id, ``held_out, lang_pred, score``.

    Learns from rows that are not held out and have a language; predicts from the whole text alone.
    ``lang_pred`` is ``und`` with score 0 where the text is null or has no letter, or nothing could be
    learned.  Ties go to the first language in code point order.  Each row stands for itself, also where
    ids repeat or are null.  An empty table gives none; other columns are not read.
    """
    from pyspark.sql.types import StringType

    ship(docs.sparkSession)
    model = train(docs.where(~held_out(id_col)).withColumn(lang_col, F.col(lang_col).cast(StringType())), id_col, text_col, lang_col, most)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        step = max(50_000, 4_000_000 // max(1, len(known.langs)))  # bytes, so that the gathered rows stay small
        for batch in batches:
            for a, b in slices(batch, column=2, size=step):
                part = batch.slice(a, b - a)
                texts = part.column(2).to_pylist()
                lettered = np.array([any(map(str.isalpha, t)) for t in texts]) & bool(known.langs)
                lang, score = np.full(len(texts), UNDETERMINED, object), np.zeros(len(texts))
                if lettered.any():
                    odds = known.scores([t for t, ok in zip(texts, lettered, strict=True) if ok])
                    best = odds.argmax(axis=1)
                    lang[lettered], score[lettered] = np.array(known.langs, object)[best], odds[np.arange(len(best)), best]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(lang, pa.string()), pa.array(score)], names=["id", "held_out", "lang_pred", "score"])

    rows = docs.select(F.col(id_col).alias("id"), held_out(id_col).alias("held_out"), text_column(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(predict, f"id {kind}, held_out boolean, lang_pred string, score double").withColumnRenamed("id", id_col)
