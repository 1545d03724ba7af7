"""Spelling variants: words that differ in one character, by rolling-hash deletions.

A word's polynomial hash is a sum of code points times powers of an odd base, modulo 2^64.  From running sums over
its characters follow, for every place at once, the sum before it and the sum behind it; the latter times the
base's inverse moves up by one place, and both together are the hash of the word without that character.  So numpy makes
the keys of all deletions of a batch of words without making their strings.

* Words that differ by a replaced character at place i are equal without place i: they share (place, rest).
* A word that another one exceeds by an inserted character is the rest of a deletion there.  Of a run of equal
  characters only the first is deleted for this, so each such pair is found once.

Keys are dealt by their high bits (the radix) and sorted within a partition, and of each key goes on only what can
have a partner.  Only then are words fetched, and equal keys told apart by the strings they stand for.  As a rest
and a place admit one word a letter, a group of equal strings is bounded by the alphabet and the length of
the word, not by the corpus; its counts and best words are passed on, never its pairs.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import staged, text_column
from .shipping import ship

#: Letters of words: A-Z and a-z, and the letters (and two signs) from U+00C0 to U+00FF.
LETTERS = "A-Za-zÀ-ÿ"
#: One occurrence in so many, chosen by checksum, loses a character before words are counted.
NOISE = 97
#: A word counts from so many code points and so many occurrences on.
LEAST_LENGTH, LEAST_COUNT = 5, 3
#: A near word is a word's form if it occurs this many times as often.
RATIO = 2
#: Distinct words counted together before they are passed on; code points of words whose keys are made together.
GATHER, STEP = 200_000, 200_000
#: High bits of a key by which keys are dealt.
RADIX_BITS = 20
#: The base of the polynomial hash, odd, and its inverse modulo 2^64.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)


def _counts(batches: Iterator[pa.RecordBatch], letters: str, least: int, noise: int) -> Iterator[pa.RecordBatch]:
    """``word, n`` of some documents together; ``noise`` 0: no occurrence loses a character."""
    find, total = re.compile(f"[{letters}]{{{least},}}").findall, Counter()

    def out():
        got = pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], names=["word", "n"])
        total.clear()
        return got

    for batch in batches:
        for i, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            found = find(text.as_py().encode().lower().decode())  # bytes lower A-Z only
            if not noise:
                total.update(found)
                continue
            seed = zlib.crc32(f"{'' if i is None else i}:".encode())
            for word, n in Counter(found).items():
                h = zlib.crc32(word.encode(), seed)
                if h % noise == 0:
                    at = h % len(word)
                    word = word[:at] + word[at + 1 :]
                    if len(word) < least:
                        continue
                total[word] += n
            if len(total) >= GATHER:
                yield out()
    if total:
        yield out()


def counted_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", noise: int = NOISE, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """``word, n``: maximal runs of letters with A-Z lower-cased, those long and frequent enough.

    An occurrence whose checksum crc32("<id>:<run>") ``noise`` divides loses the character at checksum modulo length.
    Counts are made where the texts are.  A null id reads as empty in the checksum; a null text has no word.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), text_column(text_col).alias("text"))
    parts = rows.mapInArrow(lambda batches: _counts(batches, LETTERS, least_length, noise), "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def deletion_keys(words: list[str]) -> tuple[np.ndarray, ...]:
    """``of, place, first, key`` of every word (place -1) and of every deletion from it.

    ``of`` is the word's index; ``first`` tells that the character before the deleted one is another (or none).
    """
    lengths = np.array([len(w) for w in words], np.int64)
    points = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.uint64)
    starts = np.cumsum(lengths) - lengths
    of = np.repeat(np.arange(len(words)), lengths)
    place = np.arange(len(points)) - starts[of]
    powers = np.full(int(lengths.max(initial=0)), BASE, np.uint64)
    powers[:1] = 1
    np.multiply.accumulate(powers, out=powers)
    terms = points * powers[place]
    running = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)])
    before = running[:-1] - running[starts[of]]
    whole = running[starts + lengths] - running[starts]
    without = before + (whole[of] - before - terms) * np.uint64(INVERSE)
    first = np.ones(len(points), bool)
    first[1:] = (points[1:] != points[:-1]) | (place[1:] == 0)
    n = len(words)
    return np.concatenate([np.arange(n), of]), np.concatenate([np.full(n, -1), place]), np.concatenate([np.zeros(n, bool), first]), np.concatenate([whole, without])


_KEYS = ["key", "id", "place", "first"]


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def out(ids, words):
        of, place, first, key = deletion_keys(words)
        return pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(np.array(ids, np.int64)[of]), pa.array(place.astype(np.int32)), pa.array(first)], names=_KEYS)

    for batch in batches:
        ids, words, held = [], [], 0
        for i, word in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            ids.append(i)
            words.append(word)
            held += len(word)
            if held >= STEP:
                yield out(ids, words)
                ids, words, held = [], [], 0
        if words:
            yield out(ids, words)


def _partnered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by key: those that share key and place, and words with the first deletions that give their key."""

    def chosen(key, i, place, first):
        order = np.lexsort((place, key))
        key, i, place, first = key[order], i[order], place[order], first[order]
        edge = np.concatenate([[True], key[1:] != key[:-1]])
        group = np.cumsum(edge) - 1
        cell = np.cumsum(edge | np.concatenate([[True], place[1:] != place[:-1]])) - 1
        shared = (np.bincount(cell)[cell] > 1) & (place >= 0)
        word, made = place < 0, first
        both = (np.bincount(group, word) > 0) & (np.bincount(group, made) > 0)
        keep = shared | (both[group] & (word | made))
        return pa.RecordBatch.from_arrays([pa.array(c[keep]) for c in (key, i, place, first)], names=_KEYS)

    held = None
    for batch in batches:
        now = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(4)]
        held = now if held is None else [np.concatenate(c) for c in zip(held, now, strict=True)]
        cut = int(np.searchsorted(held[0], held[0][-1])) if len(held[0]) else 0  # the last key may go on in the next batch
        if cut:
            yield chosen(*[c[:cut] for c in held])
            held = [c[cut:] for c in held]
    if held is not None and len(held[0]):
        yield chosen(*held)


def near_words(counted: DataFrame) -> DataFrame:
    """``word, n, n_near, near, near_n`` of distinct words with their counts.

    ``n_near`` is the number of words that one inserted, deleted or replaced code point makes of a word, ``near`` the
    most frequent of them, of equals the smallest in code-point order; null where there is none.
    """
    ship(counted.sparkSession)
    schema = "key long, id long, place int, first boolean"
    words = staged(counted.select(F.monotonically_increasing_id().alias("id"), "word", "n"), "spelling-words")
    keys = words.select("id", "word").mapInArrow(_keys, schema)
    dealt = keys.repartition(F.shiftrightunsigned("key", 64 - RADIX_BITS)).sortWithinPartitions("key")
    some = dealt.mapInArrow(_partnered, schema).withColumnRenamed("id", "of")
    place = F.col("place")
    rest = F.when(place < 0, F.col("word")).otherwise(F.concat(F.substring("word", F.lit(1), place), F.substring("word", place + 2, F.length("word"))))
    told = some.join(words, F.col("of") == F.col("id")).select("key", "place", "first", "word", "n", rest.alias("rest")).repartition("key")

    by_rest = Window.partitionBy("key", "rest")
    by_place = Window.partitionBy("key", "rest", "place")
    ranked = by_place.orderBy(F.col("n").desc(), "word")
    best = F.struct((-F.col("n")).alias("m"), F.col("word").alias("w"))
    seen = told.select(
        "word",
        "place",
        "first",
        best.alias("own"),
        F.count(F.lit(1)).over(by_place).alias("cell"),
        F.row_number().over(ranked).alias("nth"),
        F.first(best).over(ranked).alias("top"),
        F.lead(best).over(ranked).alias("next"),
        F.min(F.when(place < 0, best)).over(by_rest).alias("shorter"),
        F.min(F.when(F.col("first"), best)).over(by_rest).alias("longer"),
        F.sum(F.col("first").cast("long")).over(by_rest).alias("longers"),
    )
    cut = F.col("first") & F.col("shorter").isNotNull()
    other = F.when(F.col("nth") == 1, F.col("next")).otherwise(F.col("top"))
    links = seen.select(
        "word",
        F.when(place < 0, F.col("longers")).otherwise(F.col("cell") - 1 + cut.cast("long")).alias("links"),
        F.when(place < 0, F.col("longer")).otherwise(F.least(other, F.when(cut, F.col("shorter")))).alias("best"),
    ).where("links > 0")
    alone = words.select("word", "n", F.lit(0).cast("long").alias("links"), F.lit(None).cast(links.schema["best"].dataType).alias("best"))
    both = alone.unionByName(links.withColumn("n", F.lit(None).cast("long")))
    summed = both.groupBy("word").agg(F.max("n").alias("n"), F.sum("links").alias("n_near"), F.min("best").alias("best"))
    return summed.select("word", "n", "n_near", F.col("best.w").alias("near"), (-F.col("best.m")).alias("near_n"))


def rooted(rows: DataFrame, word: str = "word", form: str = "form", into: str = "root") -> DataFrame:
    """``rows`` with what following ``form`` from word to word ends at; a word without a form ends at itself.

    Roots hand their name to the words of which they are the form, those to theirs, and so on: a round reads only
    what is still open and what the last round settled, and a name is only asked by its own near words.
    Words are distinct, forms are words and never lead back.
    """
    settled = staged(rows.where(F.col(form).isNull()).withColumn(into, F.col(word)), "spelling-roots")
    parts, still = [settled], rows.where(F.col(form).isNotNull())
    while True:
        last = parts[-1].select(F.col(word).alias("_at"), F.col(into).alias("_root"))
        now = staged(still.join(last, F.col(form) == F.col("_at"), "left").drop("_at"), "spelling-roots")
        parts.append(now.where("_root is not null").withColumnRenamed("_root", into))
        still = now.where("_root is null").drop("_root")
        if still.isEmpty():
            return reduce(DataFrame.unionByName, parts)


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", noise: int = NOISE, ratio: int = RATIO) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of the corpus.

    A word's ``form`` is its most frequent near word if that occurs at least ``ratio`` times as often, else null;
    ``root`` follows forms to the last.  Null and empty texts have no words, rows that repeat count again, and an empty
    table gives no rows.  Of the documents only the two named columns are read, whatever others are called.
    """
    near = near_words(counted_words(docs, id_col, text_col, noise))
    taken = F.coalesce(F.col("near_n") >= ratio * F.col("n"), F.lit(False))
    formed = staged(near.select("word", "n", "n_near", F.when(taken, F.col("near")).alias("form"), F.when(taken, F.col("near_n")).alias("form_n")), "spelling-forms")
    return rooted(formed).select("word", "form", "root", "n", "n_near", "form_n")


#: The query's rows by plain SQL: checksums from their definition, deletions as strings, forms by recursion.
ORACLE_SQL = r"""
WITH RECURSIVE tab AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(3988292384, c // 2) ELSE c // 2 END) AS c
    FROM (SELECT unnest(range(256)) AS i))),
runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS w
  FROM documents),
spelt AS (SELECT doc_id, w, count(*) AS k FROM runs WHERE length(w) >= 5 GROUP BY ALL),
coded AS (
  SELECT w, k, xor(4294967295, list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(coalesce(doc_id::VARCHAR, '') || ':' || w, ''),
      lambda c: CASE WHEN ord(c) < 128 THEN [ord(c)::BIGINT] ELSE [195::BIGINT, (ord(c) - 64)::BIGINT] END))),
    lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1]))) AS h
  FROM spelt, tab),
kept AS (
  SELECT CASE WHEN h % 97 = 0 THEN substr(w, 1, (h % length(w))::INT) || substr(w, (h % length(w))::INT + 2) ELSE w END AS word, k FROM coded),
words AS (SELECT word, sum(k)::BIGINT AS n FROM kept WHERE length(word) >= 5 GROUP BY word HAVING sum(k) >= 3),
cuts AS (SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM (SELECT word, n, unnest(range(length(word)))::INT AS i FROM words)),
pairs AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM cuts a JOIN cuts b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cuts a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM cuts a JOIN words b ON a.rest = b.word),
best AS (
  SELECT word, count(*) AS n_near, first(near ORDER BY near_n DESC, near) AS near, max(near_n) AS near_n FROM pairs GROUP BY word),
told AS (
  SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN near_n >= 2 * n THEN near END AS form, CASE WHEN near_n >= 2 * n THEN near_n END AS form_n
  FROM words w LEFT JOIN best b ON w.word = b.word),
walk AS (
  SELECT word, word AS at FROM told
  UNION ALL SELECT w.word, t.form FROM walk w JOIN told t ON w.at = t.word WHERE t.form IS NOT NULL)
SELECT t.word, t.form, w.at AS root, t.n, t.n_near, t.form_n
FROM told t JOIN walk w ON t.word = w.word JOIN told e ON e.word = w.at AND e.form IS NULL
"""
