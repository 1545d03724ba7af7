"""Substring dedup by prefix doubling over the positions that can still matter.

A full suffix array ranks every byte position again and again; over a corpus that is tens of bytes moved
for every byte of text.  Here Spark sorts (rank, position) pairs at growing lengths, and after each round
only what is not yet unique goes on:

1. Length 32.  Every 100-byte string is represented by one sampled 32-byte string in it (``anchors``), some
   3 % of positions; strings that follow one another and share theirs make a run.  A rank that occurs
   once is unique, and with it every 100-byte string it stands for.
2. Whole runs, 100 bytes and more.  Of runs that are equal as a whole all but the earliest are repeats,
   past the threshold; the earliest goes on, as does a run that has no equal.
3. Length 64, then 100.  What is left of a run is cut in two: strings that hold the 32 bytes after the
   anchor, and those that hold the 32 bytes before it.  A rank at 64 bytes is the pair of ranks of its
   halves; a part that is unique goes.  Within a rank that repeats, the strings are ranked at 100 bytes
   by the pairs of 64-byte ranks at 0 and 36, their bytes are compared in full, and the earliest stays.

Ranks are 64-bit fingerprints composed by doubling rather than places in a sorted order.  They only bring
together what may be equal: a string is removed after its bytes (round 3) or a 128-bit digest of the
whole run (round 2) agreed.

A rank that very many positions share is no hot key: rounds 1 and 2 settle on the map side what repeats
within a batch and send one witness on; round 3 spreads it over salts, where all but the earliest of a salt
are certain repeats, and compares what is earliest in each salt once more, string by string.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .anchors import anchor_runs, window_hashes
from .shared import staged, text_column
from .shipping import ship

THRESHOLD = 100
GRAM = 32
#: Rows that share an id and the low bits of their digest are told apart above this many bits of a place.
PART_BITS = 40
#: Runs compared together: some hundred bytes a string, some twenty strings each.
BLOCK = 10_000
#: Runs combined on the map side before they are dealt out.
GATHER = 50_000
#: A rank that a gathered batch holds more often than this is spread over so many salts in round 3.
HOT, SALTS = 8, 256


def _texts(docs: DataFrame, id_col: str, text_col: str, threshold: int, buckets: int) -> tuple[DataFrame, str]:
    """Bucketed by (o, u): ``id, part, n_bytes, copy, text``; the text is left out of copies of an earlier text.

    ``o`` is the id in order, null first; ``u`` some bits of the text's digest, which spread rows that
    share an id, and all of 60 bits where it is null; ``part`` tells apart texts that still share both.
    """
    spark = docs.sparkSession
    text, i = text_column(text_col), F.col(id_col).cast("long")
    digest = F.sha2(text, 256)
    rows = docs.select(F.coalesce(i, F.lit(-(2**63))).alias("o"), F.conv(F.substring(digest, 1, F.when(i.isNull(), 15).otherwise(4)), 16, 10).cast("long").alias("u"), i.alias("id"), F.unhex(digest).alias("sha"), text.alias("text"))
    marks = rows.select("o", "u", "sha").distinct()
    first = marks.groupBy(F.col("sha").alias("s")).agg(F.min("o").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    # A text that very many rows hold: the few columns are dealt out by digest and a salt.
    first = first.select("s", "first", F.explode(F.sequence(F.lit(0), F.lit(31))).alias("s_salt"))
    later = marks.withColumn("salt", F.pmod(F.xxhash64("o"), F.lit(32)).cast("int")).join(first.hint("shuffle_hash"), (F.col("sha") == F.col("s")) & (F.col("salt") == F.col("s_salt")))
    later = later.where("o <> first").groupBy(F.col("o").alias("lo"), F.col("u").alias("lu")).agg(F.collect_set("sha").alias("later"))
    laid = rows.repartition(buckets, "o", "u").join(later, (F.col("o") == F.col("lo")) & (F.col("u") == F.col("lu")), "left")
    own = Window.partitionBy("o", "u").orderBy("sha")
    copy = F.coalesce(F.array_contains("later", F.col("sha")), F.lit(False)) | F.coalesce(F.lag("sha").over(own) == F.col("sha"), F.lit(False))
    told = laid.select("o", "u", "id", (F.dense_rank().over(own) - 1).cast("long").alias("part"), F.octet_length("text").cast("long").alias("n_bytes"), copy.alias("copy"), "text")
    told = told.withColumn("text", F.when(~F.col("copy") | (F.col("n_bytes") < threshold), F.col("text").cast("binary")))
    name = f"suffix_texts_{uuid.uuid4().hex}"
    told.write.option("compression", "zstd").bucketBy(buckets, "o", "u").sortBy("o", "u").saveAsTable(name)
    return spark.table(name), name


def _rows(*columns, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, pa.int64()) for c in columns], names=names)


def _gathered(parts: Iterator[tuple[np.ndarray, ...]], most: int) -> Iterator[list[np.ndarray]]:
    """The same columns in longer pieces of about ``most`` rows."""
    some, n = [], 0
    for part in parts:
        some.append(part)
        n += len(part[0])
        if n >= most:
            yield [np.concatenate(c) for c in zip(*some, strict=True)]
            some, n = [], 0
    if n:
        yield [np.concatenate(c) for c in zip(*some, strict=True)]


def _anywhere(o: np.ndarray, u: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A key under which a settled row meets nothing in particular."""
    with np.errstate(over="ignore"):
        mixed = (o.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ (at.view(np.uint64) * np.uint64(0xD6E8FEB86659FD93)) ^ u.view(np.uint64)
        return ((mixed ^ (mixed >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)).view(np.int64)


def _runs(batches: Iterator[pa.RecordBatch], threshold: int, gram: int, open_column: bool) -> Iterator[tuple]:
    """``o, u, base, data, rank, anchor, first, count`` of each text; with ``open_column`` of its listed starts only."""
    for batch in batches:
        for row in zip(*(batch.column(i) for i in range(4 + open_column)), strict=True):
            data, base = np.frombuffer(row[3].as_buffer(), np.uint8), row[2].as_py() << PART_BITS
            rank, anchor, first, count = anchor_runs(data, threshold, gram)
            if open_column:
                wanted = np.isin(first + base, row[4].values.to_numpy(zero_copy_only=False))
                rank, anchor, first, count = rank[wanted], anchor[wanted], first[wanted], count[wanted]
            if len(rank):
                yield row[0].as_py(), row[1].as_py(), base, data, rank.view(np.int64), anchor, first, count


_RANKED = ["key", "o", "u", "at", "sure"]
_WHOLE = ["key", "key2", "o", "u", "at", "size", "copy"]


def _ranked(batches: Iterator[pa.RecordBatch], threshold: int, gram: int) -> Iterator[pa.RecordBatch]:
    """Round 1, map side: one witness a rank and batch goes by its rank; the others are sure to repeat."""
    parts = ((rank, np.full(len(rank), o), np.full(len(rank), u), first + base) for o, u, base, _, rank, _, first, _ in _runs(batches, threshold, gram, False))
    for rank, o, u, at in _gathered(parts, GATHER):
        order = np.argsort(rank, kind="stable")
        rank, o, u, at = rank[order], o[order], u[order], at[order]
        again = np.concatenate([[False], rank[1:] == rank[:-1]])
        sure = again | np.append(again[1:], False)
        yield _rows(np.where(again, _anywhere(o, u, at), rank), o, u, at, sure, names=_RANKED)


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by key, those whose key occurs more than once or that are sure to repeat."""
    held, met = None, False
    for batch in batches:
        if not batch.num_rows:
            continue
        whole = pa.Table.from_batches([held, batch] if held is not None else [batch]).combine_chunks()
        key = whole.column(0).to_numpy()
        same = key[1:] == key[:-1]
        more = np.concatenate([[False], same]) | np.concatenate([same, [False]]) | (whole.column(4).to_numpy() > 0)
        more[0] |= met
        out = whole.slice(0, len(key) - 1).filter(pa.array(more[:-1]))
        if out.num_rows:
            yield from out.combine_chunks().to_batches()
        held, met = whole.slice(len(key) - 1).to_batches()[0], bool(more[-1])
    if held is not None and met:
        yield held


def _whole_runs(batches: Iterator[pa.RecordBatch], threshold: int, gram: int) -> Iterator[pa.RecordBatch]:
    """Round 2, map side: of equal runs of a batch the earliest goes by its digest; the others are copies."""

    def parts():
        for o, u, base, data, _, _, first, count in _runs(batches, threshold, gram, True):
            raw, size = memoryview(data), count + threshold - 1
            digest = np.frombuffer(b"".join(hashlib.md5(raw[a : a + n], usedforsecurity=False).digest() for a, n in zip(first.tolist(), size.tolist(), strict=True)), np.int64).reshape(-1, 2)
            yield digest[:, 0], digest[:, 1], np.full(len(first), o), np.full(len(first), u), first + base, size

    for key, key2, o, u, at, size in _gathered(parts(), GATHER):
        order = np.lexsort((at, u, o, key2, key))
        key, key2, o, u, at, size = (c[order] for c in (key, key2, o, u, at, size))
        again = np.concatenate([[False], (key[1:] == key[:-1]) & (key2[1:] == key2[:-1])])
        yield _rows(np.where(again, _anywhere(o, u, at), key), key2, o, u, at, size, again, names=_WHOLE)


def _first_of_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by both keys and position as ``o, u, at, size``: the size of a copy, 0 of what goes on."""
    last = None
    for batch in batches:
        key, key2, o, u, at, size, copy = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(7))
        if not len(key):
            continue
        again = np.concatenate([[last == (key[0], key2[0])], (key[1:] == key[:-1]) & (key2[1:] == key2[:-1])])
        last = (key[-1], key2[-1])
        yield _rows(o, u, at, np.where(again | (copy > 0), size, 0), names=["o", "u", "at", "size"])


_PARTS = ["rank", "salt", "o", "u", "at", "bytes"]


def _halves(batches: Iterator[pa.RecordBatch], threshold: int, gram: int) -> Iterator[pa.RecordBatch]:
    """Round 3, map side: what is left of the runs, in parts whose strings share 2 * ``gram`` bytes.

    A string that starts ``d`` bytes before its anchor holds the anchor and the bytes after it if ``d`` is at
    most ``threshold - 2 * gram``, else the anchor and the bytes before it.
    """

    def parts():
        for o, u, base, data, rank, anchor, first, count in _runs(batches, threshold, gram, True):
            double = window_hashes(data, 2 * gram).view(np.int64) if threshold >= 3 * gram - 1 else None
            turn = np.clip(anchor - (threshold - 2 * gram) - first, 0, count) if double is not None else np.zeros_like(count)
            for start, n, place in ((first, turn, anchor - gram), (first + turn, count - turn, anchor)):
                some = n > 0
                start, n = start[some], n[some]
                if not len(start):
                    continue
                size = n + threshold - 1
                ends = np.cumsum(size)
                taken = np.arange(ends[-1]) + np.repeat(start - (ends - size), size)
                own = double[place[some]] if double is not None else rank[some]
                strings = np.array([*map(bytes, np.split(data[taken], ends[:-1])), b""], object)[:-1]
                yield own, np.full(len(start), o), np.full(len(start), u), start + base, strings

    for rank, o, u, at, strings in _gathered(parts(), GATHER // 4):
        kinds, back, n = np.unique(rank, return_inverse=True, return_counts=True)
        hot = n > HOT
        salt = np.where(hot[back], 1 + np.abs(_anywhere(o, u, at)) % SALTS, 0)
        flags = kinds[hot]  # tell those that stay under salt 0 of the others
        nil = np.full(len(flags), -(2**63))
        yield _rows(
            np.concatenate([flags, rank]), np.concatenate([np.zeros_like(flags), salt]), np.concatenate([nil, o]), np.concatenate([np.full(len(flags), -1), u]), np.concatenate([np.full(len(flags), -1), at]),
            pa.array([*[b""] * len(flags), *strings.tolist()], pa.binary()), names=_PARTS,
        )


def _kinds(strings: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First place of each kind of string, and each one's kind: by fingerprint, checked byte by byte."""
    _, first, kind = np.unique(values, return_index=True, return_inverse=True)
    if (strings == strings[first[kind]]).all():
        return first, kind
    flat = np.ascontiguousarray(strings).view(f"V{strings.shape[1]}").ravel()
    _, first, kind = np.unique(flat, return_index=True, return_inverse=True)
    return first, kind


def _resolved(batches: Iterator[pa.RecordBatch], threshold: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (rank, salt, position) as ``o, u, at, size, string``.

    ``size`` is that of a span that is repeated; 0 marks a string, the earliest of its salt, that must yet be
    compared with those of other salts.
    """
    group = (0, 0)  # rank and salt
    hot, seen, seen_values = False, np.zeros((0, threshold), np.uint8), np.zeros(0, np.uint64)
    for whole in batches:
        for at_row in range(0, whole.num_rows, BLOCK):
            block = whole.slice(at_row, BLOCK)
            rank, salt, o, u, at = (block.column(i).to_numpy(zero_copy_only=False) for i in range(5))
            strings = block.column(5).to_pylist()
            size = np.array([len(x) for x in strings], np.int64)
            count = np.maximum(size - threshold + 1, 0)
            row = np.repeat(np.arange(len(rank)), count)
            nth = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            data = np.frombuffer(b"".join(strings), np.uint8)
            begins = (np.cumsum(size) - size)[row] + nth
            new = np.concatenate([[(rank[0], salt[0]) != group], (rank[1:] != rank[:-1]) | (salt[1:] != salt[:-1])])
            nr = np.cumsum(new)  # 0 is the group that goes on from before
            flagged = (at < 0) | (salt > 0)
            hot_groups = np.zeros(nr[-1] + 1, bool)
            hot_groups[0] = hot
            hot_groups[nr[flagged]] = True
            carried = 0 if new[0] else len(seen)
            if len(row):
                own = np.lib.stride_tricks.sliding_window_view(data, threshold)[begins]
                values = window_hashes(data, threshold)[begins]
            else:
                own, values = np.zeros((0, threshold), np.uint8), np.zeros(0, np.uint64)
            every = np.concatenate([seen, own]) if carried else own
            value = np.concatenate([seen_values, values]) if carried else values
            of = np.concatenate([np.zeros(carried, np.int64), nr[row]])
            with np.errstate(over="ignore"):
                mixed = value ^ (of.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            tagged = np.concatenate([every, np.ascontiguousarray(of).view(np.uint8).reshape(-1, 8)], axis=1)
            first, kind = _kinds(tagged, mixed)
            again = (first[kind] != np.arange(len(kind)))[carried:]
            edge = row[1:] != row[:-1]
            start_ = again & np.concatenate([[True], ~again[:-1] | edge])[: len(again)]
            stop_ = again & np.concatenate([~again[1:] | edge, [True]])[: len(again)]
            a, b = np.flatnonzero(start_), np.flatnonzero(stop_)
            fresh = np.flatnonzero(~again & hot_groups[nr[row]])
            if len(a) or len(fresh):
                texts = [*[None] * len(a), *map(bytes, own[fresh])]
                who, shift = np.concatenate([row[a], row[fresh]]), np.concatenate([nth[a], nth[fresh]])
                sizes = np.concatenate([nth[b] - nth[a] + threshold, np.zeros(len(fresh), np.int64)])
                yield _rows(o[who], u[who], at[who] + shift, sizes, pa.array(texts, pa.binary()), names=["o", "u", "at", "size", "string"])
            group, hot = (rank[-1], salt[-1]), bool(hot_groups[nr[-1]])
            last = np.flatnonzero((of == nr[-1]) & (first[kind] == np.arange(len(kind))))
            seen, seen_values = every[last], value[last]


def repeated_spans(texts: DataFrame, threshold: int, gram: int) -> DataFrame:
    """``o, u, at, size``: bytes covered by strings of ``threshold`` bytes that start earlier too."""
    long_enough = texts.where((F.col("n_bytes") >= threshold) & ~F.col("copy")).select("o", "u", "part", "text")
    longs = lambda names: ", ".join(f"{n} long" for n in names)

    def listed(rows: DataFrame) -> DataFrame:
        own = rows.groupBy(F.col("o").alias("ho"), F.col("u").alias("hu")).agg(F.collect_list("at").alias("hits"))
        return long_enough.join(own, (F.col("o") == F.col("ho")) & (F.col("u") == F.col("hu"))).select("o", "u", "part", "text", "hits")

    ranked = long_enough.mapInArrow(lambda b: _ranked(b, threshold, gram), longs(_RANKED)).repartition("key").sortWithinPartitions("key")
    shared = ranked.mapInArrow(_repeated, longs(_RANKED))
    runs = listed(shared).mapInArrow(lambda b: _whole_runs(b, threshold, gram), longs(_WHOLE)).repartition("key").sortWithinPartitions("key", "key2", "o", "u", "at")
    told = staged(runs.mapInArrow(_first_of_runs, "o long, u long, at long, size long"), "suffix-runs")
    halves = listed(told.where("size = 0")).mapInArrow(lambda b: _halves(b, threshold, gram), longs(_PARTS[:-1]) + ", bytes binary").repartition("rank", "salt").sortWithinPartitions("rank", "salt", "o", "u", "at")
    resolved = staged(halves.mapInArrow(lambda b: _resolved(b, threshold), "o long, u long, at long, size long, string binary"), "suffix-spans")
    # What several salts hold: few rows a string, one a salt at most.
    nth = F.row_number().over(Window.partitionBy("string").orderBy("o", "u", "at"))
    across = resolved.where("size = 0").withColumn("nth", nth).where("nth > 1").select("o", "u", "at", F.lit(threshold).cast("long").alias("size"))
    return told.where("size > 0").unionByName(resolved.where("size > 0").drop("string")).unionByName(across)


_OUT = "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = THRESHOLD, gram: int = GRAM, keep_text: bool = False, buckets: int | None = None) -> DataFrame:
    """Remove each byte covered by a string of ``threshold`` bytes that also starts earlier.

    Earlier means in a row of smaller id or, in the same row, at a smaller place; strings are judged on the
    input and never cross rows.  Returns one row a row: id, ``n_bytes, n_removed, n_spans`` (maximal removed
    runs), ``kept_sha256`` and, if asked for, the ``kept`` bytes.

    Null text is empty.  Rows that repeat an id are ordered by the SHA-256 of their texts; a null id is
    the smallest.  A row whose whole text an earlier row holds goes as a whole and is not ranked.  Texts
    below ``threshold`` bytes lose nothing.  An empty table gives none; other columns are not read.

    The work is done when this returns: the table of texts that the rounds read is dropped by then.
    """
    if not 0 < gram <= threshold:
        raise ValueError("gram is 1 to threshold")
    spark = docs.sparkSession
    ship(spark)
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts, name = _texts(docs, id_col, text_col, threshold, buckets)
    spans = repeated_spans(texts, threshold, gram).groupBy(F.col("o").alias("so"), F.col("u").alias("su")).agg(F.collect_list(F.struct("at", "size")).alias("spans"))
    read = texts.join(spans, (F.col("o") == F.col("so")) & (F.col("u") == F.col("su")), "left")
    read = read.select("id", "part", "n_bytes", "copy", "text", F.col("spans.at").alias("starts"), F.col("spans.size").alias("sizes"))

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for i, part, n, copy, text, starts, sizes in zip(*(batch.column(k) for k in range(7)), strict=True):
                n = n.as_py()
                if copy.as_py() and n >= threshold:
                    out.append((i.as_py(), n, n, 1, hashlib.sha256().hexdigest(), b"" if keep_text else None))
                    continue
                data, runs, lost = text.as_py(), 0, 0
                if starts.is_valid:
                    start, size = (np.array(x.values.to_numpy(zero_copy_only=False)) for x in (starts, sizes))
                    mine = (start >> PART_BITS) == part.as_py()
                    start, size = start[mine] & ((1 << PART_BITS) - 1), size[mine]
                    cover = np.zeros(n + 1, np.int32)
                    np.add.at(cover, start, 1)
                    np.add.at(cover, start + size, -1)
                    gone = np.cumsum(cover)[:n] > 0
                    lost, runs = int(gone.sum()), int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
                    data = np.frombuffer(data, np.uint8)[~gone].tobytes()
                out.append((i.as_py(), n, lost, runs, hashlib.sha256(data).hexdigest(), data if keep_text else None))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (*[pa.int64()] * 4, pa.string(), pa.binary()), strict=True)], names=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    done = staged(read.mapInArrow(remove, _OUT).withColumnRenamed("id", id_col), "suffix-dedup")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    return done if keep_text else done.drop("kept")
