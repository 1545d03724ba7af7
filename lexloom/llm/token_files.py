"""Token-ID output: flat files of unsigned integers with 64-bit document offsets.

A written corpus is a folder.  ``PPPPP-FFFF.ids`` holds the ids of some documents in a row (unsigned 16-bit
little-endian where the vocabulary allows, else 32-bit).  The ``.off`` file beside it holds a pair of 64-bit
little-endian integers a document, its id (signed) and its first position in the file (unsigned), and a
last pair of the number of documents and the end position.  Files follow one another, by name, in
ascending document id; documents without an id come first.  ``manifest.json`` names the item type and, for
each file, its base (the position of its first id in the whole corpus), its numbers of documents and of
ids, and how many documents at its beginning have no id.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import encoder
from .shared import Writer, fresh_path, input_bytes, map_file, read_file, staged, text_column, write_file
from .shipping import ship

#: A file is closed once it holds so many bytes of ids.
FILE_BYTES = 256 << 20
#: Bytes of input that one range of ids is planned to hold.
RANGE_BYTES = 128 << 20
#: Characters of a text by which documents of one id are ordered across ranges.
HEAD_CHARS = 32


def write_token_files(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 0, path: str | None = None, partitions: int | None = None, file_bytes: int = FILE_BYTES) -> str:
    """Encode every text, append ``end_id``, and write all ids in ascending order of ``id_col``; gives the folder.

    Sampled splitters of the id range-partition the documents; each task sorts its range and streams it into
    files of about ``file_bytes``, so it holds one text and the offsets of one file at a time.  Only the
    files' counts meet, one row a file, and their prefix sums, the files' bases, go into the manifest.  A
    task that runs again writes the same files again, each in one step.

    Null text is empty and gives the end id alone.  Rows that repeat an id stand side by side, ordered by
    text.  Null ids come first and stay null.  An empty table gives a manifest without files.  Other columns
    are not read.
    """
    spark = docs.sparkSession
    ship(spark)
    path = path or fresh_path(spark, "token-files")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_column(text_col).alias("text"))
    head = F.substring("text", 1, HEAD_CHARS)
    wanted = partitions or max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-input_bytes(docs) // RANGE_BYTES))
    ranged = rows.withColumn("head", head).repartitionByRange(wanted, F.col("id").asc_nulls_first(), "head").drop("head")
    dtype = "<u2" if encoder(tokenizer).library.get_vocab_size() <= 65536 and end_id < 65536 else "<u4"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(tokenizer).encode, np.array([end_id], dtype).tobytes()
        part, done = TaskContext.get().partitionId(), []
        out, ids, starts, no_id = None, [], [0], 0

        def close():
            name = f"{part:05d}-{len(done):04d}"
            table = np.stack([np.array([*ids, len(ids)], "<i8"), np.array(starts, "<i8")], axis=1)
            write_file(f"{path}/{name}.off", [table.tobytes()])
            out.close()
            done.append((name, len(ids), starts[-1], no_id))

        for batch in batches:
            for i, text in zip(batch.column(0), batch.column(1), strict=True):
                out = out or Writer(f"{path}/{part:05d}-{len(done):04d}.ids")
                got = encode(text.as_py()).astype(dtype)
                out.write(got.tobytes())
                out.write(end)
                ids.append(i.as_py() or 0)
                no_id += not i.is_valid
                starts.append(starts[-1] + len(got) + 1)
                if starts[-1] * len(end) >= file_bytes:
                    close()
                    out, ids, starts, no_id = None, [], [0], 0
        if out:
            close()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), (pa.string(), *[pa.int64()] * 3), strict=True)], names=["name", "n_docs", "n_tokens", "no_id"])

    counts = staged(ranged.sortWithinPartitions(F.col("id").asc_nulls_first(), "text").mapInArrow(write, "name string, n_docs long, n_tokens long, no_id long"), "token-files-counts")
    base, files = 0, []
    for row in counts.orderBy("name").collect():  # one row a file
        files.append({"name": row.name, "base": base, "n_docs": row.n_docs, "n_tokens": row.n_tokens, "no_id": row.no_id})
        base += row.n_tokens
    write_file(f"{path}/manifest.json", [json.dumps({"dtype": dtype, "n_tokens": base, "files": files}, indent=1).encode()])
    return path


_READ = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])
#: Documents whose offsets are read at once.
SLICE = 8192


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the memory-mapped files and the manifest alone: ``doc_id, start, n_tokens, ids_crc32``.

    The checksum is that of the ids as little-endian unsigned 32-bit integers.
    """
    ship(spark)
    manifest = json.loads(read_file(f"{path}/manifest.json"))
    dtype, files = manifest["dtype"], [(f["name"], f["base"], f["no_id"]) for f in manifest["files"]]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, base, no_id in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids, table = map_file(f"{path}/{name}.ids", dtype), map_file(f"{path}/{name}.off", "<i8").reshape(-1, 2)
                for at in range(0, len(table) - 1, SLICE):
                    rows = np.array(table[at : at + SLICE + 1])
                    lo, hi = rows[:-1, 1], rows[1:, 1]
                    crc = [zlib.crc32(np.ascontiguousarray(ids[a:b], "<u4")) for a, b in zip(lo, hi, strict=True)]
                    doc = pa.array(rows[:-1, 0], mask=np.arange(at, at + len(lo)) < no_id)
                    yield pa.RecordBatch.from_arrays([doc, pa.array(lo + base), pa.array(hi - lo), pa.array(crc, pa.int64())], schema=_READ)

    listed = spark.createDataFrame(files, "name string, base long, no_id long")
    spread = listed.repartition(max(1, min(len(files), spark.sparkContext.defaultParallelism * 4)), "name")
    return spread.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")
