"""Shared folder, staged tables and small file access used by the operators.

Intermediate results are cut from their lineage by writing them below the folder named in
``spark.checkpoint.dir``, which every executor can read.  Only where that setting is missing
(local tests) does a temporary folder take its place.
"""

from __future__ import annotations

import os
import posixpath
import tempfile
import uuid
from collections.abc import Iterable
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_fallback: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; on a local master a fresh temporary one where that is unset."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _fallback:
        _fallback[app] = "file://" + tempfile.mkdtemp(prefix="lexloom-")
    return _fallback[app]


def _own_dir(spark: SparkSession) -> str:
    return posixpath.join(shared_dir(spark), f"lexloom-{spark.sparkContext.applicationId}")


def fresh_path(spark: SparkSession, label: str) -> str:
    return posixpath.join(_own_dir(spark), f"{label}-{uuid.uuid4().hex}")


def clean(spark: SparkSession) -> None:
    """Delete all that this application staged; tables that still read it are no longer to be used."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_own_dir(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def staged(df: DataFrame, label: str, compression: str = "zstd") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: later failures restart from there."""
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_column(text_col: str):
    """The whole text; null counts as empty."""
    return F.coalesce(F.col(text_col).cast("string"), F.lit(""))


def hold_name(columns: Iterable[str], wanted: str) -> str:
    """``wanted``, with underscores appended until it clashes with none of ``columns`` (any case)."""
    taken = {c.lower() for c in columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def ascii_lower(column):
    """Lower-case A-Z and nothing else.

    ``lower`` does just that for pure ASCII text and is much the faster of the two.
    """
    return F.when(F.octet_length(column) == F.char_length(column), F.lower(column)).otherwise(
        F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    )


def local_path(path: str) -> str | None:
    """The plain path behind ``path`` if it is on a file system mounted on every machine."""
    parts = urlparse(path)
    return parts.path if parts.scheme in ("", "file") else None


class Writer:
    """A file that appears in one step when it is closed: no half-written attempt of a lost task is ever seen."""

    def __init__(self, path: str):
        self.path, plain = path, local_path(path)
        if plain is None:
            from pyarrow import fs

            self.store, self.final = fs.FileSystem.from_uri(path)
            self.part = f"{self.final}.{uuid.uuid4().hex}"
            self.out = self.store.open_output_stream(self.part)
        else:
            self.store, self.final = None, plain
            os.makedirs(os.path.dirname(plain), exist_ok=True)
            self.part = f"{plain}.{uuid.uuid4().hex}"
            self.out = open(self.part, "wb", buffering=1 << 20)

    def write(self, chunk: bytes) -> None:
        self.out.write(chunk)

    def close(self) -> None:
        if self.store is not None:
            self.out.close()
            self.store.move(self.part, self.final)
            return
        self.out.flush()
        os.fsync(self.out.fileno())
        self.out.close()
        os.replace(self.part, self.final)


def write_file(path: str, chunks: Iterable[bytes]) -> None:
    out = Writer(path)
    for chunk in chunks:
        out.write(chunk)
    out.close()


def read_file(path: str) -> bytes:
    plain = local_path(path)
    if plain is None:
        from pyarrow import fs

        store, inner = fs.FileSystem.from_uri(path)
        with store.open_input_file(inner) as f:
            return f.read()
    with open(plain, "rb") as f:
        return f.read()


def input_bytes(df: DataFrame) -> int:
    """Catalyst's estimate of the bytes that ``df`` holds, 0 where it has none; only to plan numbers of partitions."""
    told = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return told if told < 1 << 55 else 0


def map_file(path: str, dtype: str):
    """A read-only numpy view of a file, memory-mapped where the file system is mounted."""
    import numpy as np

    plain = local_path(path)
    if plain is None:
        from pyarrow import fs

        store, inner = fs.FileSystem.from_uri(path)
        with store.open_input_file(inner) as f:
            return np.frombuffer(f.read(), dtype)
    return np.memmap(plain, dtype, "r") if os.path.getsize(plain) else np.zeros(0, dtype)
