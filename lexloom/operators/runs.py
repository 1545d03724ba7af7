"""Runs that ask something for every piece of work, and go on where they ended.

A run is a folder.  ``_run.json`` fixes its number of slices; ``slice=0007/`` holds what was recorded of the keys that
fall into that slice: files of JSON lines, each put in place whole once a few answers are there.  Before a task asks
anything it reads what its slices hold already, whoever wrote it, this session, an earlier one, or a task that was
lost.  So an accepted answer that was put in place is never asked for again, attempts add up over sessions, and a key
whose attempts are used up is terminal: it has no answer, never a guess.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .commits import _names, _read, put_if_absent

_RECORD = "key string, prompt_sha string, attempt int, outcome string, answer string, problem string, at double"


class Stop(Exception):
    """Raised by a provider that takes no more for now: the task ends there, the call is no attempt, what is left stays open."""


def slices_of(spark: SparkSession, root: str, wanted: int = 64) -> int:
    """The run's number of slices, fixed by whoever comes first."""
    put_if_absent(spark, f"{root}/_run.json", {"slices": wanted})
    return _read(spark, f"{root}/_run.json")["slices"]


class _Slice:
    """Records of one slice: read when it is opened, put in place in files of some records each."""

    def __init__(self, root: str, number: int, every: int):
        from pyarrow import fs

        self.store, base = fs.FileSystem.from_uri(root) if "://" in root else (fs.LocalFileSystem(), root)
        self.folder, self.every, self.fresh = f"{base}/slice={number:04d}", every, []
        self.tries: dict[str, int] = {}
        self.accepted: set[str] = set()
        self.store.create_dir(self.folder, recursive=True)
        for info in self.store.get_file_info(fs.FileSelector(self.folder)):
            if info.base_name.endswith(".jsonl") and not info.base_name.startswith("."):
                with self.store.open_input_stream(info.path) as f:
                    for line in f.read().decode().splitlines():
                        self._note(json.loads(line))

    def _note(self, record: dict) -> None:
        self.tries[record["key"]] = max(self.tries.get(record["key"], 0), record["attempt"])
        if record["outcome"] == "accepted":
            self.accepted.add(record["key"])

    def add(self, record: dict) -> None:
        self._note(record)
        self.fresh.append(json.dumps(record, ensure_ascii=False, sort_keys=True))
        if len(self.fresh) >= self.every:
            self.flush()

    def flush(self) -> None:
        if self.fresh:
            name = uuid.uuid4().hex
            with self.store.open_output_stream(f"{self.folder}/.{name}.part") as f:
                f.write(("\n".join(self.fresh) + "\n").encode())
            self.store.move(f"{self.folder}/.{name}.part", f"{self.folder}/{name}.jsonl")
            self.fresh = []


def run(work: DataFrame, root: str, key: str, prompt: str, generate: Callable[[dict, int], str], accept: Callable[[str], bool], retries: int = 2, slices: int = 64, every: int = 8) -> DataFrame:
    """Ask for all work that is neither accepted nor terminal; gives ``state`` of the run.

    ``generate`` takes a row of ``work`` as a dict and the number of the attempt (from 1, over all sessions) and runs on the
    executors, as does ``accept``.  A failed call is a failed attempt, an answer that is not accepted is another;
    after ``retries`` more the key is terminal.  At most ``every`` answers that were not yet put in place are lost
    with a task.  A task asks for its keys one after the other: as many calls run at once as there are tasks.  Keys are
    compared as text; a key that comes twice is asked for once, a null key fails.
    """
    spark = work.sparkSession
    n = slices_of(spark, root, slices)
    told = F.coalesce(F.col(key).cast("string"), F.raise_error(F.lit("work without a key")).cast("string"))
    laid = work.withColumn("_key", told).withColumn("_slice", F.pmod(F.xxhash64("_key"), F.lit(n)).cast("int"))
    laid = laid.repartition(n, "_slice").sortWithinPartitions("_slice", "_key")
    sha = F.sha2(F.col(prompt).cast("string"), 256)
    columns = [c for c in work.columns]

    def ask(batches: Iterator) -> Iterator:
        import pyarrow as pa

        held, counts = None, {"asked": 0, "accepted": 0}
        number = None
        try:
            for batch in batches:
                for row in batch.to_pylist():
                    if row["_slice"] != number:
                        if held:
                            held.flush()
                        number = row["_slice"]
                        held = _Slice(root, number, every)
                    k = row["_key"]
                    while k not in held.accepted and held.tries.get(k, 0) <= retries:
                        attempt, answer, problem = held.tries.get(k, 0) + 1, None, None
                        try:
                            answer = generate({c: row[c] for c in columns}, attempt)
                            good = accept(answer)
                        except Stop:
                            return
                        except Exception as wrong:  # a failed call is a failed attempt
                            good, problem = False, f"{type(wrong).__name__}: {wrong}"
                        counts["asked"] += 1
                        counts["accepted"] += good
                        held.add({"key": k, "prompt_sha": row["_sha"], "attempt": attempt, "outcome": "accepted" if good else "failed" if problem else "rejected", "answer": answer, "problem": problem, "at": time.time()})
        finally:
            if held:
                held.flush()
            yield pa.RecordBatch.from_pydict({"asked": pa.array([counts["asked"]], pa.int64()), "accepted": pa.array([counts["accepted"]], pa.int64())})

    laid.withColumn("_sha", sha).mapInArrow(ask, "asked long, accepted long").agg(F.sum("asked")).collect()
    return state(work, root, key, retries)


def records(spark: SparkSession, root: str) -> DataFrame:
    """Every attempt that was recorded."""
    if not _names(spark, root, r"slice=(\d+)"):
        return spark.createDataFrame([], _RECORD)
    return spark.read.schema(_RECORD).option("pathGlobFilter", "*.jsonl").json(f"{root}/slice=*")


def state(work: DataFrame, root: str, key: str, retries: int = 2) -> DataFrame:
    """``key, status, attempts, answer``: each distinct key of the work as ``accepted``, ``terminal`` or ``open``."""
    told = records(work.sparkSession, root).groupBy(F.col("key").alias("_k")).agg(F.max("attempt").alias("attempts"), F.min_by("answer", F.when(F.col("outcome") == "accepted", F.col("attempt"))).alias("answer"), F.max(F.col("outcome") == "accepted").alias("_ok"))
    asked = work.select(F.col(key).alias("key")).distinct()
    status = F.when(F.coalesce(F.col("_ok"), F.lit(False)), "accepted").when(F.coalesce(F.col("attempts") > retries, F.lit(False)), "terminal").otherwise("open")
    joined = asked.join(told, F.col("key").cast("string") == F.col("_k"), "left")
    return joined.select("key", status.alias("status"), F.coalesce("attempts", F.lit(0)).alias("attempts"), F.when(F.col("_ok"), F.col("answer")).alias("answer"))
