"""Near-copy groups at a given Jaccard similarity of shingle sets: SimHash and min-hash cells, then exact comparison.

Documents meet by the SimHash operator (``simhash``: fingerprints, segment popcounts, the grid under Manhattan
distance).  Its 3 bits hold what differs in a few words of a long text; at a similarity of 0.8 fingerprints are some 10
bits apart.  So documents also meet in cells of a few min-hashes each: two sets agree in a min-hash with a probability of
just their similarity, whatever their size.  What meets either way is gathered, loosely, into components, and within each
of these the whole shingle sets are compared: no link rests on an estimate.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .shared import staged, text_column
from .shipping import ship
from .simhash import _then_none, near_groups, shingle_hashes, slices

#: Cells a document lies in, and min-hashes a cell.  A pair at a similarity of 0.8 shares none with a
#: probability of (1 - 0.8 ** 4) ** 32, some 5 in 100 million.
BANDS, ROWS = 32, 4
#: Bytes by which documents of a cell are compared roughly, each of one min-hash.
SKETCH = 48
#: Shingles hashed at once, and bytes of text read at once.
BLOCK, SLICE_BYTES = 4096, 500_000
#: Documents whose sets are compared in one group.
CHUNK = 256
#: Parts into which the rows of one key are dealt in joins.
SALTS = 32


def shingle_set(text: str, words: int) -> np.ndarray:
    return np.unique(np.array(shingle_hashes(text, words), np.uint64))


def min_hashes(sets: list[np.ndarray]) -> np.ndarray:
    """``BANDS * ROWS`` 32-bit min-hashes of each set that is not empty, one row a set."""
    flat = np.concatenate([np.zeros(0, np.uint64), *sets])
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    step = np.arange(1, BANDS * ROWS // 2 + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    out = np.full((len(sets), BANDS * ROWS), 0xFFFFFFFF, np.uint32)
    with np.errstate(over="ignore"):
        for at in range(0, len(flat), BLOCK):
            mixed, own = flat[at : at + BLOCK, None] + step, owner[at : at + BLOCK]
            for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
                mixed ^= mixed >> np.uint64(shift)
                mixed *= np.uint64(factor)
            mixed ^= mixed >> np.uint64(31)
            starts = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
            out[own[starts]] = np.minimum(out[own[starts]], np.minimum.reduceat(mixed.view("<u4"), starts, axis=0))
    return out


def least_agreeing(similarity: float) -> int:
    """Bytes of a sketch in which sets of ``similarity`` agree at least, but for five standard errors."""
    return int(SKETCH * similarity - 5 * (SKETCH * similarity * (1 - similarity)) ** 0.5)


def _cells(rows: DataFrame, words: int) -> DataFrame:
    """``cell, node, held``: each document with shingles once in each band, with its sketch."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch, size=SLICE_BYTES):
                part = batch.slice(a, b - a)
                sets = [shingle_set(t, words) for t in part.column(1).to_pylist()]
                some = np.array([i for i, s in enumerate(sets) if len(s)], np.int64)
                if not len(some):
                    continue
                least = min_hashes([sets[i] for i in some])
                cells = np.tile(np.arange(BANDS, dtype=np.uint64), (len(some), 1))
                with np.errstate(over="ignore"):
                    for row in range(ROWS):
                        cells = (cells ^ (cells >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + least[:, row::ROWS]
                    cells = (cells ^ (cells >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
                node = part.column(0).to_numpy(zero_copy_only=False)[some]
                sketch = pa.array([r.tobytes() for r in least[:, :SKETCH].astype(np.uint8)], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(cells.view(np.int64).ravel()), pa.array(np.repeat(node, BANDS)), sketch.take(pa.array(np.repeat(np.arange(len(some)), BANDS)))], names=["cell", "node", "held"])

    return rows.mapInArrow(spread, "cell long, node long, held binary").repartition("cell").sortWithinPartitions("cell", "node")


def _by_simhash(rows: DataFrame) -> DataFrame:
    """``a, b``: each document and the first of its SimHash group; texts without words are in none."""
    worded = rows.where(F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    return near_groups(worded, "node", "text").select(F.col("node").alias("a"), F.col("component_id").alias("b")).where("a <> b")


def _by_cell(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, list[bytes], np.ndarray]]:
    """Nodes, what they hold and what is known to connect them (a label each), cell by cell, where a cell holds more than one.

    Without a column of labels each node is its own.
    """
    cell, node, label, held = (*[np.zeros(0, np.int64)] * 3, [])
    for batch in _then_none(batches):
        if batch is None:
            whole = len(cell)
        else:
            numbers = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(batch.num_columns) if i != 2]
            cell, node = np.concatenate([cell, numbers[0]]), np.concatenate([node, numbers[1]])
            label, held = np.concatenate([label, numbers[-1] if len(numbers) > 2 else numbers[1]]), held + batch.column(2).to_pylist()
            whole = int(np.searchsorted(cell, cell[-1])) if len(cell) else 0
        bounds = np.flatnonzero(np.concatenate([[True], cell[1:whole] != cell[: whole - 1], [True]])) if whole else []
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            if b - a > 1:
                yield node[a:b], held[a:b], np.unique(label[a:b], return_inverse=True)[1]
        cell, node, label, held = cell[whole:], node[whole:], label[whole:], held[whole:]


def _agreeing(held: list[bytes], similarity: float):
    """Tells which documents may have the similarity to another by their sketches."""
    sketch, least = np.frombuffer(b"".join(held), np.uint8).reshape(len(held), -1), least_agreeing(similarity)
    return lambda i, others: (sketch[others] == sketch[i]).sum(axis=1) >= least


def _similar(held: list[bytes], similarity: float):
    """Tells which documents have the similarity to another by their whole shingle sets."""
    counts = np.array([len(h) // 8 for h in held])
    ends = np.cumsum(counts)
    kinds, of = np.unique(np.frombuffer(b"".join(held), "<u8"), return_inverse=True)
    marked = np.zeros(len(kinds), bool)

    def tell(i: int, others: np.ndarray) -> np.ndarray:
        own = of[ends[i] - counts[i] : ends[i]]
        small, large = np.minimum(counts[others], counts[i]), np.maximum(counts[others], counts[i])
        out = small / large >= similarity
        marked[own] = True
        for k in np.flatnonzero(out):
            j = others[k]
            shared = np.count_nonzero(marked[of[ends[j] - counts[j] : ends[j]]])
            out[k] = shared / (counts[i] + counts[j] - shared) >= similarity
        marked[own] = False
        return out

    return tell


def _links(cells: DataFrame, told_by, similarity: float) -> DataFrame:
    """``a, b``: links that connect, within each cell, all pairs that ``told_by`` finds.

    Each document is compared with all others that are not yet connected to it, but a group of copies
    never becomes all its pairs.
    """

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for node, held, root in _by_cell(batches):
            near, edges, one = told_by(held, similarity), [], (root == root[0]).all()
            for i in range(len(node) - 1):
                if one:
                    break
                other = np.flatnonzero(root[i + 1 :] != root[i]) + i + 1
                hit = other[near(i, other)] if len(other) else other
                if len(hit):
                    roots, at = np.unique(root[hit], return_index=True)
                    edges.append(np.stack([np.full(len(at), node[i]), node[hit[at]]], axis=1))
                    root[np.isin(root, roots)] = root[i]
                    one = (root == root[0]).all()
            if edges:
                pairs = np.concatenate(edges)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    return cells.mapInArrow(link, "a long, b long")


def _spread_join(rows: DataFrame, key: str, by: str, figures: DataFrame, figures_key: str) -> DataFrame:
    """``rows`` with the figures of their ``key``, of which there is one row: dealt by a salt of ``by``, too, since one
    key may have a third of the rows."""
    dealt = figures.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = rows.withColumn("_own_salt", F.pmod(F.xxhash64(by), F.lit(SALTS)).cast("int"))
    return salted.join(dealt.hint("merge"), (F.col(key) == F.col(figures_key)) & (F.col("_own_salt") == F.col("_salt"))).drop("_salt", "_own_salt")


def near_links(rows: DataFrame, words: int, similarity: float, chunk: int = CHUNK) -> DataFrame:
    """``a, b``: links that connect all near copies of ``rows`` (``node``, ``text``), each of them exact.

    Documents of one SimHash group, and those that share a cell and whose sketches agree well enough, are first connected loosely.  Within
    each loose component the whole shingle sets are compared: in one group if it has up to ``chunk``
    documents.  A larger one is dealt into groups of about so many, each with the component's first document
    beside them.  What is not connected to that one then is compared with all others of the component, group
    by group, so that no task ever holds more than two groups.
    """

    def with_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch, column=3, size=SLICE_BYTES):
                part = batch.slice(a, b - a)
                held = pa.array([shingle_set(t, words).astype("<u8").tobytes() for t in part.column(3).to_pylist()], pa.binary())
                yield pa.RecordBatch.from_arrays([*part.columns[:3], held], names=["root", "node", "n", "held"])

    def compared(groups: DataFrame) -> DataFrame:
        return _links(groups.repartition("cell").sortWithinPartitions("cell", "node"), _similar, similarity)

    met = _by_simhash(rows).unionByName(_links(_cells(rows, words), _agreeing, similarity))
    loose = staged(components(met.distinct()), "near-loose")
    sizes = loose.groupBy(F.col("root").alias("_r")).agg(F.count(F.lit(1)).alias("_n"))
    sized = _spread_join(loose, "root", "node", sizes, "_r").select(F.col("root"), F.col("node").alias("near"), F.col("_n").alias("n"))
    # What is joined here grows with the corpus: dealt out at every size, never broadcast.
    again = rows.join(sized.hint("merge"), F.col("node") == F.col("near")).select("root", "node", "n", "text")
    every_set = staged(again.mapInArrow(with_sets, "root long, node long, n long, held binary"), "near-sets")
    links = staged(compared(every_set.where(F.col("n") <= chunk).select(F.col("root").alias("cell"), "node", "held")), "near-links")
    if not sizes.where(F.col("_n") > chunk).limit(1).count():
        return links

    sets = every_set.where(F.col("n") > chunk).withColumn("_k", F.ceil(F.col("n") / chunk).cast("int")).drop("n")
    dealt = sets.withColumn("_c", F.pmod(F.xxhash64("node"), F.col("_k")).cast("int"))
    cell = lambda *parts: F.xxhash64("root", *parts).alias("cell")
    firsts = sets.where("node = root").select("root", "node", "held", F.explode(F.sequence(F.lit(0), F.col("_k") - 1)).alias("_c"))
    beside = dealt.where("node <> root").select("root", "node", "held", "_c").unionByName(firsts)
    near_first = staged(compared(beside.select(cell("_c"), "node", "held")), "near-links")

    known = components(near_first).withColumnRenamed("node", "_m").withColumnRenamed("root", "label")
    labelled = staged(dealt.join(known, F.col("node") == F.col("_m"), "left").select("root", "node", "held", "_c", "_k", F.coalesce("label", "node").alias("label")), "near-labels")
    # A first document is the smallest node of its component, so it labels what is connected to it.
    far = labelled.where("label <> root")
    n_far = far.groupBy(F.col("root").alias("_fr")).agg(F.ceil(F.count(F.lit(1)) / chunk).cast("int").alias("_f"))
    rest = _spread_join(labelled, "root", "node", n_far, "_fr")
    every = rest.select("root", "node", "held", "label", "_c", F.explode(F.sequence(F.lit(0), F.col("_f") - 1)).alias("_d"))
    others = rest.where("label <> root").select("root", "node", "held", "label", F.explode(F.sequence(F.lit(0), F.col("_k") - 1)).alias("_c"), F.pmod(F.xxhash64("node"), F.col("_f")).cast("int").alias("_d"))
    far_links = compared(every.unionByName(others).dropDuplicates(["root", "_c", "_d", "node"]).select(cell("_c", "_d"), "node", "held", "label"))
    return links.unionByName(near_first).unionByName(staged(far_links, "near-links"))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, similarity: float = 0.8) -> DataFrame:
    """``docs`` with one document of each group of near copies, the one of the smallest id; no other columns.

    Documents are near copies if their sets of ``words``-word shingles (words lower-cased, A-Z) have a Jaccard
    similarity of ``similarity`` or more, computed on the whole sets; groups are what such pairs connect.
    A pair that is in no SimHash group and shares no cell is missed, at a similarity of 0.8 with a probability of 5 in 100 million.  A text of fewer words is one shingle; null and wordless texts have none and always stay.
    Rows that repeat an id but not its text are told apart; a null id is the largest.
    """
    ship(docs.sparkSession)
    key = F.xxhash64(F.col(id_col), text_column(text_col))
    rows = docs.select(key.alias("node"), text_column(text_col).alias("text"))
    roots = staged(components(near_links(rows, words, similarity)), "near-roots")
    ids = docs.select(F.col(id_col).alias("_id"), key.alias("_node")).join(roots, F.col("_node") == F.col("node")).select("_id", "_node", "root")
    ids = staged(ids, "near-ids")
    stays = ids.groupBy(F.col("root").alias("_root")).agg(F.min(F.struct(F.col("_id").isNull(), F.col("_id"), F.col("_node"))).alias("_first"))
    gone = _spread_join(ids, "root", "_node", stays, "_root").where(F.col("_node") != F.col("_first._node")).select(F.col("_id").alias("_gone_id"), F.col("_node").alias("_gone_node"))
    # The rows travel as one column, so that no name of theirs can clash with these.
    told = docs.select(F.col(id_col).alias("_own_id"), key.alias("_own_node"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    left = told.join(gone.hint("merge"), F.col("_own_id").eqNullSafe(F.col("_gone_id")) & (F.col("_own_node") == F.col("_gone_node")), "left_anti")
    return left.select(*[F.col(f"_row.`{c}`").alias(c) for c in docs.columns])
