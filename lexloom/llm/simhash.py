"""SimHash near-dedup by segment popcounts, a grid join under Manhattan distance, and exact checks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .shared import staged, text_column
from .shipping import ship

SEED = 42
#: Texts hashed at once, in bytes: a worker holds some ten times as much.
SLICE_BYTES = 2_000_000
#: Up to so many distinct fingerprints segments have 2 bits, beyond it 1.
FEW = 1 << 25


def shingle_hashes(text: str, words: int) -> list[int]:
    """XXH64 of every run of ``words`` words (fewer words: of the whole), repeats included."""
    from xxhash import xxh64_intdigest

    got = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z only, and ASCII white space only
    if not got:
        return []
    line, ends = b" ".join(got), np.cumsum([len(w) + 1 for w in got]).tolist()
    starts = [0, *ends]
    return [xxh64_intdigest(line[s : e - 1], SEED) for s, e in zip(starts, ends[words - 1 :] or ends[-1:], strict=False)]


def _tally(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """How often each bit is set in the hashes of each document: one row a document.

    ``hashes`` (rows of 64-bit words) hold the documents' rows one after another, ``counts`` of each.
    Fifteen rows are first added bit by bit by full adders into four weighted words.
    """
    width, docs = hashes.shape[1], len(counts)
    groups = -(-counts // 15)
    first = np.concatenate([[0], np.cumsum(groups)])
    padded = np.zeros((int(first[-1]) * 15, width), np.uint64)
    place = np.arange(len(hashes)) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(first[:-1] * 15, counts)
    padded[place] = hashes
    rows = [padded[i::15] for i in range(15)]
    planes = []
    while rows:  # each pass leaves one row of its weight and the carries for the next
        carries = []
        while len(rows) > 1:
            x, y, z = rows.pop(), rows.pop(), rows.pop()
            odd = x ^ y
            rows.append(odd ^ z)
            carries.append((x & y) | (odd & z))
        planes.append(rows[0])
        rows = carries
    out = np.zeros((docs, width * 64), np.int64)
    filled = groups > 0
    for weight, plane in enumerate(planes):
        bits = np.unpackbits(np.ascontiguousarray(plane).astype("<u8").view(np.uint8).reshape(len(plane), -1), axis=1, bitorder="little")
        if len(bits):
            out[filled] += np.add.reduceat(bits, first[:-1][filled], axis=0, dtype=np.int64) << weight
    return out


def simhash(hash_lists: list[list[int]]) -> np.ndarray:
    """64-bit fingerprints: a bit is 1 if set in over half of the hashes; 0 where there are none."""
    counts = np.array([len(h) for h in hash_lists], np.int64)
    flat = np.fromiter((x for h in hash_lists for x in h), np.uint64, int(counts.sum())).reshape(-1, 1)
    ones = 2 * _tally(flat, counts) > counts[:, None]
    return np.packbits(ones, axis=1, bitorder="little").view("<u8").ravel()


def slices(batch: pa.RecordBatch, column: int = 1, size: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """(start, stop) of runs of rows whose texts have about ``size`` bytes, one row at least."""
    import pyarrow.compute as pc

    ends = np.cumsum(pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(ends):
        stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + size)))
        yield start, stop
        start = stop


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3) -> DataFrame:
    """``id, fp``: the fingerprint of each text as a signed 64-bit integer; 0 for null and wordless texts."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch):
                part = batch.slice(a, b - a)
                fp = simhash([shingle_hashes(t, words) for t in part.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(fp.view(np.int64))], names=["id", "fp"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_column(text_col).alias("text"))
    return rows.mapInArrow(hashed, "id long, fp long")


def popcount_cells(fp: np.ndarray, width: int = 2) -> np.ndarray:
    """Cells of the grid that a fingerprint lies in, for distances up to 3: 64 / ``width`` columns of 64-bit keys.

    The embedding counts the set bits of each segment of ``width`` bits (2 or 1).  Flipping a bit
    moves one count by one, so the Manhattan distance of two embeddings is a lower bound of the bits in
    which fingerprints differ.  At a distance of 3 or less, one half of the segments holds at most 1 of
    it: in that half all counts but one agree.  A cell is named by the half, the count left open and the
    other counts, so any two fingerprints within the distance share a cell.  With 2 bits a fingerprint lies
    in 32 cells, named by 15 counts; with 1 bit in 64, named by 31, so that far fewer others share one.
    """
    ones = np.uint64(0x5555555555555555)
    counts = (fp & ones) + ((fp >> np.uint64(1)) & ones) if width == 2 else fp  # a field holds each segment's count
    each = 32 // width
    out = np.empty((len(fp), 2 * each), np.uint64)
    for half in range(2):
        part = (counts >> np.uint64(32 * half)) & np.uint64(0xFFFFFFFF)
        for open_ in range(each):
            out[:, half * each + open_] = (part | np.uint64(((1 << width) - 1) << (width * open_))) << np.uint64(8) | np.uint64(half * each + open_)
    return out


def bits_apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Bits in which 64-bit values differ; of signed values numpy would count the bits of the magnitude."""
    return np.bitwise_count(a.view(np.uint64) ^ b.view(np.uint64))


def linked_in_cell(fp: np.ndarray, distance: int) -> np.ndarray:
    """Row pairs that join all that is connected by at most ``distance`` bits within one cell: a spanning forest.

    Every pair of the cell's distinct fingerprints is compared (in blocks), but at most one pair a
    fingerprint comes out.
    """
    n = len(fp)
    root = np.arange(n)
    edges = []
    for i in range(n - 1):
        near = np.flatnonzero(bits_apart(fp[i + 1 :], fp[i : i + 1]) <= distance) + i + 1
        if len(near):
            roots, at = np.unique(root[near], return_index=True)
            other = roots != root[i]
            if other.any():
                edges += [(i, int(near[k])) for k in at[other]]
                root[np.isin(root, roots[other])] = root[i]
    return np.array(edges, np.int64).reshape(-1, 2)


def links(prints: DataFrame, distance: int = 3, width: int | None = None) -> DataFrame:
    """``a, b``: pairs of distinct fingerprints that connect all those within ``distance`` (at most 3) bits.

    ``width``, the bits of a segment, follows from the number of distinct fingerprints unless it is given:
    pairs that share a cell grow with its square, and with 1 bit a cell is 16,000 times rarer.
    """
    if not 0 <= distance <= 3:
        raise ValueError("the grid is laid for distances up to 3")
    distinct = prints.select("fp").distinct()
    if width is None:
        width = 2 if prints.agg(F.approx_count_distinct("fp")).first()[0] <= FEW else 1

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False)
            for at in range(0, len(fp), 65536):
                some = fp[at : at + 65536]
                cells = popcount_cells(some.view(np.uint64), width)
                yield pa.RecordBatch.from_arrays([pa.array(cells.ravel().view(np.int64)), pa.array(np.repeat(some, cells.shape[1]))], names=["cell", "fp"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, fp = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in _then_none(batches):
            if batch is None:
                whole, cell_left, fp_left = len(cell), None, None
            else:
                cell = np.concatenate([cell, batch.column(0).to_numpy(zero_copy_only=False)])
                fp = np.concatenate([fp, batch.column(1).to_numpy(zero_copy_only=False)])
                whole = int(np.searchsorted(cell, cell[-1])) if len(cell) else 0  # the last cell may go on
                cell_left, fp_left = cell[whole:], fp[whole:]
            if whole:
                yield _pairs(cell[:whole], fp[:whole], distance)
            cell, fp = cell_left, fp_left

    cells = distinct.mapInArrow(spread, "cell long, fp long")
    grouped = cells.repartition("cell").sortWithinPartitions("cell", "fp")
    return grouped.mapInArrow(compare, "a long, b long").distinct()


def _then_none(batches):
    yield from batches
    yield None


def _pairs(cell: np.ndarray, fp: np.ndarray, distance: int) -> pa.RecordBatch:
    """Links within sorted cells: small cells all at once by shifts, large ones each by itself."""
    start = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
    sizes = np.diff(np.concatenate([start, [len(cell)]]))
    left, right = [], []
    small = np.repeat(sizes <= 16, sizes)
    for shift in range(1, min(16, int(sizes.max()))):
        same = np.flatnonzero((cell[shift:] == cell[:-shift]) & small[shift:] & (bits_apart(fp[shift:], fp[:-shift]) <= distance))
        left.append(fp[same])
        right.append(fp[same + shift])
    for a, n in zip(start[sizes > 16], sizes[sizes > 16], strict=True):
        own = fp[a : a + n]
        pairs = linked_in_cell(own, distance)
        left.append(own[pairs[:, 0]])
        right.append(own[pairs[:, 1]])
    none = np.zeros(0, np.int64)
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate([none, *left])), pa.array(np.concatenate([none, *right]))], names=["a", "b"])


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, distance: int = 3) -> DataFrame:
    """One row a document: id, ``fingerprint`` (16 hex digits), ``component_id``.

    Documents are linked where fingerprints differ in ``distance`` bits or fewer; ``component_id`` is the
    smallest id that a document reaches.  Documents of one fingerprint are one node of the graph, so
    copies are never paired.  Null and wordless texts have fingerprint 0, which links like any other.
    Rows that repeat an id are nodes by their fingerprints; a null id is never the smallest unless a
    component has no other (then null).  An empty table gives none.  Other columns are not read.
    """
    ship(docs.sparkSession)
    prints = staged(fingerprints(docs, id_col, text_col, words), "simhash-prints")
    nodes = prints.groupBy("fp").agg(F.min("id").alias("least"))
    roots = components(links(prints, distance))
    rooted = nodes.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    rooted = staged(rooted, "simhash-roots")
    smallest = rooted.groupBy(F.col("root").alias("_r")).agg(F.min("least").alias("component_id"))
    named = rooted.join(smallest, F.col("root") == F.col("_r")).select(F.col("fp").alias("_fp"), "component_id")
    return prints.join(named, F.col("fp") == F.col("_fp")).select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
