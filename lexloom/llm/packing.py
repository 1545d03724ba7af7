"""Packing of token pieces into fixed-length sequences by swap-based local search.

How pieces fit together depends on their lengths alone, so the search runs on the histogram of lengths
(at most ``capacity`` rows): a bin is a pattern of lengths with a multiplicity, and every step of the
search serves many bins of two patterns at once.  It starts from a cheap packing (next fit) and moves
or exchanges pieces, one for one or two for one, between underfull bins; each step raises the squared
fill, until bins are empty.  Best fit serves as a check: where bins above the lower bound are left, the
search runs from its packing, too, and the fewer bins count.  Documents then take their places by rank
within their length.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import encoder
from .shared import staged, text_column
from .shipping import ship

CAPACITY = 2048
#: Pieces that the search packs at once where there are more: what it costs on the driver grows with it.
COARSE = 32_768
#: Rows of the broadcast table, 48 bytes each, at most.
PLACEMENTS = 1_000_000

Pattern = tuple[int, ...]


def best_fit(counts: dict[int, int], capacity: int) -> dict[Pattern, int]:
    """Best-fit decreasing over a histogram: patterns of lengths (descending) and how many bins have each."""
    open_bins: dict[int, list[list]] = defaultdict(list)
    gaps: list[int] = []
    done: dict[Pattern, int] = defaultdict(int)

    def put(pattern: Pattern, gap: int, times: int, smallest: int) -> None:
        if times and gap < smallest:
            done[pattern] += times
        elif times:
            if not open_bins[gap]:
                insort(gaps, gap)
            open_bins[gap].append([pattern, times])

    lengths = sorted((n for n in counts if counts[n] > 0), reverse=True)
    for length in lengths:
        left = counts[length]
        while left:
            at = bisect_left(gaps, length)
            if at == len(gaps):
                pattern, gap, times = (), capacity, left
            else:
                gap = gaps[at]
                pattern, times = open_bins[gap].pop()
                if not open_bins[gap]:
                    gaps.pop(at)
            each = gap // length
            full = min(times, left // each)
            put(pattern + (length,) * each, gap - each * length, full, lengths[-1])
            left -= full * each
            rest = times - full
            if rest and 0 < left < each:
                put(pattern + (length,) * left, gap - left * length, 1, lengths[-1])
                left, rest = 0, rest - 1
            if pattern:
                put(pattern, gap, rest, lengths[-1])
    for group in open_bins.values():
        for pattern, times in group:
            done[pattern] += times
    return dict(done)


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Bins that any packing needs: for each size a, pieces over half a bin take one each, and what pieces
    of at least a (and at most half) exceed in the room left beside those too small to block them."""
    n = np.zeros(capacity + 1, np.int64)
    for length, times in counts.items():
        n[length] += times
    many, tokens = np.concatenate([[0], np.cumsum(n)]), np.concatenate([[0], np.cumsum(n * np.arange(capacity + 1))])
    half, best = capacity // 2, -(-int(tokens[-1]) // capacity)
    for a in range(half + 1):
        large = many[capacity + 1] - many[capacity - a + 1]
        middle, middle_tokens = many[capacity - a + 1] - many[half + 1], tokens[capacity - a + 1] - tokens[half + 1]
        excess = (tokens[half + 1] - tokens[a]) - (middle * capacity - middle_tokens)
        best = max(best, int(large + middle + max(0, -(-excess // capacity))))
    return best


def next_fit(counts: dict[int, int], capacity: int) -> dict[Pattern, int]:
    """A cheap start: next fit over the lengths in a mixed order, all pieces of a length at a time.

    New bins take pieces of one length up to half their room; one piece of the next length that fits goes into
    each bin that is open.  At most some two patterns a length come out.
    """
    done: dict[Pattern, int] = defaultdict(int)
    open_, times, gap = (), 0, 0
    for length in sorted((n for n in counts if counts[n] > 0), key=lambda n: (n * 0x9E3779B1 % 2**32, n)):
        left = counts[length]
        while left:
            if times and gap >= length:
                used = min(left, times)
                more = tuple(sorted((*open_, length), reverse=True))
                left, rest = left - used, times - used
                if rest > used:
                    done[more], times = done[more] + used, rest
                else:
                    done[open_] += rest
                    open_, times, gap = more, used, gap - length
                continue
            done[open_] += times
            each = max(1, capacity // 2 // length)
            if left < each:
                open_, times, left = (length,) * left, 1, 0
            else:
                open_, times, left = (length,) * each, left // each, left % each
            gap = capacity - sum(open_)
    done[open_] += times
    return {p: n for p, n in done.items() if p and n}


class _Bins:
    """Underfull bins by pattern, found by the room they have and by the lengths they hold; full ones apart."""

    def __init__(self, bins: dict[Pattern, int], capacity: int):
        self.capacity, self.count = capacity, {}
        self.gaps: list[int] = []
        self.by_gap: dict[int, dict[Pattern, None]] = defaultdict(dict)
        self.held: dict[int, list[int]] = defaultdict(list)  # of a length: the gaps of patterns that hold it
        self.holders: dict[tuple[int, int], dict[Pattern, None]] = defaultdict(dict)
        self.reach = np.zeros(capacity + 1, np.int64)  # of a length: the largest piece that can take its place
        self.heap: list[tuple[int, Pattern]] = []
        for pattern, n in sorted(bins.items()):
            self.add(pattern, n)

    def add(self, pattern: Pattern, n: int) -> None:
        if not pattern or not n:
            return
        known = pattern in self.count
        now = self.count[pattern] = self.count.get(pattern, 0) + n
        gap = self.capacity - sum(pattern)
        if not gap or known and now:
            return
        if not known:
            if not self.by_gap[gap]:
                insort(self.gaps, gap)
            self.by_gap[gap][pattern] = None
            for length in dict.fromkeys(pattern):
                if not self.holders[length, gap]:
                    insort(self.held[length], gap)
                    self.reach[length] = length + self.held[length][-1]
                self.holders[length, gap][pattern] = None
            heappush(self.heap, (-gap, pattern))
            return
        del self.count[pattern], self.by_gap[gap][pattern]
        if not self.by_gap[gap]:
            self.gaps.pop(bisect_left(self.gaps, gap))
        for length in dict.fromkeys(pattern):
            del self.holders[length, gap][pattern]
            if not self.holders[length, gap]:
                del self.holders[length, gap]
                gaps = self.held[length]
                gaps.pop(bisect_left(gaps, gap))
                self.reach[length] = length + gaps[-1] if gaps else 0

    def first(self, patterns, donor: Pattern):
        """A receiver: another pattern than the donor's, or a second bin of it."""
        return next((p for p in patterns if p != donor or self.count[p] > 1), None)

    def with_room(self, size: int, least_fill: int, donor: Pattern):
        """The fullest bin that a piece of ``size`` fits into."""
        for at in range(bisect_left(self.gaps, size), len(self.gaps)):
            if self.capacity - self.gaps[at] + size <= least_fill:
                return None
            if (found := self.first(self.by_gap[self.gaps[at]], donor)) is not None:
                return found
        return None

    def in_exchange(self, size: int, least_fill: int, donor: Pattern):
        """A bin and the smallest piece in it whose place pieces of ``size`` together can take."""
        for length in np.flatnonzero(self.reach[:size] >= size).tolist():
            gaps, gain = self.held[length], size - length
            for at in range(bisect_left(gaps, gain), len(gaps)):
                if self.capacity - gaps[at] + gain <= least_fill:
                    break
                if (found := self.first(self.holders[length, gaps[at]], donor)) is not None:
                    return found, length
        return None


def _pairs(pattern: Pattern) -> list[Pattern]:
    """Distinct pairs of pieces, the largest first; a bin holds few distinct lengths (63 of 2,048 at most)."""
    kinds = list(dict.fromkeys(pattern))
    twice = [(a, a) for a in kinds if pattern.count(a) > 1]
    return sorted([(a, b) for i, a in enumerate(kinds) for b in kinds[i + 1 :]] + twice, key=lambda p: (-sum(p), p))


def _without(pattern: Pattern, out: Pattern, into: Pattern) -> Pattern:
    items = list(pattern)
    for x in out:
        items.remove(x)
    return tuple(sorted([*items, *into], reverse=True))


def _exchange(bins: _Bins, donor: Pattern, pairs_of) -> tuple[Pattern, Pattern, Pattern] | None:
    """``receiver, out, back``: a move, or a one-for-one or two-for-one exchange, that raises the squared fill.

    With ``gain`` more tokens in the receiver the squared fill rises by
    ``2 * gain * (fill(receiver) - fill(donor) + gain)``.
    """
    fill, kinds = sum(donor), list(dict.fromkeys(donor))
    for x in kinds:
        if (found := bins.with_room(x, fill, donor)) is not None:
            return found, (x,), ()
    for x in kinds:
        if (hit := bins.in_exchange(x, fill, donor)) is not None:
            return hit[0], (x,), (hit[1],)
    for pair in pairs_of(donor):
        if (hit := bins.in_exchange(sum(pair), fill, donor)) is not None:
            return hit[0], pair, (hit[1],)
    for x in kinds:
        for gap in bins.gaps:
            for receiver in bins.by_gap[gap]:
                if receiver == donor and bins.count[donor] < 2:
                    continue
                for pair in pairs_of(receiver):
                    gain = x - sum(pair)
                    if gain > gap:
                        break
                    if gain > 0 and bins.capacity - gap + gain > fill:
                        return receiver, (x,), pair
    return None


def swap_search(bins: dict[Pattern, int], capacity: int) -> dict[Pattern, int]:
    """Exchange pieces between underfull bins while that raises the total squared fill; emptied bins go.

    The donor is always the emptiest bin that still has an exchange; each step serves as many bins as two
    patterns have in common.  It ends when ``lower_bound`` shows that no fewer bins can do, or when no donor has
    any exchange left: there is no limit of steps, receivers or pieces.  As each step raises the squared
    fill, it does end.
    """
    found, known = _Bins(bins, capacity), {}

    def pairs_of(pattern: Pattern) -> list[Pattern]:
        if pattern not in known:
            known[pattern] = _pairs(pattern)
        return known[pattern]

    counts: dict[int, int] = defaultdict(int)
    for pattern, n in bins.items():
        for length in pattern:
            counts[length] += n
    least, used = lower_bound(counts, capacity), sum(bins.values())
    stuck: set[Pattern] = set()
    moved = True
    while used > least:
        while found.heap and (found.heap[0][1] in stuck or found.heap[0][1] not in found.count):
            heappop(found.heap)
        if not found.heap:
            if not moved:
                break
            stuck, moved = set(), False  # what was stuck may have an exchange again
            found.heap = [(sum(p) - capacity, p) for p in found.count if sum(p) < capacity]
            heapify(found.heap)
            continue
        donor = found.heap[0][1]
        hit = _exchange(found, donor, pairs_of)
        if hit is None:
            stuck.add(donor)
            continue
        receiver, out, back = hit
        times = found.count[donor] // 2 if receiver == donor else min(found.count[donor], found.count[receiver])
        less, more = _without(donor, out, back), _without(receiver, back, out)
        for pattern, change in ((donor, -times), (receiver, -times), (less, times), (more, times)):
            found.add(pattern, change)
        used, moved = used - (0 if less else times), True
    return found.count


def fewest_bins(counts: dict[int, int], capacity: int, coarse: int = COARSE) -> dict[Pattern, int]:
    """Local search from a cheap packing, coarse to fine; where bins above the bound are left, from best fit, too.

    Of very many pieces the search first packs some ``coarse`` of them, each standing for an equal number,
    then what the division left over, and so on; exchanges among all bins end it.
    """
    left, bins = {length: n for length, n in counts.items() if n}, defaultdict(int)
    while (total := sum(left.values())) > coarse:
        each = -(-total // coarse)
        for pattern, n in swap_search(next_fit({length: n // each for length, n in left.items()}, capacity), capacity).items():
            bins[pattern] += n * each
        left = {length: n % each for length, n in left.items() if n % each}
    for pattern, n in next_fit(left, capacity).items():
        bins[pattern] += n
    best = swap_search(dict(bins), capacity)
    if sum(best.values()) > lower_bound(counts, capacity):
        other = swap_search(best_fit(counts, capacity), capacity)
        best = min(best, other, key=lambda b: sum(b.values()))
    return best


def placements(bins: dict[Pattern, int]) -> np.ndarray:
    """Rows (length, first rank, bins, pieces a bin, first sequence, offset): where ranks of a length go."""
    rows, taken, sequence = [], defaultdict(int), 0
    for pattern, times in sorted(bins.items(), reverse=True):
        offset, at = 0, 0
        while at < len(pattern):
            length, each = pattern[at], pattern.count(pattern[at])
            rows.append((length, taken[length], times, each, sequence, offset))
            taken[length] += times * each
            offset, at = offset + length * each, at + each
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 6)


_PIECES = pa.schema([(n, pa.int64()) for n in ("doc_id", "piece", "start", "length", "ids_crc32", "shard", "rank")])


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text", end_id: int = 0) -> DataFrame:
    """Encoded documents cut into pieces of at most ``capacity`` ids; only longer documents are cut.

    ``rank`` counts the pieces of one length within ``shard``, the task that made them.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, seen, shard = encoder(tokenizer).encode, np.zeros(capacity + 1, np.int64), TaskContext.get().partitionId()
        end = np.array([end_id], "<u4")
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part, rows = batch.slice(at, 256), []
                for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    ids = np.concatenate([encode(text), end])
                    for k, start in enumerate(range(0, len(ids), capacity)):
                        piece = ids[start : start + capacity]
                        rows.append((doc, k, start, len(piece), zlib.crc32(piece.tobytes()), shard, int(seen[len(piece)])))
                        seen[len(piece)] += 1
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], schema=_PIECES)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_column(text_col).alias("text"))
    return rows.mapInArrow(cut, ", ".join(f"{n} long" for n in _PIECES.names))


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text", end_id: int = 0) -> DataFrame:
    """One row a piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.

    Null text is the empty text: one piece of the end id.  Rows that repeat an id are packed each for
    itself; a null id stays null.  An empty table gives no rows.  Other columns are not read.

    The histogram of lengths (at most ``capacity`` rows) is all that comes to the driver, and the table of
    placements all that goes out to the tasks: one row a pattern and length, of which there are some ten
    thousand at any size of the corpus (``PLACEMENTS`` is checked).  A length
    that many documents share is no hot key: ranks are the task's own count plus its base, a prefix sum
    over tasks.
    """
    ship(docs.sparkSession)
    pieces = staged(token_pieces(docs, tokenizer, capacity, id_col, text_col, end_id), "pack-pieces")
    tallies = pieces.groupBy("length", "shard").agg(F.count(F.lit(1)).alias("n"))
    histogram = {r.length: r.n for r in tallies.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    table = placements(fewest_bins(histogram, capacity))
    if len(table) > PLACEMENTS:
        raise ValueError(f"{len(table)} placements are too many to send to every task")
    sent = docs.sparkSession.sparkContext.broadcast(table)
    before = Window.partitionBy("length").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = tallies.select(F.col("length").alias("_l"), F.col("shard").alias("_s"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = pieces.join(bases, (F.col("length") == F.col("_l")) & (F.col("shard") == F.col("_s")))
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("rank") + F.col("base")).alias("place"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = sent.value
        keys = table[:, 0] * (1 << 44) + table[:, 1]
        for batch in batches:
            length, rank = (batch.column(i).to_numpy(zero_copy_only=False) for i in (3, 5))
            row = table[np.searchsorted(keys, length * (1 << 44) + rank, "right") - 1]
            own = rank - row[:, 1]
            sequence, offset = row[:, 4] + own // row[:, 3], row[:, 5] + own % row[:, 3] * length
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence), pa.array(offset)], names=[*batch.schema.names[:5], "sequence_id", "offset"])

    return ranked.mapInArrow(place, "doc_id long, piece long, start long, length long, ids_crc32 long, sequence_id long, offset long").withColumn("piece", F.col("piece").cast("int"))
