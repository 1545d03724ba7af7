"""What the trained operators share: held-out rows and bounded samples of labelled rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(id_col: str) -> Column:
    """crc32 of the id as text is a multiple of 5; a null id is never held out."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def bounded_sample(rows: DataFrame, id_col: str, most: int) -> DataFrame:
    """About ``most`` rows at most, by a hash of the id: all of them if there are no more.

    Only for fitting a classifier; the same rows on every run.
    """
    n = rows.count()
    if n <= most:
        return rows
    share = int(most / n * 2**40)
    return rows.where(F.pmod(F.xxhash64(F.lit("sample"), F.col(id_col).cast("string")), F.lit(2**40)) < share)


def bounded_by_class(rows: DataFrame, id_col: str, class_col: str, sizes: dict, most: int) -> DataFrame:
    """About ``most`` rows at most, of each class an equal part, or all it has; by a hash of the id.

    ``sizes`` gives the rows of each class; only for fitting a classifier.
    """
    if sum(sizes.values()) <= most:
        return rows
    left, open_, taken = most, len(sizes), {}
    for name, n in sorted(sizes.items(), key=lambda kv: (kv[1], kv[0])):  # what rare classes leave goes to the others
        taken[name] = min(n, left // open_)
        left, open_ = left - taken[name], open_ - 1
    share = F.create_map(*[F.lit(v) for name, n in sizes.items() for v in (name, -(-taken[name] * 2**40 // n))])
    return rows.where(F.pmod(F.xxhash64(F.lit("sample"), F.col(id_col).cast("string")), F.lit(2**40)) < F.try_element_at(share, F.col(class_col)))
