"""Draws that depend on what was drawn before: over a handful of cohorts, not over rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.base import cut
from .sampling import draw_key


def cohort_pick(rows: DataFrame, key: str, cohorts: list[tuple[str, object, int]], seed: str) -> DataFrame:
    """``key, cohort``: for each cohort in order (name, condition, cap) the first rows by draw key not taken before.

    What an earlier cohort leaves of its cap goes to the next.  Each cohort is one ranked query over all rows;
    only its number of rows comes back.  Fails if the caps cannot be met in all.
    """
    chosen, spare = None, 0
    for name, condition, cap in cohorts:
        pool = rows.where(condition)
        pool = pool if chosen is None else pool.join(chosen.select(key), key, "left_anti")
        want = cap + spare
        drawn = cut(pool.select(key, F.lit(name).alias("cohort")).orderBy(draw_key(seed, F.col(key)), key).limit(want))
        spare = want - drawn.count()
        chosen = drawn if chosen is None else chosen.unionByName(drawn)
    if spare:
        raise ValueError(f"{spare} more rows are asked for than the cohorts hold")
    return chosen


def quota_draw(rows: DataFrame, key: str, cells: dict[str, dict[str, int]], floors: dict[str, int], total: int, seed: str, first: object = None, strict: bool = False) -> DataFrame:
    """``key, turn``: a greedy draw of ``total`` rows towards quotas in two columns, preferring flags below their floors.

    Rows of ``first`` (a condition) are taken to begin with, as turn 0.  Then each turn looks at the value with
    the largest deficit in either column (ties by name) and takes a row of both; if there is none, one of the
    first column's, then of the second's, then any.  Among these the row with the most flags counts whose
    number so far is below its floor, then the draw key.  The draw ends when a column has no deficit left.  With
    ``strict`` a draw that ends short of ``total``, of a quota or of a floor fails and says of which.

    The draw is sequential, but over kinds of rows: of each combination of values and flags, ``total`` rows by
    draw key are all that can ever be taken, and all that comes to the driver.  Values without a quota are one
    kind, so there are as many kinds as quotas and flags make, however many values the columns have.
    """
    a, b = cells
    flags = list(floors)
    listed = lambda c: F.when(F.col(c).isin(list(cells[c])), F.col(c))
    named = rows.select(F.col(key).alias("_key"), listed(a).alias("_a"), listed(b).alias("_b"), *[F.coalesce(F.col(f), F.lit(False)).alias(f"_f{i}") for i, f in enumerate(flags)], draw_key(seed, F.col(key)).alias("_draw"), F.coalesce(first if first is not None else F.lit(False), F.lit(False)).alias("_first"))
    kind = ["_a", "_b", *[f"_f{i}" for i in range(len(flags))]]
    given = named.where("_first")
    taken = {tuple(r[:-1]): r[-1] for r in given.groupBy(*kind).count().collect()}
    need = [dict(cells[a]), dict(cells[b])]
    covered = [0] * len(flags)
    for (x, y, *has), n in taken.items():
        for own, value in zip(need, (x, y), strict=True):
            own[value] = own.get(value, 0) - n
        covered = [c + n * h for c, h in zip(covered, has, strict=True)]
    own = Window.partitionBy(*kind).orderBy("_draw", "_key")
    pool = named.where(~F.col("_first")).withColumn("_n", F.row_number().over(own)).where(F.col("_n") <= total).collect()  # ``total`` rows a kind
    queues: dict[tuple, list] = {}
    for r in sorted(pool, key=lambda r: r["_n"]):
        queues.setdefault(tuple(r[k] for k in kind), []).append((r["_draw"], r["_key"]))
    chosen, left = [], total - sum(taken.values())
    while left > 0:
        wants = [sorted(((-v, k) for k, v in n.items() if v > 0), key=lambda p: (p[0], str(p[1]))) for n in need]
        if not all(wants):
            break
        x, y = wants[0][0][1], wants[1][0][1]
        open_ = [k for k, q in queues.items() if q]
        some = [k for k in open_ if k[0] == x and k[1] == y] or [k for k in open_ if k[0] == x] or [k for k in open_ if k[1] == y] or open_
        if not some:
            break
        worth = lambda k: sum(h and c < floors[f] for h, c, f in zip(k[2:], covered, flags, strict=True))
        best = min(some, key=lambda k: (-worth(k), *queues[k][0]))
        chosen.append((queues[best].pop(0)[1], len(chosen) + 1))
        left -= 1
        for n, value in zip(need, best[:2], strict=True):
            n[value] = n.get(value, 0) - 1
        covered = [c + h for c, h in zip(covered, best[2:], strict=True)]
    short = {"rows": left} | {f"{c} {k}": v for c, n in zip(cells, need, strict=True) for k, v in n.items() if k is not None} | {f: floors[f] - c for f, c in zip(flags, covered, strict=True)}
    if strict and any(v > 0 for v in short.values()):
        raise ValueError("the draw is short of " + ", ".join(f"{v} {k}" for k, v in short.items() if v > 0))
    drawn = rows.sparkSession.createDataFrame(chosen, f"_key {named.schema['_key'].dataType.simpleString()}, turn int")
    return given.select("_key", F.lit(0).alias("turn")).unionByName(drawn).withColumnRenamed("_key", key)


def same_word_elsewhere(rows: DataFrame, word: str, pos: str) -> DataFrame:
    """Rows whose word also occurs as another part of speech."""
    kinds = Window.partitionBy(word)
    return rows.withColumn("_a", F.min(pos).over(kinds)).withColumn("_z", F.max(pos).over(kinds)).where("_a <> _z").drop("_a", "_z")
