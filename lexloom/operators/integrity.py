"""Foreign keys at work: deletions carried down a graph of tables, and records replaced as one unit (V2, K5)."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.base import cut, stored
from . import commits
from .ranking import global_position


@dataclass(frozen=True)
class Reference:
    """``child.column`` refers to ``parent.key``; on deletion of a parent its children go (``cascade``), lose the
    reference (``set_null``) or forbid it (``restrict``).  A null refers to nothing."""

    child: str
    column: str
    parent: str
    key: str
    on_delete: str = "cascade"

    def __post_init__(self):
        if self.on_delete not in ("cascade", "set_null", "restrict"):
            raise ValueError(f"unknown rule: {self.on_delete}")


def waves(tables: list[str], references: list[Reference]) -> list[list[str]]:
    """Groups of tables, parents before children; tables whose cascades lead back to each other share a group."""
    below = {t: {r.child for r in references if r.parent == t and r.on_delete == "cascade"} for t in tables}
    reach = {t: set(below[t]) for t in tables}
    for via in tables:
        for t in tables:
            if via in reach[t]:
                reach[t] |= reach[via]
    groups: list[list[str]] = []
    left = list(tables)
    while left:
        ready = [t for t in left if not any(t in reach[o] and o not in reach[t] for o in left)]
        first = ready[0]
        group = [t for t in left if t == first or (t in reach[first] and first in reach[t])]
        groups.append(group)
        left = [t for t in left if t not in group]
    return groups


def _ids(rows: DataFrame, key: str) -> DataFrame:
    return rows.select(F.col(key).alias("_id")).where("_id is not null").distinct()


def doomed_keys(tables: dict[str, DataFrame], keys: dict[str, str], references: list[Reference], roots: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """``_id`` of every row that goes, by table: the keys in ``roots`` (a column each) and all that cascades reach from them.

    Tables come parents first, each found by semi-joins with the keys already lost above it.  Where references lead
    back, within a table or around several, rounds follow only what the last one added, until nothing is added; each
    round is written to the shared folder, so that plans stay as small as the first.  Keys that no row has are ignored.
    """
    found: dict[str, DataFrame] = {}
    for group in waves(list(tables), references):
        inner = [r for r in references if r.on_delete == "cascade" and r.child in group and r.parent in group]
        start = {}
        for t in group:
            own = F.col(keys[t])
            parts = []
            if t in roots:
                parts.append(tables[t].join(roots[t].select(F.col(roots[t].columns[0]).alias("_g")), own == F.col("_g"), "left_semi"))
            for r in references:
                if r.on_delete == "cascade" and r.child == t and r.parent not in group and r.parent in found:
                    gone = _referred(tables[r.parent], keys[r.parent], found[r.parent], r.key)
                    parts.append(tables[t].join(gone, F.col(r.column) == F.col("_ref"), "left_semi"))
            empty = tables[t].select(own.alias("_id")).where("false")
            start[t] = reduce(DataFrame.union, [_ids(p, keys[t]) for p in parts], empty).distinct()
        if not inner:
            found |= {t: stored(start[t]) for t in group}
            continue
        seen = {t: stored(start[t]) for t in group}
        fresh = dict(seen)
        while any(not f.isEmpty() for f in fresh.values()):
            after = {}
            for t in group:
                parts = [_ids(tables[t].join(_referred(tables[r.parent], keys[r.parent], fresh[r.parent], r.key), F.col(r.column) == F.col("_ref"), "left_semi"), keys[t]) for r in inner if r.child == t]
                reached = reduce(DataFrame.union, parts, seen[t].where("false")).distinct()
                after[t] = stored(reached.join(seen[t], "_id", "left_anti"))
            seen = {t: stored(seen[t].union(after[t])) for t in group}
            fresh = after
        found |= seen
    return found


def _referred(parent: DataFrame, key: str, ids: DataFrame, column: str) -> DataFrame:
    """``_ref``: what references to those rows hold, which need not be their key."""
    if column == key:
        return ids.select(F.col("_id").alias("_ref"))
    return parent.join(ids, F.col(key) == F.col("_id"), "left_semi").select(F.col(column).alias("_ref"))


@dataclass
class Deletion:
    """``kept`` tables, ``gone`` keys by table, and ``blocked``: ``child, column, n`` of what forbids the deletion."""

    kept: dict[str, DataFrame]
    gone: dict[str, DataFrame]
    blocked: DataFrame | None


def delete(tables: dict[str, DataFrame], keys: dict[str, str], references: list[Reference], roots: dict[str, DataFrame], strict: bool = True) -> Deletion:
    """Delete rows and what depends on them, all or nothing.

    Fails if a row that stays refers to one that goes by a ``restrict`` reference; with ``strict`` off, ``blocked`` tells
    of them and ``kept`` is what would be.  References that ``set_null`` become null in the rows that stay.
    Columns and rows without relation to the deletion stay as they are, repeated rows and null keys included.
    """
    gone = doomed_keys(tables, keys, references, roots)
    kept = {t: rows.join(gone[t], F.col(keys[t]) == F.col("_id"), "left_anti") for t, rows in tables.items()}
    blocks = []
    for r in references:
        if r.on_delete == "cascade":
            continue
        refs = _referred(tables[r.parent], keys[r.parent], gone[r.parent], r.key).distinct()
        if r.on_delete == "restrict":
            held = kept[r.child].join(refs, F.col(r.column) == F.col("_ref"), "left_semi")
            blocks.append(held.agg(F.count(F.lit(1)).alias("n")).select(F.lit(r.child).alias("child"), F.lit(r.column).alias("column"), "n").where("n > 0"))
        else:
            columns = kept[r.child].columns
            marked = kept[r.child].join(refs, F.col(r.column) == F.col("_ref"), "left")
            kept[r.child] = marked.withColumn(r.column, F.when(F.col("_ref").isNull(), F.col(r.column))).select(*columns)
    blocked = reduce(DataFrame.unionByName, blocks) if blocks else None
    if strict and blocked is not None and (told := blocked.collect()):  # at most one row a reference
        raise ValueError("not deleted: " + ", ".join(f"{x.n} rows of {x.child} by {x.column}" for x in told))
    return Deletion(kept, gone, blocked)


def numbered_after(rows: DataFrame, held: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """New rows with keys that follow the largest one held, in ``order``."""
    top = held.agg(F.coalesce(F.max(F.col(key).cast("long")), F.lit(0))).first()[0]
    return global_position(rows, order, key).withColumn(key, F.col(key) + top)


def replaced(tables: dict[str, DataFrame], keys: dict[str, str], references: list[Reference], parent: str, updates: DataFrame, children: dict[str, DataFrame], order: dict[str, list[Column]], versions: str | None = None, entity: str = "") -> dict[str, DataFrame]:
    """The tables after parents were updated, their children replaced and versions of the new children noted (K5).

    ``updates`` has the parent's key and the columns that change.  ``children`` holds the new rows of tables that refer
    to the parent, without keys of their own: they get keys after the largest held, by ``order``.  What the parents had
    in these tables goes, with all that cascades from it; parents whose children are not given lose them.  ``versions``
    names a table of ``id, entity, entity_id, value, status``: each new child's JSON is noted there as ``current``, and
    what was current of the children that went becomes ``superseded``.  An update of a parent that is not there fails.
    """
    key = keys[parent]
    unknown = updates.join(tables[parent].select(F.col(key).alias("_k")), F.col(key) == F.col("_k"), "left_anti").limit(1).count()
    if unknown:
        raise ValueError(f"an update is of no row of {parent}")
    direct = {r.child: r.column for r in references if r.parent == parent and r.child in children}
    roots = {}
    for name, column in direct.items():
        roots[name] = tables[name].join(updates.select(F.col(key).alias("_p")), F.col(column) == F.col("_p"), "left_semi").select(keys[name])
    below = [r for r in references if r.parent != parent or r.child in direct]
    after = delete({t: df for t, df in tables.items() if t not in (parent, versions)}, keys, [r for r in below if r.parent != parent and versions not in (r.child, r.parent)], roots)
    out = dict(tables) | after.kept
    new = updates.select(F.col(key).alias("_k"), *[F.col(c).alias(f"_new_{c}") for c in updates.columns if c != key])
    told = tables[parent].join(new, F.col(key) == F.col("_k"), "left")
    out[parent] = told.select(*[F.when(F.col("_k").isNotNull(), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in updates.columns and c != key else F.col(c) for c in tables[parent].columns])
    noted = []
    for name in direct:
        rows = numbered_after(children[name], tables[name], keys[name], order[name])
        rows = cut(rows.select(*[F.col(c).cast(tables[name].schema[c].dataType).alias(c) for c in tables[name].columns]))
        out[name] = after.kept[name].unionByName(rows)
        if versions:
            noted.append(rows.select(F.lit(name).alias("entity"), F.col(keys[name]).cast("long").alias("entity_id"), F.to_json(F.struct(*sorted(rows.columns)), {"ignoreNullFields": "false"}).alias("value"), F.lit("current").alias("status")))
    if versions:
        lost = reduce(DataFrame.unionByName, [after.gone[n].select(F.lit(n).alias("_e"), F.col("_id").cast("long").alias("_i")) for n in direct])
        held = tables[versions].join(lost, (F.col("entity") == F.col("_e")) & (F.col("entity_id") == F.col("_i")), "left")
        held = held.withColumn("status", F.when(F.col("_i").isNotNull() & (F.col("status") == "current"), "superseded").otherwise(F.col("status"))).select(*tables[versions].columns)
        more = numbered_after(reduce(DataFrame.unionByName, noted), tables[versions], keys[versions], [F.col("entity"), F.col("entity_id")])
        out[versions] = held.unionByName(more.select(*tables[versions].columns))
    return out


def replace_in_store(spark, root: str, names: list[str], change) -> int:
    """Read tables of a store, change them, and put all that changed in force at once; gives the version.

    ``change`` takes the tables by name and gives those to write.  A crash before the last step leaves everything as it
    was, and ``commits.Conflict`` tells that another writer was first.
    """
    draft = commits.begin(spark, root)
    held = {n: commits.read(spark, root, n) for n in names}
    wanted = change(held)
    for name, rows in wanted.items():
        commits.write(draft, rows, name)
    return commits.commit(spark, draft, sorted(wanted))
