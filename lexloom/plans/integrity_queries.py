"""Queries over versions that survive, deletions that cascade, and records replaced as a unit."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import commits, integrity, protocol
from ..operators.integrity import Reference
from .base import scratch, table
from .queries import query

# ---- versions


@query("""SELECT p_partkey, CASE WHEN p_partkey % 5 = 1 THEN 'Brand#Z' ELSE p_brand END AS p_brand, CASE WHEN p_partkey % 7 = 2 THEN 'NEW' ELSE p_type END AS p_type, 4 AS version, 3 AS parent FROM part""")
def migration_after_rollback(spark, sf):
    """A migration is made, taken back, made otherwise and followed by another; what is in force is the last."""
    p = table(spark, sf, "part").select("p_partkey", "p_brand", "p_type")
    i, root = F.col("p_partkey"), scratch(spark, "parts-store")
    commits.write(first := commits.begin(spark, root), p)
    commits.commit(spark, first)
    brand = lambda rest, after: p.where(i % 5 == rest).select("p_partkey", F.lit("p_brand").alias("field"), F.col("p_brand").alias("before"), F.lit(after).alias("after"))
    kinds = p.where(i % 7 == 2).select("p_partkey", F.lit("p_type").alias("field"), F.col("p_type").alias("before"), F.lit("NEW").alias("after"))
    for changes, back in ((brand(0, "Brand#Y"), True), (brand(1, "Brand#Z"), False), (kinds, False)):
        protocol.execute(spark, root, changes, "p_partkey", ["p_brand", "p_type"], changes.count(), ["p_partkey"], rows=p.count())
        if back:
            protocol.take_back(spark, root)
    now = protocol.current_version(spark, root)
    return protocol.read_version(spark, root).select("p_partkey", "p_brand", "p_type", F.lit(now).alias("version"), F.lit(commits.parent_of(spark, root, now)).alias("parent"))


# ---- deletions

_REFERENCES = [
    Reference("customer", "c_parent", "customer", "c_custkey"),
    Reference("orders", "o_custkey", "customer", "c_custkey"),
    Reference("lineitem", "l_orderkey", "orders", "o_orderkey"),
]
_KEYS = {"customer": "c_custkey", "orders": "o_orderkey", "lineitem": "l_id"}


def _shop(spark, sf):
    """Customers under customers, their orders, and the lines of these."""
    t = lambda n: table(spark, sf, n)
    above = F.expr("CASE WHEN c_custkey % 2 = 1 THEN c_custkey DIV 3 END")
    lines = t("lineitem").select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("l_id"), "l_orderkey", "l_quantity")
    return {"customer": t("customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal", above.alias("c_parent")), "orders": t("orders"), "lineitem": lines}


_GONE_SQL = """WITH RECURSIVE c AS (
  SELECT c_custkey FROM customer WHERE c_custkey % 50 = 7
  UNION SELECT x.c_custkey FROM customer x JOIN c ON x.c_custkey % 2 = 1 AND x.c_custkey // 3 = c.c_custkey),
o AS (SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM c)),
l AS (SELECT DISTINCT l_orderkey * 8 + l_linenumber AS l_id FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM o))"""


def _deleted(spark, sf):
    shop = _shop(spark, sf)
    return shop, integrity.delete(shop, _KEYS, _REFERENCES, {"customer": shop["customer"].where("c_custkey % 50 = 7").select("c_custkey")})


@query(_GONE_SQL + " SELECT 'customer' AS tab, c_custkey AS id FROM c UNION ALL SELECT 'orders', o_orderkey FROM o UNION ALL SELECT 'lineitem', l_id FROM l")
def cascaded_deletion(spark, sf):
    gone = _deleted(spark, sf)[1].gone
    told = [rows.select(F.lit(name).alias("tab"), F.col("_id").alias("id")) for name, rows in gone.items()]
    return told[0].union(told[1]).union(told[2])


@query(_GONE_SQL + """ SELECT 'customer' AS tab, count(*) AS n, sum(c_custkey)::BIGINT AS keys FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM c)
UNION ALL SELECT 'orders', count(*), sum(o_orderkey)::BIGINT FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM o)
UNION ALL SELECT 'lineitem', count(*), sum(l_orderkey * 8 + l_linenumber)::BIGINT FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM o)""")
def kept_after_deletion(spark, sf):
    kept = _deleted(spark, sf)[1].kept
    told = [rows.agg(F.count(F.lit(1)).alias("n"), F.sum(_KEYS[name]).alias("keys")).select(F.lit(name).alias("tab"), "n", "keys") for name, rows in kept.items()]
    return told[0].union(told[1]).union(told[2])


@query("""WITH n AS (SELECT n_nationkey FROM nation WHERE n_regionkey = 2)
SELECT 'blocked' AS kind, 'customer' AS tab, (SELECT count(*) FROM customer WHERE c_nationkey IN (SELECT n_nationkey FROM n)) AS n
UNION ALL SELECT 'nulled', 'supplier', (SELECT count(*) FROM supplier WHERE s_nationkey IN (SELECT n_nationkey FROM n))""")
def blocked_deletion(spark, sf):
    names = {"region": "r_regionkey", "nation": "n_nationkey", "customer": "c_custkey", "supplier": "s_suppkey"}
    tables = {n: table(spark, sf, n) for n in names}
    rules = [Reference("nation", "n_regionkey", "region", "r_regionkey"), Reference("customer", "c_nationkey", "nation", "n_nationkey", "restrict"), Reference("supplier", "s_nationkey", "nation", "n_nationkey", "set_null")]
    told = integrity.delete(tables, names, rules, {"region": tables["region"].where("r_regionkey = 2").select("r_regionkey")}, strict=False)
    blocked = told.blocked.select(F.lit("blocked").alias("kind"), F.col("child").alias("tab"), "n")
    nulled = told.kept["supplier"].where("s_nationkey is null").agg(F.count(F.lit(1)).alias("n")).select(F.lit("nulled").alias("kind"), F.lit("supplier").alias("tab"), "n")
    return blocked.union(nulled)


# ---- records replaced as one unit

_REPLACED_SQL = """WITH u AS (SELECT c_custkey, c_acctbal FROM customer WHERE c_custkey % 10 = 4),
top AS (SELECT max(o_orderkey) AS k FROM orders),
n AS (SELECT k + row_number() OVER (ORDER BY c_custkey, j) AS id, c_custkey, j FROM u, (VALUES (1), (2)) x(j), top),
gone AS (SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM u)),
v AS (SELECT o_orderkey + 5 AS id, o_orderkey AS entity_id, CASE WHEN o_orderkey IN (SELECT o_orderkey FROM gone) AND o_orderkey % 2 = 0 THEN 'superseded' WHEN o_orderkey % 2 = 0 THEN 'current' ELSE 'old' END AS status FROM orders
  UNION ALL SELECT (SELECT k + 5 FROM top) + row_number() OVER (ORDER BY id), id, 'current' FROM n)
SELECT 'customer' AS tab, c_custkey AS id, CASE WHEN c_custkey % 10 = 4 THEN 'RENEWED' ELSE c_mktsegment END AS what FROM customer
UNION ALL SELECT 'orders', o_orderkey, o_custkey::VARCHAR FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM gone)
UNION ALL SELECT 'orders', id, c_custkey::VARCHAR FROM n
UNION ALL SELECT 'lineitem', l_orderkey * 8 + l_linenumber, count(*)::VARCHAR FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM gone) GROUP BY 2
UNION ALL SELECT 'versions', id, entity_id || ' ' || status FROM v"""


@query(_REPLACED_SQL)
def replaced_records(spark, sf):
    """Some customers are renewed: their orders are replaced, lines go along, versions are noted, all in one commit."""
    shop = _shop(spark, sf)
    k = F.col("o_orderkey")
    shop["versions"] = shop["orders"].select((k + 5).alias("id"), F.lit("orders").alias("entity"), k.alias("entity_id"), F.lit("{}").alias("value"), F.when(k % 2 == 0, "current").otherwise("old").alias("status"))
    root = scratch(spark, "shop-store")
    draft = commits.begin(spark, root)
    for name, rows in shop.items():
        commits.write(draft, rows, name)
    commits.commit(spark, draft, sorted(shop))

    def change(held):
        chosen = held["customer"].where("c_custkey % 10 = 4")
        new = chosen.select(F.col("c_custkey").alias("o_custkey"), F.lit("N").alias("o_orderstatus"), F.explode(F.array(F.lit(1.0), F.lit(2.0))).alias("o_totalprice"), F.lit(None).cast("timestamp").alias("o_orderdate"), F.lit("new").alias("o_orderpriority"))
        updates = chosen.select("c_custkey", F.lit("RENEWED").alias("c_mktsegment"))
        return integrity.replaced(held, _KEYS | {"versions": "id"}, _REFERENCES, "customer", updates, {"orders": new}, {"orders": [F.col("o_custkey"), F.col("o_totalprice")]}, "versions")

    integrity.replace_in_store(spark, root, list(shop), change)
    now = {n: commits.read(spark, root, n) for n in shop}
    told = [
        now["customer"].select(F.lit("customer").alias("tab"), F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("what")),
        now["orders"].select(F.lit("orders"), k, F.col("o_custkey").cast("string")),
        now["lineitem"].groupBy("l_id").agg(F.count(F.lit(1)).cast("string").alias("n")).select(F.lit("lineitem"), "l_id", "n"),
        now["versions"].select(F.lit("versions"), "id", F.concat_ws(" ", F.col("entity_id").cast("string"), "status")),
    ]
    return told[0].union(told[1]).union(told[2]).union(told[3])
