"""Seeded samples whose every choice is a hash, so any engine and any partitioning draws the same."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def draw_key(seed: str, key: Column) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def allocate(sizes: DataFrame, cell: str, size: str, total: int, floor: int = 2) -> DataFrame:
    """``cell, size, quota``: ``total`` slots over cells, each its floor first, the rest by largest remainder.

    Cells of at most ``floor`` are taken whole.  Where the floors alone exceed ``total`` the query fails.
    The windows run over cells, not over rows.
    """
    small = F.col(size) <= floor
    every = Window.partitionBy()
    told = sizes.select(F.col(cell), F.col(size), small.alias("_small"))
    told = told.withColumn("_left", total - F.sum(F.when(F.col("_small"), F.col(size)).otherwise(0)).over(every))
    told = told.withColumn("_mass", F.sum(F.when(~F.col("_small"), F.col(size)).otherwise(0)).over(every))
    exact = F.col(size) * F.col("_left") / F.nullif(F.col("_mass"), F.lit(0))
    base = F.when(F.col("_small"), F.col(size)).otherwise(F.greatest(F.lit(floor), F.floor(exact)))
    told = told.withColumns({"_base": base.cast("long"), "_frac": F.when(F.col("_small"), -1.0).otherwise(exact - F.floor(exact))})
    spare = total - F.sum("_base").over(every)
    turn = F.row_number().over(Window.orderBy(F.col("_frac").desc(), cell))
    told = told.withColumn("_spare", F.when(spare < 0, F.raise_error(F.lit("the floors exceed the total"))).otherwise(spare))
    quota = F.col("_base") + F.when(~F.col("_small") & (turn <= F.col("_spare")), 1).otherwise(0)
    return told.select(cell, size, F.least(quota, F.col(size)).cast("long").alias("quota"))


def stratified(rows: DataFrame, quotas: DataFrame, cell: str, key: str, seed: str, most: int) -> DataFrame:
    """The first ``quota`` rows of each cell in the order of their draw keys.

    ``most`` bounds every quota; with it Spark keeps only so many rows of a cell on each side of the shuffle.
    A quota above it fails.
    """
    own = Window.partitionBy(cell).orderBy(draw_key(seed, F.col(key)), key)
    told = rows.withColumn("_n", F.row_number().over(own)).where(F.col("_n") <= most)
    q = quotas.select(F.col(cell).alias("_c"), F.when(F.col("quota") > most, F.raise_error(F.lit("a quota is above the bound"))).otherwise(F.col("quota")).alias("quota"))
    return told.join(q, F.col(cell) == F.col("_c")).where(F.col("_n") <= F.col("quota")).drop("_n", "_c", "quota")


def without(rows: DataFrame, excluded: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not on an exclusion list (null keys stay)."""
    return rows.join(excluded.select(key).distinct(), key, "left_anti")


def overlap(sample: DataFrame, others: dict[str, DataFrame], key: str) -> DataFrame:
    """The sample with ``in_<name>`` for each other set of keys: whether it holds the row, too."""
    for name, other in others.items():
        marked = other.select(F.col(key).alias("_k")).distinct()
        sample = sample.join(marked, F.col(key) == F.col("_k"), "left").withColumn(f"in_{name}", F.col("_k").isNotNull()).drop("_k")
    return sample


def smoke_pick(rows: DataFrame, cell: str, order: str, most: int = 5) -> DataFrame:
    """The first row of each of the first ``most`` strata by name."""
    return one_per_stratum(rows, cell, order).orderBy(F.col(cell).asc_nulls_last()).limit(most)


def one_per_stratum(rows: DataFrame, cell: str, order: str) -> DataFrame:
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(cell).orderBy(order))).where("_n = 1").drop("_n")


def side_of_a(seed: str, key: Column) -> Column:
    """Which of two arms is shown as A: one fair bit of the draw key."""
    odd = F.conv(F.substring(draw_key(seed, key), 1, 1), 16, 10).cast("int") % 2 == 1
    return F.when(odd, "candidate").otherwise("legacy")


def proportional(sizes: DataFrame, cell: str, size: str, total: int) -> DataFrame:
    """``cell, size, quota``: shares of ``total`` by size, cut to whole rows, the rest one each by largest fraction.

    Fractions that are equal go by the larger cell name; a cell never has more than its size.  Windows run over cells.
    """
    every = Window.partitionBy()
    exact = F.lit(total).cast("double") * F.col(size) / F.sum(size).over(every)
    told = sizes.select(cell, size, F.least(F.floor(exact), F.col(size)).cast("long").alias("_base"), exact.alias("_exact"))
    told = told.withColumn("_left", F.least(F.lit(total).cast("long"), F.sum(size).over(every)) - F.sum("_base").over(every))
    open_ = F.when(F.col("_base") < F.col(size), F.col("_exact") - F.col("_base"))
    turn = F.row_number().over(Window.orderBy(open_.desc_nulls_last(), F.col(cell).desc()))
    return told.select(cell, size, (F.col("_base") + F.when(open_.isNotNull() & (turn <= F.col("_left")), 1).otherwise(0)).cast("long").alias("quota"))


def swapped_in(chosen: DataFrame, pool: DataFrame, key: str, wanted: dict[str, int], seed: str) -> DataFrame:
    """``key`` of a sample in which rows without any wanted flag gave way to rows with one.

    ``pool`` holds all rows with the flags as boolean columns.  Flag by flag, in order, as many rows come in as the
    sample lacks of it, if there are so many and so many without a flag are left to go; both by draw key.
    """
    flags = list(wanted)
    held = pool.select(F.col(key).alias("_key"), *[F.coalesce(F.col(f), F.lit(False)).alias(f) for f in flags])
    marked = held.join(chosen.select(F.col(key).alias("_c")), F.col("_key") == F.col("_c"), "left").withColumn("_in", F.col("_c").isNotNull()).drop("_c")
    most = sum(wanted.values())
    order = draw_key(seed, F.col("_key"))
    have = marked.where("_in").agg(*[F.count_if(F.col(f)).alias(f) for f in flags]).first()
    plain = ~F.greatest(*[F.col(f) for f in flags]) if len(flags) > 1 else ~F.col(flags[0])
    goers = [r[0] for r in marked.where(F.col("_in") & plain).orderBy(order, "_key").limit(most).select("_key").collect()]  # as many as are wanted
    came, went, counts = [], [], {f: have[f] for f in flags}
    for f in flags:
        if counts[f] >= wanted[f]:
            continue
        some = marked.where(~F.col("_in") & F.col(f)).orderBy(order, "_key").limit(most).collect()  # as many as are wanted
        for r in some:
            if counts[f] >= wanted[f] or not goers:
                break
            if r["_key"] in came:
                continue
            came.append(r["_key"])
            went.append(goers.pop(0))
            for other in flags:
                counts[other] += bool(r[other])
    kind = held.schema["_key"].dataType.simpleString()
    swap = chosen.sparkSession.createDataFrame([(k,) for k in came], f"{key} {kind}")
    gone = chosen.sparkSession.createDataFrame([(k,) for k in went], f"{key} {kind}")
    return chosen.select(key).join(F.broadcast(gone), key, "left_anti").unionByName(swap)  # as many as are wanted


def sampling_features(rows: DataFrame, word: str, pos: str, lists: list[str], separators: str, few: int = 5) -> DataFrame:
    """Rows with what a draw looks at (C12): ``pos_group, multi_pos, translations_multi, relations_total, relations_poor,
    mnemonic_null, definition_len``; ``lists`` are array columns, ``translations, mnemonic, definition`` texts."""
    from ..functions.text import norm, pos_group
    from ..functions.values import has_content

    own = rows.withColumn("_w", F.lower(F.trim(word))).withColumn("_p", F.lower(F.trim(F.coalesce(pos, F.lit("")))))
    kinds = own.groupBy(F.col("_w").alias("_g")).agg(F.min("_p").alias("_lo"), F.max("_p").alias("_hi"))
    total = sum((F.size(F.filter(F.coalesce(F.col(c), F.array().cast("array<string>")), lambda x: F.coalesce(F.trim(x) != "", F.lit(False)))) for c in lists), F.lit(0))
    told = own.join(kinds, F.col("_w") == F.col("_g"), "left")
    return told.select(
        *rows.columns,
        pos_group(F.col("_p")).alias("pos_group"),
        F.coalesce(F.col("_lo") != F.col("_hi"), F.lit(False)).alias("multi_pos"),
        F.coalesce(F.col("translations").rlike(f"[{separators}]"), F.lit(False)).alias("translations_multi"),
        total.alias("relations_total"),
        (total <= few).alias("relations_poor"),
        (~has_content("mnemonic", F.col("mnemonic"))).alias("mnemonic_null"),
        F.coalesce(F.char_length("definition"), F.lit(0)).alias("definition_len"),
        F.coalesce(norm(F.col("definition")) != "", F.lit(False)).alias("definition_held"),
    )


def eligibility(verdicts: Column, sources: Column, multi_pos: Column, emptied: Column, criticals: Column, indirect: Column) -> Column:
    """Tags of a card in each of six strata that it is eligible for (C11), as a map; strata without tags are absent.

    ``verdicts`` by field, ``sources`` (what became of each field), whether relations were ``emptied``, an error in
    examples was marked (``criticals``) and the mnemonic leaves its word out (``indirect``).
    """
    v, s = (lambda f: F.try_element_at(verdicts, F.lit(f))), (lambda f: F.try_element_at(sources, F.lit(f)))
    tags = lambda *pairs: F.filter(F.array(*[F.when(F.coalesce(c, F.lit(False)), t if not isinstance(t, str) else F.lit(t)) for c, t in pairs]), lambda x: x.isNotNull())
    judged = lambda f: v(f).isin("candidate", "legacy", "tie")
    relations = ("synonyms", "antonyms", "collocations")
    kept = s("synonyms") == "legacy_preserved"
    for r in relations[1:]:
        kept = F.coalesce(kept, F.lit(False)) | F.coalesce(s(r) == "legacy_preserved", F.lit(False))
    meaning = judged("definition") & (F.coalesce(s("definition_en") == "llm_changed", F.lit(False)) | F.coalesce(s("explanation_ar") == "llm_changed", F.lit(False)))
    made = s("mnemonic").isin("llm_changed", "null")
    strata = {
        "translations": tags((judged("translations"), v("translations")), (judged("translations") & (s("translations") == "llm_changed"), "changed"), (judged("translations") & (s("translations") == "legacy_preserved"), "preserved")),
        "relations": tags((emptied, "emptied"), (kept, "legacy_preserved"), (v("relations") == "candidate", "candidate")),
        "sense_separation": tags((v("sense_separation") == "cannot-judge", "abstain"), (multi_pos, "multi_pos")),
        "examples": tags((v("examples").isNotNull(), v("examples")), (v("examples").isNotNull() & criticals, "critical_related")),
        "definition_arabic": tags((meaning, "semantic_change"), (meaning, v("definition"))),
        "mnemonic": tags((made, s("mnemonic")), (made & indirect, "indirect")),
    }
    every = F.create_map(*[x for name, t in strata.items() for x in (F.lit(name), t)])
    return F.map_filter(every, lambda k, t: F.size(t) > 0)
