"""The queries ``opN_<name>``: each operator with production parameters over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, collocations, exact_dedup, language, licenses, media, mixing, packing, pieces, simhash, spelling, suffix_dedup, token_files, toxicity


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_media_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.media_round_trip(_documents(spark, sf_dir))


def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_documents(spark, sf_dir))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.read_token_files(spark, token_files.write_token_files(_documents(spark, sf_dir), bpe.public_path("byte_bpe_50k.json")))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_documents(spark, sf_dir), windows=True)


def op5_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(_documents(spark, sf_dir))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(_documents(spark, sf_dir))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_documents(spark, sf_dir), bpe.public_path("word_bpe_49k.json"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup_report(_documents(spark, sf_dir), keep="max")


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(_documents(spark, sf_dir))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_documents(spark, sf_dir))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(_documents(spark, sf_dir))


def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.round_trip(_documents(spark, sf_dir), bpe.public_path("piece_bpe_32k.model"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_media_round_trip,
        op2_source_mix,
        op3_token_files,
        op4_license_scan,
        op5_simhash_groups,
        op6_toxicity,
        op7_suffix_dedup,
        op8_best_fit_packing,
        op9_exact_dedup,
        op10_language,
        op11_collocations,
        op12_spelling_variants,
        op13_sentencepiece,
    )
}

ORACLE_SQL: dict[str, str] = {
    "op2_source_mix": r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5('mix:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))) AS k
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS n FROM d GROUP BY source),
w AS (SELECT source, source_size, ((n - 1) % 3 + 1)::DOUBLE AS w, 3.0::DOUBLE * source_size AS lim FROM s),
l AS (SELECT a.lim / a.w AS r,
             (sum(CASE WHEN b.lim / b.w >= a.lim / a.w THEN b.w ELSE 0 END)) AS open_w,
             (SELECT sum(source_size) FROM w)::DOUBLE - sum(CASE WHEN b.lim / b.w < a.lim / a.w THEN b.lim ELSE 0 END) AS open_t
      FROM w a, w b GROUP BY a.source, a.lim, a.w),
lev AS (SELECT min_by(open_t / open_w, r) AS level FROM l WHERE open_t / open_w <= r),
t AS (SELECT source, source_size, least(lim, w * level) AS target, floor(least(lim, w * level) + 0.5)::BIGINT AS budget FROM w, lev),
p AS (SELECT d.*, t.source_size, t.target, t.budget,
             coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY k, doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before,
             CASE WHEN t.source_size > 0 THEN t.budget // t.source_size ELSE 0 END AS whole
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (whole * size + least(size, greatest(0, budget - whole * source_size - before)))::BIGINT AS taken
FROM p
""",
    "op4_license_scan": licenses.oracle_sql(),
    "op9_exact_dedup": """
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM d JOIN g USING (t)
""",
    "op11_collocations": collocations.ORACLE_SQL,
    "op12_spelling_variants": spelling.ORACLE_SQL,
}
