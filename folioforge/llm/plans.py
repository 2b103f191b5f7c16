"""Registered queries of this folder and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.llm import (
    decontamination,
    language,
    line_windows,
    mixing,
    near_duplicates,
    oracles,
    passage_repeats,
    preferences,
    prefix_trie,
    quality_rules,
    repeated_bytes,
    sharding,
    site_trees,
    structure_repair,
)
from folioforge.llm.common import load
from folioforge.session import materialize

LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
LLM_ORACLES: dict[str, str] = {}


def query(function):
    LLM_QUERIES[function.__name__] = function
    return function


@query
def op1_ring_shards(spark: SparkSession, folder: str) -> DataFrame:
    docs = load(spark, folder, "documents").select("doc_id", "text")
    placed = sharding.shard_rows(
        spark,
        docs.withColumns({"size": sharding.size_of(F.col("text")), "text_crc32": F.crc32("text")}),
        shards=8,
    )
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

LLM_ORACLES["op5_preference_pairs"] = """WITH c AS (
    SELECT conv_id AS pair_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL),
  ends AS (SELECT pair_id, max(turn) AS turn FROM c WHERE role = 'assistant' GROUP BY pair_id),
  replies AS (SELECT pair_id, turn AS last, max(text) AS reply FROM c JOIN ends USING (pair_id, turn)
    WHERE role = 'assistant' GROUP BY ALL),
  pairs AS (SELECT a.pair_id, a.last, b.reply AS other FROM replies a
    JOIN replies b ON b.pair_id = a.pair_id + CASE a.pair_id % 2 WHEN 0 THEN 1 ELSE -1 END),
  t AS (SELECT pair_id, 0 AS side, turn, role, text FROM c JOIN pairs USING (pair_id) WHERE turn IS NULL OR turn <= last
    UNION ALL SELECT pair_id, 1, turn, role, text FROM c JOIN pairs USING (pair_id) WHERE turn IS NULL OR turn < last
    UNION ALL SELECT pair_id, 1, last, 'assistant', other FROM pairs),
  places AS (SELECT pair_id, turn, count(*) = 2 AND count(DISTINCT side) = 2 AND min(role) = max(role)
      AND min(text) = max(text) AS same FROM t GROUP BY ALL),
  splits AS (SELECT pair_id, min(turn) FILTER (WHERE NOT same) AS split FROM places GROUP BY pair_id),
  parts AS (SELECT t.*, split IS NULL OR turn < split AS shared,
      '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) AS segment FROM t JOIN splits USING (pair_id))
  SELECT pair_id, CASE WHEN shared THEN 'prompt' WHEN side = 0 THEN 'chosen' ELSE 'rejected' END AS part, turn, role,
    segment, NOT shared AND role = 'assistant' AS is_target,
    length(segment) - CASE WHEN NOT shared AND role = 'assistant' THEN length(text) + 8 ELSE 0 END AS masked_chars,
    CASE WHEN NOT shared AND role = 'assistant' THEN length(text) + 8 ELSE 0 END AS target_chars
  FROM parts WHERE NOT shared OR side = 0"""

LLM_ORACLES["op7_line_windows"] = f"""WITH d AS (
    SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents),
  b AS (SELECT doc_id, list_transform(ls, lambda v: trim(v, {_BLANKS})) AS b FROM d),
  w AS (SELECT doc_id, i, b[i] AS x, b[i + 1] AS y, b[i + 2] AS z
    FROM (SELECT doc_id, b, unnest(range(1, len(b) - 1)) AS i FROM b)),
  r AS (SELECT doc_id, i, row_number() OVER (PARTITION BY x, y, z ORDER BY doc_id, i) AS rn FROM w WHERE x || y || z <> ''),
  gone AS (SELECT DISTINCT doc_id, i + k AS i FROM r, (SELECT unnest([0, 1, 2]) AS k) WHERE rn > 1),
  ln AS (SELECT doc_id, ls[i] AS v, i FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM d)),
  kept AS (SELECT doc_id, string_agg(v, chr(10) ORDER BY i) AS kept FROM ln ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id),
  n AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
  SELECT d.doc_id, coalesce(len(ls), 0) AS n_lines, coalesce(n.n, 0) AS n_removed,
    CASE WHEN text IS NOT NULL THEN md5(coalesce(kept, '')) END AS text_md5
  FROM d LEFT JOIN n USING (doc_id) LEFT JOIN kept USING (doc_id)"""


@query
def op5_preference_pairs(spark: SparkSession, folder: str) -> DataFrame:
    return preferences.format_pairs(preferences.swapped_replies(load(spark, folder, "conversations")))


@query
def op7_line_windows(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = line_windows.drop_repeated_windows(load(spark, folder, "documents").select("doc_id", "text"))
    return cleaned.select("doc_id", "n_lines", "n_removed", F.md5(F.col("text").cast("binary")).alias("text_md5"))


@query
def op8_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = load(spark, folder, "documents").select("doc_id", "lang", "text")
    counted = docs.select("doc_id", "lang", *[c.alias(m) for m, c in quality_rules.measures(F.col("text")).items()])
    counted = materialize(counted, "op8")
    judged = quality_rules.judge(counted, counted, load(spark, folder, "labels"))
    return judged.select("doc_id", *quality_rules.MEASURES, "base_failed", "kept")


@query
def op4_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    found = near_duplicates.near_duplicates(load(spark, folder, "documents"), size=3, percent=85)
    kept = F.col("doc").eqNullSafe(F.col("component_id"))
    return found.select(F.col("doc").alias("doc_id"), "n_shingles", "component_id", kept.alias("kept"))


@query
def op3_language_profiles(spark: SparkSession, folder: str) -> DataFrame:
    docs = load(spark, folder, "documents").select("doc_id", "text", "lang")
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 3 == 1
    learned = language.prototypes(docs.filter(~held_out))
    predicted = docs.select("doc_id", held_out.alias("held_out"), language.predictor(learned)("text").alias("p"))
    return predicted.select("doc_id", "held_out", "p.lang_pred", "p.score")


@query
def op9_repeated_bytes(spark: SparkSession, folder: str) -> DataFrame:
    return repeated_bytes.remove_repeats(load(spark, folder, "documents"))


@query
def op2_benchmark_leaks(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.find_leaks(load(spark, folder, "documents"), load(spark, folder, "benchmark"))


@query
def op6_site_trees(spark: SparkSession, folder: str) -> DataFrame:
    return site_trees.extract(load(spark, folder, "pages"))


#: Share of each domain in the mixed tokens, and all mixed tokens as a share of those there are.
MIX, BUDGET = {"clean": 0.85, "noisy": 0.1, "toxic": 0.05}, 0.5


@query
def op10_soft_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = load(spark, folder, "documents").select("doc_id", "text")
    rates = mixing.mix(docs, load(spark, folder, "labels"), weights=MIX, budget=BUDGET)
    own = docs.select("doc_id", mixing.row_of("doc_id", "text").alias("row"))
    return own.join(rates, "row").select("doc_id", "tokens", "p_clean", "p_noisy", "p_toxic", "rate")


@query
def op12_passage_repeats(spark: SparkSession, folder: str) -> DataFrame:
    return passage_repeats.without_repeats(load(spark, folder, "documents"))


@query
def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.trie(load(spark, folder, "conversations")).drop("turn_conv", "turn_pos")


@query
def op13_structure_repair(spark: SparkSession, folder: str) -> DataFrame:
    return structure_repair.damage_and_repair(load(spark, folder, "conversations"))


LLM_ORACLES |= {
    "op11_prefix_trie": oracles.PREFIX_TRIE,
    "op12_passage_repeats": oracles.PASSAGE_REPEATS,
    "op13_structure_repair": oracles.STRUCTURE_REPAIR,
}
