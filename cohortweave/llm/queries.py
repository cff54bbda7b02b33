"""The operators applied to their whole tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortweave.llm import conversations, large_items, lines, mixing, mtree, packing, pii, resharding, simhash, spelling, substrings, toxicity, winnowing
from cohortweave.llm.shared import read

QUERIES, ORACLES = {}, {}


def query(name: str, sql: str | None = None):
    def register(run):
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query("op1_simhash_deletion_variants")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.simhash_groups(read(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query("op2_winnowing")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.fingerprint_edits(read(spark, sf_dir, "documents"))


@query("op3_min_cost_flow_resharding")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    old = F.crc32(F.coalesce(F.col("source"), F.lit("")).cast("binary")) % 16  # the layout before: sources over 16 shards
    placed = resharding.reshard(docs, old, 24)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"), "old_shard")


BLOCK = 64
MIX_SQL = f"""WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size
    FROM documents),
  o AS (SELECT source, SUM(size)::BIGINT AS s, (CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2
    ELSE 1 END)::BIGINT AS w FROM d GROUP BY source),
  r AS (SELECT *, (SUM(s) OVER () - 3 * coalesce(SUM(s) OVER before, 0))::BIGINT AS l,
    (SUM(w) OVER () - coalesce(SUM(w) OVER before, 0))::BIGINT AS ws FROM o
    WINDOW before AS (ORDER BY s / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
  v AS (SELECT MAX(CASE WHEN l * w <= 3 * s * ws THEN l / ws END) AS level FROM r),
  t AS (SELECT source, s, LEAST(level * w, (3 * s)::DOUBLE) AS target FROM o, v),
  c AS (SELECT *, SUM(target) OVER (ORDER BY source NULLS LAST) / SUM(target) OVER () AS hi, (SUM(target) OVER (ORDER BY source NULLS LAST)
    - target) / SUM(target) OVER () AS lo, lead(1) OVER (ORDER BY source NULLS LAST) IS NULL AS final FROM t WHERE target > 0),
  p AS (SELECT x - floor(x) AS x FROM (SELECT (i % 1048576) * 0.6180339887498949e0 + (h - floor(h)) AS x FROM (
    SELECT i, floor(i / 1048576) * {(mixing.PHI * (1 << 20)) % 1.0!r}::DOUBLE AS h FROM range((SELECT ceil(SUM(size) / {BLOCK})::BIGINT FROM d)) g(i)))),
  n AS (SELECT source, COUNT(*) * {BLOCK} AS room FROM c, p WHERE x >= lo AND (x < hi OR final) GROUP BY source),
  b AS (SELECT d.*, SUM(size) OVER (PARTITION BY source ORDER BY md5(concat('mix/', doc_id)), doc_id, size) - size AS pos FROM d),
  e AS (SELECT b.*, t.s, t.target, coalesce(n.room, 0) AS room FROM b JOIN t ON b.source IS NOT DISTINCT FROM t.source
    LEFT JOIN n ON b.source IS NOT DISTINCT FROM n.source)
  SELECT doc_id, size, s AS source_size, target, CAST(
    greatest(0, least(pos + size, room) - pos) + greatest(0, least(s + pos + size, room) - s - pos)
    + greatest(0, least(2 * s + pos + size, room) - 2 * s - pos) AS BIGINT) AS taken FROM e"""


@query("op5_low_discrepancy_mix", MIX_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken_words(read(spark, sf_dir, "documents"), block=BLOCK)


@query("op9_min_bin_slack_packing")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read(spark, sf_dir, "documents"), tokenizer_path())


@query("op10_ftrl_toxicity")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxic_scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query("op6_fuzzy_line_dedup")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    out = lines.without_repeats(docs.select("doc_id", "text", F.char_length("text").alias("chars_before")))
    return out.select("doc_id", "chars_before", F.char_length("text").alias("chars_kept"), F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


@query("op4_weak_supervision_pii")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.personal_data(read(spark, sf_dir, "documents"))
    counts = [F.expr(f"CAST(size(filter(base, s -> s.kind = {i})) AS BIGINT)").alias(f"n_{kind}") for i, kind in enumerate(pii.KINDS)]
    return found.select("doc_id", *counts, F.sha2(F.expr(pii.as_text("base")).cast("binary"), 256).alias("base_sha256"),
                        F.expr(pii.as_text("array_sort(concat(base, added))")).alias("spans"))


TOP_SQL = """WITH v AS (SELECT vec_id, [floor(256 * x::DOUBLE) FOR x IN embedding] AS e FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND list_count(embedding) = len(embedding)
      AND len([x FOR x IN embedding IF NOT isfinite(x)]) = 0),
  s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_inner_product(q.e, c.e)::BIGINT AS score FROM v q JOIN v c ON q.vec_id <> c.vec_id
    WHERE q.vec_id % 50 = 0)
  SELECT query_id, CAST(n AS INT) AS rank, vec_id, score FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s) WHERE n <= 5"""


@query("op7_m_tree_top_k", TOP_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mtree.top_k(read(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, k=5)


@query("op8_suffix_automaton_dedup")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.without_repeats(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


@query("op11_conversation_repair")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read(spark, sf_dir, "conversations")
    return conversations.repaired_conversations(turns, conversations.damaged(turns))


@query("op12_partenum_spelling")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(read(spark, sf_dir, "documents"))


@query("op13_large_item_packing")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return large_items.pack_documents(read(spark, sf_dir, "documents"), tokenizer_path())
