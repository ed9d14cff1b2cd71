"""Driver queries of the text operators, op1 to op13, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pelagia.llm import chat_format, license_scan, merkle, mixing, near_dedup, pii, piece_sampling, quality_model, quality_rules, search, substring_dedup, toxicity, whitening
from pelagia.llm.common import table


#: The test queries' key; a real run passes a secret of its own.
PII_KEY = "published test key"


def op1_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    changed = F.filter("pii", lambda p: p["found"] != p["text"])
    out = pii.pseudonymize(docs, PII_KEY).withColumn("changed", changed)
    return out.select("doc_id", "text", F.size("changed").cast("long").alias("n_replaced"), F.array_sort(F.array_distinct("changed.kind")).alias("kinds"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").where(~held_out))
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"), "n_finds")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    cols = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return quality_rules.judge(docs).select(*cols)


def op4_block_max_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document whose id is divisible by 20 asks; all others may answer."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return search.search(search.build_index(docs), docs.where(F.col("doc_id") % 20 == 0))


#: Where the box keeps public tokenizers; a parameter of every function that needs one.
PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def op5_piece_sampling(spark: SparkSession, sf_dir: str, model_file: str = PIECE_MODEL) -> DataFrame:
    """Two segmentations of every text; whether each decodes to its text is told by the texts' hashes."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = piece_sampling.encode(docs, model_file, k=2, with_text=True)
    return encoded.select(
        "doc_id", "sample", F.size("ids").cast("long").alias("n_pieces"), F.xxhash64("ids").alias("ids_hash"), "log_prob", "perturbed", "log_inclusion", F.xxhash64("text").alias("decoded_hash")
    )


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", F.col("taken"))


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.assign(table(spark, sf_dir, "documents"))


def op8_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    vectors, network = quality_model.fit(docs, table(spark, sf_dir, "labels").where(~held_out))
    scored = quality_model.score(docs, vectors, network)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), F.lit(said).alias("text"))
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat_format.digests(chat_format.windows(turns))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.by_document(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose id's crc32 is divisible by 5 are checked with a text in small letters."""
    docs = table(spark, sf_dir, "documents").select(*merkle.FIELDS)
    small = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    other = merkle.digest([small if f == "text" else F.col(f) for f in merkle.FIELDS])
    return merkle.manifest(docs, F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, other))


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup.remove(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = whitening.integers(table(spark, sf_dir, "embeddings"))
    model = whitening.fit(vectors)
    explained = F.array(*(F.lit(float(v / model.trace)) for v in model.values))
    rows = whitening.whiten(vectors, model).select(F.col("row.vec_id").alias("vec_id"), F.lit(model.n).cast("long").alias("n"), F.col("deviation").cast("long").alias("deviation"), F.posexplode("whitened").alias("i", "whitened"))
    return rows.select("vec_id", (F.col("i") + 1).alias("component"), "n", "deviation", "whitened", F.get(explained, "i").cast("double").alias("explained"), F.lit(model.identity_error).alias("identity_error"))


def queries() -> dict:
    return {f.__name__: f for f in (op1_pii_pseudonyms, op2_toxicity, op3_quality_rules, op4_block_max_search, op5_piece_sampling, op6_source_mixing, op7_near_dedup, op8_quality_model, op9_chat_format, op10_license_scan, op11_merkle_manifest, op12_substring_dedup, op13_embedding_whitening)}


#: op3 in DuckDB SQL. The other operators draw, learn or search in ways SQL has no words for; tests hold them against
#: brute force, round trips and held-out labels.
QUALITY_RULES_SQL = r"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
  list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls,
  CASE WHEN source IS NULL THEN NULL ELSE coalesce(nullif(regexp_extract(lower(source), '^(?:[a-z][a-z0-9+.-]*://)?(?:[^/@]*@)?([^/:?#]+)', 1), ''), lower(source)) END AS host FROM d),
g AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, array_to_string(ws[i:i+4], ' ')) AS c FROM w, unnest(range(1, len(ws) - 3)) t(i)),
r AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM g, unnest([0, 1, 2, 3, 4]) u(k) WHERE c > 1 GROUP BY doc_id),
m AS (SELECT w.doc_id, host, len(ws)::BIGINT AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
  (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
  (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words FROM w LEFT JOIN r USING (doc_id)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m),
h AS (SELECT host, count(*) AS n, count(*) FILTER (base_failed) AS f FROM b WHERE host IS NOT NULL GROUP BY host),
s AS (SELECT avg(f / n) AS mu, var_pop(f / n) AS v, avg(1 / n) AS inv FROM h),
p AS (SELECT mu, CASE WHEN mu > 0 AND mu < 1 THEN least(greatest(mu * (1 - mu) / greatest(v - mu * (1 - mu) * inv, mu * (1 - mu) / 10001) - 1, 1), 10000) END AS k FROM s),
x AS (SELECT host FROM h, p WHERE (f + coalesce(mu * k, mu + 0.01)) / (n + coalesce(k, 1.02)) > 0.5)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND coalesce(host NOT IN (SELECT host FROM x), TRUE) AS kept FROM b
"""


#: op11: all levels of all trees, each node's siblings around a bar, and every leaf folded up its own list of them.
MERKLE_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, source, sha256(coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-')
    || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
  sha256(coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-')
    || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || coalesce(strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-')) AS other,
  xor(list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda x: [ascii(x)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))), lambda a, x: xor(xor(a, x) >> 1, 3988292384 * (xor(a, x) & 1))), 4294967295) AS crc FROM documents),
l AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank, count(*) OVER (PARTITION BY source) AS n FROM d),
up AS (SELECT 0 AS lvl, source AS grp, rank, leaf AS hash, n FROM l
  UNION ALL SELECT lvl + 1, grp, rank // 16, sha256(string_agg(hash, '' ORDER BY rank)), (any_value(n) + 15) // 16 FROM up WHERE n > 1 GROUP BY lvl, grp, rank // 16),
sub AS (SELECT grp AS source, hash AS subroot, row_number() OVER (ORDER BY grp NULLS FIRST) - 1 AS rank, count(*) OVER () AS n FROM up WHERE n = 1),
top AS (SELECT 0 AS lvl, rank, subroot AS hash, n FROM sub
  UNION ALL SELECT lvl + 1, rank // 16, sha256(string_agg(hash, '' ORDER BY rank)), (any_value(n) + 15) // 16 FROM top WHERE n > 1 GROUP BY lvl, rank // 16),
s AS (SELECT *, coalesce(string_agg(hash, '') OVER b, '') || '|' || coalesce(string_agg(hash, '') OVER a, '') AS step FROM up WHERE n > 1
  WINDOW b AS (PARTITION BY lvl, grp, rank // 16 ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), a AS (PARTITION BY lvl, grp, rank // 16 ORDER BY rank ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
t AS (SELECT *, coalesce(string_agg(hash, '') OVER b, '') || '|' || coalesce(string_agg(hash, '') OVER a, '') AS step FROM top WHERE n > 1
  WINDOW b AS (PARTITION BY lvl, rank // 16 ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), a AS (PARTITION BY lvl, rank // 16 ORDER BY rank ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
tp AS (SELECT sub.source, any_value(subroot) AS subroot, coalesce(list(step ORDER BY lvl) FILTER (step IS NOT NULL), []) AS path FROM sub LEFT JOIN t ON t.rank = sub.rank // (16 ** t.lvl)::BIGINT GROUP BY sub.source),
lp AS (SELECT l.source, l.rank, coalesce(list(step ORDER BY lvl) FILTER (step IS NOT NULL), []) AS path FROM l LEFT JOIN s ON s.grp IS NOT DISTINCT FROM l.source AND s.rank = l.rank // (16 ** s.lvl)::BIGINT GROUP BY l.source, l.rank),
p AS (SELECT l.*, subroot, list_concat(lp.path, tp.path) AS path FROM l JOIN lp ON lp.source IS NOT DISTINCT FROM l.source AND lp.rank = l.rank JOIN tp ON tp.source IS NOT DISTINCT FROM l.source)
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM (SELECT doc_id, leaf, subroot, (SELECT hash FROM top WHERE n = 1) AS root,
  sha256(array_to_string(list_transform(path, lambda x: replace(x, '|', '')), '')) AS proof_sha256,
  list_reduce(list_concat([CASE WHEN crc % 5 = 0 THEN other ELSE leaf END], path), lambda a, x: sha256(replace(x, '|', a))) AS folded_root FROM p)
"""

#: op12: every window's later occurrences, and the words they cover.
SUBSTRING_SQL = r"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
w AS (SELECT doc_id, i, md5(array_to_string(ws[i:i+19], ' ')) AS k FROM d, unnest(range(1, len(ws) - 18)) t(i)),
later AS (SELECT doc_id, i FROM w QUALIFY row_number() OVER (PARTITION BY k ORDER BY doc_id NULLS FIRST, i) > 1),
gone AS (SELECT DISTINCT doc_id, i + j AS p FROM later, unnest(range(20)) t(j)),
word AS (SELECT doc_id, p, ws[p] AS v FROM d, unnest(range(1, len(ws) + 1)) t(p)),
k AS (SELECT doc_id, count(*) AS n, string_agg(v, ' ' ORDER BY p) AS kept FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN k USING (doc_id)
"""


def oracle_sql() -> dict[str, str]:
    return {"op3_quality_rules": QUALITY_RULES_SQL, "op11_merkle_manifest": MERKLE_SQL, "op12_substring_dedup": SUBSTRING_SQL}
