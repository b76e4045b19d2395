"""The registered queries of this subpackage: each applies one operator, with
production parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from strata.llm import credentials, exact_dedup, fim, html_text, langid, licences, mixing, quality, runs, sharding, simhash, spm, topk
from strata.sources.tables import table

SEED = 42


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spm.round_trip(table(spark, sf_dir, "documents"), spm.read_model(corpus_pipeline.SENTENCEPIECE_MODEL))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return exact_dedup.dedup(docs, exact_dedup.new_index(docs)).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"), F.crc32("text").alias("text_crc32"))
    return sharding.shard(rows, 8, SEED).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs.where(langid.in_training()))
    return langid.identify(docs.select("doc_id", "text"), model).select(
        "doc_id", F.coalesce(~langid.in_training(), F.lit(False)).alias("held_out"), "lang_pred", "score", "rejected")


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_dedup(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs.select("doc_id", "text"), model).select(
        "doc_id", F.coalesce(quality.held_out(), F.lit(False)).alias("held_out"), "score", "predicted")


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html")).select(
        "page_id", "url", F.col("main_text").alias("text"), F.char_length("main_text").cast("long").alias("n_chars"))


def op8_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = (table(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("long").alias("id"), topk.quantise(F.col("embedding")).alias("v"))
               .where("id IS NOT NULL AND v IS NOT NULL"))
    return topk.search(vectors, vectors.where("id % 50 = 0"), 5)


def op9_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return licences.scan(docs, licences.fit(docs)).select("doc_id", "licences", F.size("spans").alias("n_spans"), "spans")


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), corpus_pipeline.TARGET_WEIGHTS, seed=SEED).drop("rid")


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = runs.planted(table(spark, sf_dir, "documents").select("doc_id", "text"))
    lines = F.transform("runs", lambda x: F.concat_ws(",", x["start"], x["length"], x["period"]))
    return (runs.periodic_runs(docs).withColumn("best", runs.strongest(F.col("runs"))).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256")))


def op12_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = credentials.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("findings", lambda x: x["kind"].isin(*credentials.BASE))
    return found.select(
        "doc_id", *(credentials.count_of(kind).alias(f"n_{kind}") for kind in credentials.BASE),
        F.sha2(credentials.listed(base).cast("binary"), 256).alias("base_sha256"), credentials.listed(F.col("findings")).alias("spans"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = fim.transform(docs, fim.draws(F.col("doc_id"))).drop("text")
    return fim.restore(done).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(F.col("restored").cast("binary"), 256).alias("restored_sha256"))


QUERIES = {f.__name__: f for f in (op1_sentencepiece, op2_exact_dedup, op3_sharding, op4_language_id, op5_simhash,
                                   op6_quality, op7_html_text, op8_top_k, op9_licences, op10_mixing, op11_periodic_runs, op12_secrets,
                                   op13_fill_in_middle)} | {"pipeline": corpus_pipeline.run}

ORACLE = {
    "op2_exact_dedup": """
        WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n,
                          sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', '', 'g')) AS h FROM documents),
             g AS (SELECT h, count(*) AS group_size, max(n) AS most FROM d GROUP BY h),
             k AS (SELECT d.h, min(d.doc_id) AS keep_id FROM d JOIN g ON d.h = g.h AND d.n = g.most GROUP BY d.h)
        SELECT d.doc_id, k.keep_id, g.group_size, d.doc_id = k.keep_id AS kept, d.h AS text_sha256
        FROM d JOIN g ON d.h = g.h JOIN k ON d.h = k.h""",
    "op8_top_k": """
        WITH v AS (SELECT vec_id, [floor(256 * x::DOUBLE) FOR x IN embedding] AS q FROM embeddings
                   WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
             s AS (SELECT a.vec_id AS query_id, b.vec_id, list_dot_product(a.q, b.q)::BIGINT AS score
                   FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
             r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""",
}


def _secrets_sql() -> str:
    """The scan in SQL: the same patterns, linked by a join of a text's parts."""
    quoted = {name: "'" + pattern.replace("'", "''") + "'" for name, (pattern, _) in credentials.SCANS.items()}
    scans = " UNION ALL ".join(f"SELECT uid, '{name}' AS scan, regexp_extract_all(t, {p}) AS hits, regexp_split_to_array(t, {p}) AS gaps FROM d"
                               for name, p in quoted.items())
    kinds = {"used": "NULL", "random": "CASE WHEN regexp_matches(hit, '[0-9]') AND regexp_matches(hit, '[a-z]') AND regexp_matches(hit, '[A-Z]') THEN 'secret' END"}
    weak = " ".join("WHEN regexp_matches(hit, '^(?:" + pattern.replace("'", "''") + f")') THEN {kinds.get(name, repr(name))}" for name, pattern in credentials.WEAK)
    base, secrets, others = "('assign', 'access', 'hex')", "('assign', 'hex', 'secret')", "('access', 'identifier', 'endpoint')"
    rank = " ".join(f"WHEN '{kind}' THEN {i}" for i, kind in enumerate(credentials.KINDS))
    return f"""
        WITH d AS (SELECT row_number() OVER () AS uid, doc_id, coalesce(text, '') AS t FROM documents),
             m AS ({scans}),
             e AS (SELECT uid, scan, generate_subscripts(hits, 1) AS i, unnest(hits) AS hit, unnest(gaps[:len(hits)]) AS gap FROM m WHERE len(hits) > 0),
             p AS (SELECT uid, scan, hit, (sum(length(gap) + length(hit)) OVER (PARTITION BY uid, scan ORDER BY i))::BIGINT AS stop FROM e),
             k AS (SELECT uid, stop - length(hit) AS start, stop,
                          CASE WHEN scan = 'assign' THEN CASE WHEN length(regexp_extract(hit, {quoted['assign']}, 1)) >= 6 THEN 'assign' END
                               WHEN scan <> 'weak' THEN scan ELSE CASE {weak} END END AS kind FROM p),
             s AS (SELECT *, count(*) FILTER (kind = 'break') OVER (PARTITION BY uid ORDER BY start) AS scope FROM k WHERE kind IS NOT NULL),
             f AS (SELECT * FROM s WHERE kind IN {base} OR kind <> 'break' AND EXISTS (
                       SELECT 1 FROM s o WHERE o.uid = s.uid AND o.scope = s.scope AND o.start <= s.stop + {credentials.REACH}
                       AND o.stop + {credentials.REACH} >= s.start
                       AND (s.kind IN {secrets} AND o.kind IN {others} OR s.kind IN {others} AND o.kind IN {secrets}))),
             l AS (SELECT uid, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
                          count(*) FILTER (kind = 'hex') AS n_hex,
                          string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, CASE kind {rank} END) FILTER (kind IN {base}) AS base,
                          string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, CASE kind {rank} END) AS spans FROM f GROUP BY uid)
        SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
               sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
        FROM d LEFT JOIN l ON d.uid = l.uid"""


ORACLE["op12_secrets"] = _secrets_sql()
ORACLE["op13_fill_in_middle"] = """
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS x FROM documents),
         h AS (SELECT *, [('0x' || substr(x, 1 + 8 * i, 8))::BIGINT FOR i IN range(4)] AS h FROM d),
         c AS (SELECT doc_id, t, n, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b,
                      CASE WHEN n = 0 OR regexp_matches(t, '<[PSM]>') OR h[3] % 100 >= 90 THEN 'plain' WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h)
    SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
           sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || t[:a] || '<S>' || t[b + 1:] || '<M>' || substr(t, a + 1, b - a)
                  ELSE '<S>' || t[b + 1:] || '<P>' || t[:a] || '<M>' || substr(t, a + 1, b - a) END) AS output_sha256,
           sha256(t) AS restored_sha256
    FROM c"""
if corpus_pipeline.ORACLE_SQL:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
