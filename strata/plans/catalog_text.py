"""Text analytics and retrieval queries.

The driver's documents are invented prose, so the registered queries use
lexicons and keyword lists made of tokens that occur in it; the reference's
own word lists are the library defaults and are covered by fixture tests.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.functions.udfs import prompt_length_stub
from strata.operators import approx_vectors, lexicons
from strata.operators import ml
from strata.operators import retrieval as RT
from strata.operators import text as TX
from strata.plans.registry import register
from strata.plans.sqlbase import with_
from strata.sources import derived as D
from strata.sources.tables import table

DOC_LEXICON = {"the": 0.30, "and": 0.50, "for": -0.40, "with": -0.20, "of": 0.10,
               "le": 0.25, "la": -0.35, "que": 0.40, "des": -0.15, "un": 0.20, "el": -0.45, "die": 0.35}
DOC_RULES = (("rule_with", (" with ",)), ("rule_que", (" que ", " des ")), ("rule_the", (" the ",)))
DOC_LABEL_KEYWORDS = {"shipping": ("the", "with"), "product_quality": ("and", "que"),
                      "pricing": ("for", "des"), "customer_service": ("of", "le")}
FILTER_SOURCE = "src3"
ABUSE_LABELS = ("civil", "abusive")


def _tok(x: str) -> str:
    return rf"list_filter(regexp_split_to_array(lower({x}), '[^\p{{L}}]+'), lambda t: t <> '')"


def _lex_values(lex) -> str:
    return "VALUES " + ", ".join(f"('{w}', CAST({p} AS DECIMAL(6,4)))" for w, p in sorted(lex.items()))


_SENT_SQL = {
    "tok": f"SELECT feedback_id, unnest({_tok('feedback_text')}) AS term FROM feedback",
    "lex": f"SELECT * FROM ({_lex_values(DOC_LEXICON)}) v(term, p)",
    "sc": """SELECT t.feedback_id,
                    CAST(CAST(SUM(CAST(l.p AS DECIMAL(18,4))) AS DECIMAL(18,4)) / COUNT(*) AS DECIMAL(18,6)) AS s
             FROM tok t JOIN lex l USING (term) GROUP BY 1""",
    "scores": """SELECT f.feedback_id, f.feedback_text, coalesce(sc.s, CAST(0 AS DECIMAL(18,6))) AS sentiment_score
                 FROM feedback f LEFT JOIN sc USING (feedback_id)""",
}


def _rules_sql(rules, default, col="feedback_text") -> str:
    parts = []
    for label, words in rules:
        cond = " OR ".join(f"contains(lower({col}), '{w.lower()}')" for w in words)
        parts.append(f"WHEN {cond} THEN '{label}'")
    return "CASE " + " ".join(parts) + f" ELSE '{default}' END"


def _classify_sql(col="feedback_text") -> str:
    labels = TX.CLASSIFY_LABELS
    s = []
    for lab in labels:
        kws = ", ".join(f"'{k}'" for k in DOC_LABEL_KEYWORDS[lab])
        s.append(f"len(list_filter({_tok(col)}, lambda t: t IN ({kws})))")
    whens = []
    for i, lab in enumerate(labels[:-1]):
        cond = " AND ".join(f"{s[i]} >= {s[j]}" for j in range(i + 1, len(labels)))
        whens.append(f"WHEN {cond} THEN '{lab}'")
    return "CASE " + " ".join(whens) + f" ELSE '{labels[-1]}' END"


# ------------------------------------------------------------- sentiment --

@register("n01_n02_n05_feedback_analysis", with_("feedback", extra=_SENT_SQL) + f"""
SELECT feedback_id,
       CASE WHEN sentiment_score > 0.1 THEN 'positive' WHEN sentiment_score < -0.1 THEN 'negative'
            ELSE 'neutral' END AS sentiment_label,
       sentiment_score,
       {_rules_sql(DOC_RULES, TX.FEEDBACK_DEFAULT)} AS category
FROM scores""")
def n05(spark, sf):
    return TX.feedback_analysis(D.feedback(spark, sf), DOC_LEXICON, DOC_RULES)


@register("n03_f08_reference_keyword_rules", with_("feedback") + f"""
SELECT feedback_id, {_rules_sql(TX.FEEDBACK_RULES, TX.FEEDBACK_DEFAULT)} AS category FROM feedback""")
def n03(spark, sf):
    f = D.feedback(spark, sf)
    return f.select("feedback_id", TX.keyword_category("feedback_text").alias("category"))


@register("n04_n06_v09_feedback_list", with_("feedback", extra=_SENT_SQL) + f"""
SELECT feedback_id, feedback_text, CAST(round(sentiment_score, 2) AS DOUBLE) AS sentiment,
       {_classify_sql()} AS category
FROM scores ORDER BY sentiment""")
def n06(spark, sf):
    from strata.functions.text import spread, tokens

    f = spread(D.feedback(spark, sf)).select("feedback_id", "feedback_text",
                                               tokens("feedback_text").alias("_tok"))  # tokenised once
    out = f.select("feedback_id", "feedback_text",
                   F.round(TX.sentiment_from_tokens(F.col("_tok"), DOC_LEXICON), 2).cast("double").alias("sentiment"),
                   TX.classify_tokens(F.col("_tok"), DOC_LABEL_KEYWORDS)["label"].alias("category"))
    return out.orderBy("sentiment")


_REPORT_SQL = {"metrics": """
SELECT COUNT(*) AS total, SUM(CASE WHEN sentiment_score > 0.3 THEN 1 ELSE 0 END) AS positive,
       SUM(CASE WHEN sentiment_score < -0.3 THEN 1 ELSE 0 END) AS negative,
       CAST(round(CAST(SUM(sentiment_score) / COUNT(*) AS DECIMAL(38,6)), 2) AS DOUBLE) AS avg_score
FROM scores"""}


@register("n07_a06_a07_report_metrics", with_("feedback", extra={**_SENT_SQL, **_REPORT_SQL}) +
          "SELECT total, CAST(positive AS BIGINT) AS positive, CAST(negative AS BIGINT) AS negative, avg_score "
          "FROM metrics")
def n07(spark, sf):
    return TX.report_metrics(D.feedback(spark, sf), DOC_LEXICON)


@register("n16_f07_report_prompt", with_("feedback", extra={**_SENT_SQL, **_REPORT_SQL}) + """
SELECT 'Write a 3-sentence executive summary. Total: ' || CAST(total AS VARCHAR) || ', Positive: ' ||
       CAST(positive AS VARCHAR) || ', Negative: ' || CAST(negative AS VARCHAR) || ', Avg sentiment: ' ||
       CAST(avg_score AS VARCHAR) || '. Be specific and actionable.' AS prompt FROM metrics""")
def n16(spark, sf):
    return TX.report_prompt(TX.report_metrics(D.feedback(spark, sf), DOC_LEXICON))


@register("f17_n02_threshold_labels", with_("feedback", extra=_SENT_SQL) + """
SELECT feedback_id,
       CASE WHEN sentiment_score > 0.3 THEN 'POSITIVE' WHEN sentiment_score < -0.3 THEN 'NEGATIVE'
            ELSE 'NEUTRAL' END AS report_label,
       printf('%+.2f', round(sentiment_score, 2)) AS score_text
FROM scores""")
def f17(spark, sf):
    s = D.feedback(spark, sf).select("feedback_id", TX.sentiment_score("feedback_text", DOC_LEXICON).alias("s"))
    return s.select("feedback_id", TX.sentiment_label("s", 0.3, upper=True).alias("report_label"),
                    F.format_string("%+.2f", F.round("s", 2).cast("double")).alias("score_text"))


# --------------------------------------------------------- learned words --

def _seen_sql(marked: str) -> dict[str, str]:
    """Words of the marked documents, each once per document; ``y`` is 1 for abusive."""
    return {
        "marked": marked,
        "md": "SELECT d.doc_id, d.text, m.y FROM documents d JOIN marked m USING (doc_id)",
        "total": "SELECT CAST(COUNT(*) AS DOUBLE) AS n, CAST(SUM(y) AS DOUBLE) AS k1, CAST(SUM(1 - y) AS DOUBLE) AS k0 FROM md",
        "seen": f"SELECT y, unnest(list_distinct({_tok('text')})) AS term FROM md",
        "wc": """SELECT term, COUNT(*) AS n, CAST(SUM(1 - y) AS BIGINT) AS k0, CAST(SUM(y) AS BIGINT) AS k1
                 FROM seen GROUP BY 1""",
        "wr": """SELECT w.*, CAST(w.k0 AS DOUBLE) * t.k1 AS good, CAST(w.k1 AS DOUBLE) * t.k0 AS bad,
                        t.k1 / t.n AS r1, t.k0 / t.n AS r0 FROM wc w CROSS JOIN total t WHERE w.n >= 5""",
    }


_ALL_MARKS = "SELECT doc_id, MAX(toxic) AS y FROM labels WHERE toxic IN (0, 1) GROUP BY 1"
_HELD_OUT = "substr(md5(CAST(doc_id AS VARCHAR)), 1, 1) IN ('0', '1', '2')"

_POLARITY_SQL = {**_seen_sql(_ALL_MARKS), "pol": """
SELECT term, k0 AS docs_positive, k1 AS docs_negative,
       CAST((CASE WHEN good < bad THEN -1 ELSE 1 END) *
            floor(10000.0::DOUBLE * abs(good - bad) * n / ((good + bad) * (n + 5.0::DOUBLE))) / 10000 AS DECIMAL(6,4)) AS polarity
FROM wr WHERE good + bad > 0
  AND (k1 - n * r1) * (k1 - n * r1) >= 36.0::DOUBLE * n * r1 * (1.0::DOUBLE - r1)"""}


def _label_words_sql(marked: str) -> dict[str, str]:
    return {**_seen_sql(marked), "lw": " UNION ALL ".join(f"""
SELECT term, '{label}' AS label, n AS docs, k{i} AS docs_label FROM wr
WHERE k{i} > n * r{i} AND (k{i} - n * r{i}) * (k{i} - n * r{i}) >= 36.0::DOUBLE * n * r{i} * (1.0::DOUBLE - r{i})"""
                                                      for i, label in enumerate(ABUSE_LABELS))}


_CLASSIFY_BY_WORDS_SQL = {
    "dt": f"SELECT doc_id, unnest({_tok('text')}) AS term FROM documents",
    "lc": "SELECT doc_id, label, COUNT(*) AS score FROM dt JOIN lw USING (term) GROUP BY 1, 2",
    "best": "SELECT * FROM lc QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, label DESC) = 1",
    "said": """SELECT d.doc_id, coalesce(b.label, 'civil') AS label, coalesce(b.score, 0) AS score
               FROM documents d LEFT JOIN best b USING (doc_id)""",
}


def _polarity(spark, sf):
    return lexicons.polarity_words(table(spark, sf, "documents"), table(spark, sf, "labels"), "toxic")


def _abuse_marks(spark, sf):
    marks = table(spark, sf, "labels").filter(F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").alias("y"))
    return marks.select("doc_id", F.when(F.col("y") == 1, ABUSE_LABELS[1]).otherwise(ABUSE_LABELS[0]).alias("label"))


@register("n01_polarity_words", with_(extra=_POLARITY_SQL) + "SELECT * FROM pol WHERE polarity <> 0")
def n01_words(spark, sf):
    """Polarity of words, learned from the documents that `labels` marks as toxic or not."""
    return _polarity(spark, sf)


@register("n01_n02_learned_sentiment", with_(extra={**_POLARITY_SQL, "toks": f"SELECT doc_id, unnest({_tok('text')}) AS term FROM documents",
                                                    "sc": """SELECT doc_id, CAST(CAST(SUM(polarity) AS DECIMAL(18,4)) / COUNT(*) AS DECIMAL(18,6)) AS s
                                                             FROM toks JOIN pol USING (term) WHERE polarity <> 0 GROUP BY 1""",
                                                    "scored": """SELECT d.doc_id, coalesce(sc.s, CAST(0 AS DECIMAL(18,6))) AS sentiment_score
                                                                 FROM documents d LEFT JOIN sc USING (doc_id)"""}) + """
SELECT doc_id, sentiment_score,
       CASE WHEN sentiment_score > 0.1 THEN 'positive' WHEN sentiment_score < -0.1 THEN 'negative'
            ELSE 'neutral' END AS sentiment_label FROM scored""")
def n01_learned(spark, sf):
    scored = lexicons.sentiment_by_words(table(spark, sf, "documents"), lexicons.kept(_polarity(spark, sf)))
    return scored.withColumn("sentiment_label", TX.sentiment_label("sentiment_score"))


@register("n04_learned_labels", with_(extra={**_label_words_sql(_ALL_MARKS), **_CLASSIFY_BY_WORDS_SQL}) + "SELECT * FROM said")
def n04_learned(spark, sf):
    """Civil or abusive, by words learned from all marked documents."""
    docs = table(spark, sf, "documents")
    words = lexicons.label_words(docs, _abuse_marks(spark, sf), ABUSE_LABELS, "label")
    return lexicons.classify_by_words(docs, lexicons.kept(words), ABUSE_LABELS)


@register("n04_x12_learned_label_report",
          with_(extra={**_label_words_sql(f"{_ALL_MARKS} HAVING NOT {_HELD_OUT}"), **_CLASSIFY_BY_WORDS_SQL,
                       "test": f"SELECT doc_id, MAX(toxic) AS y FROM labels WHERE toxic IN (0, 1) AND {_HELD_OUT} GROUP BY 1",
                       "pr": "SELECT t.y, CASE WHEN s.label = 'civil' THEN 0 ELSE 1 END AS p FROM test t JOIN said s USING (doc_id)",
                       "cells": """SELECT c, SUM(CASE WHEN y = c AND p = c THEN 1.0 ELSE 0 END)::DOUBLE AS tp,
                                          SUM(CASE WHEN y <> c AND p = c THEN 1.0 ELSE 0 END)::DOUBLE AS fp,
                                          SUM(CASE WHEN y = c AND p <> c THEN 1.0 ELSE 0 END)::DOUBLE AS fn
                                   FROM pr, (VALUES (0), (1)) v(c) GROUP BY c""",
                       "ratios": """SELECT c, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS "precision",
                                           CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END AS recall,
                                           CAST(tp + fn AS BIGINT) AS support FROM cells"""}) + """
SELECT c AS class, "precision", recall,
       CASE WHEN "precision" + recall > 0 THEN 2 * "precision" * recall / ("precision" + recall) ELSE 0 END AS f1_score, support
FROM ratios""")
def n04_report(spark, sf):
    """Words learned from four fifths of the marked documents, judged on the others."""
    docs, marks = table(spark, sf, "documents"), _abuse_marks(spark, sf)
    held_out = F.substring(F.md5(F.col("doc_id").cast("string")), 1, 1).isin("0", "1", "2")
    words = lexicons.kept(lexicons.label_words(docs, marks.filter(~held_out), ABUSE_LABELS, "label"))
    truth = marks.filter(held_out).select("doc_id", (F.col("label") == ABUSE_LABELS[1]).cast("int").alias("y"))
    said = lexicons.classify_by_words(docs, words, ABUSE_LABELS)
    pred = said.join(truth, "doc_id").select("y", (F.col("label") == ABUSE_LABELS[1]).cast("int").alias("prediction"))
    return ml.classification_report(pred, "y", "prediction")


# --------------------------------------------------------------- summary --

_SUM_SQL = {
    "sp": r"""SELECT doc_id, unnest(regexp_split_to_array(text, '[.!?\n]+')) AS s0,
                     generate_subscripts(regexp_split_to_array(text, '[.!?\n]+'), 1) - 1 AS pos FROM documents""",
    "sents": "SELECT doc_id, pos, trim(s0, ' ') AS sentence FROM sp WHERE length(trim(s0, ' ')) > 0",
    "stoks": f"SELECT doc_id, pos, unnest({_tok('sentence')}) AS term FROM sents",
    "tf": "SELECT doc_id, term, COUNT(*) AS tf FROM stoks GROUP BY 1, 2",
    "dfs": "SELECT term, COUNT(*) AS df FROM tf GROUP BY 1",
    "w": """SELECT tf.doc_id, tf.term, tf.tf * ln((SELECT COUNT(*) FROM documents) / dfs.df) AS w
            FROM tf JOIN dfs USING (term)""",
    "ss": """SELECT s.doc_id, s.pos, round(AVG(w.w), 9) AS score FROM stoks s JOIN w USING (doc_id, term)
             GROUP BY 1, 2""",
    "top": """SELECT doc_id, pos FROM ss
              QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, pos) <= 2""",
}


@register("n08_extractive_summary", with_(extra=_SUM_SQL) + """
SELECT d.doc_id, coalesce(a.summary, '') AS summary FROM documents d LEFT JOIN (
  SELECT t.doc_id, string_agg(s.sentence, ' ' ORDER BY t.pos) AS summary
  FROM top t JOIN sents s USING (doc_id, pos) GROUP BY t.doc_id) a USING (doc_id)""")
def n08(spark, sf):
    from strata.sources.tables import table

    return TX.summarize(table(spark, sf, "documents"), "doc_id", "text", 2)


# ------------------------------------------------------------- retrieval --

def _bm25_sql(corpus_filter: str = "") -> dict[str, str]:
    return {
        "corpus": f"SELECT * FROM policies {corpus_filter}",
        "post": f"""SELECT term, doc_id, COUNT(*) AS tf FROM (
                     SELECT doc_id, unnest({_tok('content')}) AS term FROM corpus) GROUP BY 1, 2""",
        "dl": "SELECT doc_id, SUM(tf) AS dl FROM post GROUP BY 1",
        "stats": "SELECT COUNT(*) AS n, AVG(dl) AS avgdl FROM dl",
        "dfs": "SELECT term, COUNT(*) AS df FROM post GROUP BY 1",
        "idf": """SELECT term, ln(1 + (CAST((SELECT n FROM stats) - df AS DOUBLE) + 0.5)
                                 / (CAST(df AS DOUBLE) + 0.5)) AS idf FROM dfs""",
        "qt": f"SELECT DISTINCT q_id, unnest({_tok('question')}) AS term FROM questions",
        "bm": """SELECT q.q_id, p.doc_id,
                        round(SUM(i.idf * p.tf * 2.2 / (p.tf + 1.2 * (0.25 + 0.75 * d.dl / (SELECT avgdl FROM stats)))),
                              9) AS score
                 FROM qt q JOIN idf i USING (term) JOIN post p USING (term) JOIN dl d ON d.doc_id = p.doc_id
                 GROUP BY 1, 2""",
        "bm_rank": """SELECT q_id, doc_id, score,
                             CAST(row_number() OVER (PARTITION BY q_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM bm""",
    }


_VEC_SQL = {
    "dv": "SELECT d.doc_id, e.embedding FROM documents d JOIN embeddings e ON d.doc_id = e.vec_id",
    "qv": "SELECT b.item_id AS q_id, e.embedding FROM benchmark b JOIN embeddings e ON b.item_id = e.vec_id",
    "sims": """SELECT q.q_id, d.doc_id,
                      round(list_dot_product(CAST(q.embedding AS DOUBLE[]), CAST(d.embedding AS DOUBLE[]))
                            / (sqrt(list_dot_product(CAST(q.embedding AS DOUBLE[]), CAST(q.embedding AS DOUBLE[])))
                               * sqrt(list_dot_product(CAST(d.embedding AS DOUBLE[]), CAST(d.embedding AS DOUBLE[])))),
                            9) AS score
               FROM qv q CROSS JOIN dv d""",
    "vec_rank": """SELECT q_id, doc_id, score,
                          CAST(row_number() OVER (PARTITION BY q_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM sims""",
}


def _bm25(spark, sf, corpus=None):
    """BM25 index of the questions' words over all documents, or those of ``corpus``."""
    corpus = corpus if corpus is not None else D.policies(spark, sf)
    return RT.Lexical(corpus, D.questions(spark, sf))


@register("n09_bm25_top_k", with_("policies", "questions", extra=_bm25_sql()) +
          "SELECT q_id, doc_id, round(score, 6) AS score, rank FROM bm_rank WHERE rank <= 3")
def n09(spark, sf):
    top = RT.bm25_top_k(D.policies(spark, sf), D.questions(spark, sf), 3)
    return top.select("q_id", "doc_id", F.round("score", 6).alias("score"), "rank")


@register("n12_filtered_bm25_top_k",
          with_("policies", "questions", extra=_bm25_sql(f"WHERE policy_name = '{FILTER_SOURCE}'")) +
          "SELECT q_id, doc_id, round(score, 6) AS score, rank FROM bm_rank WHERE rank <= 3")
def n12(spark, sf):
    corpus = D.policies(spark, sf).filter(F.col("policy_name") == FILTER_SOURCE)  # before scoring
    top = RT.bm25_top_k(corpus, D.questions(spark, sf), 3)
    return top.select("q_id", "doc_id", F.round("score", 6).alias("score"), "rank")


@register("n10_vector_top_k", with_(extra=_VEC_SQL) +
          "SELECT q_id, doc_id, round(score, 6) AS score, rank FROM vec_rank WHERE rank <= 3")
def n10(spark, sf):
    top = RT.vector_top_k(D.document_vectors(spark, sf), D.question_vectors(spark, sf), 3)
    return top.select("q_id", "doc_id", F.round("score", 6).alias("score"), "rank")


@register("n10_approximate_recall", with_(extra=_VEC_SQL) + """
SELECT COUNT(DISTINCT q_id) AS questions, COUNT(*) AS exact_pairs, TRUE AS recall_at_least_90 FROM vec_rank WHERE rank <= 3""")
def n10_recall(spark, sf):
    """The approximate search of all questions against the exact one."""
    docs, questions = D.document_vectors(spark, sf), D.question_vectors(spark, sf)
    found = approx_vectors.ProjectionTables(docs, 3).top_k(questions)
    r = approx_vectors.recall(found, RT.vector_top_k(docs, questions, 3))
    return r.select("questions", "exact_pairs", (F.col("recall") >= 0.9).alias("recall_at_least_90"))


_HYBRID_SQL = {
    "fused": """SELECT q_id, doc_id, round(SUM(1.0 / (60 + rank)), 9) AS score FROM (
                   SELECT q_id, doc_id, rank FROM bm_rank
                   UNION ALL
                   SELECT q_id, doc_id, rank FROM vec_rank) GROUP BY 1, 2""",
    "hybrid": """SELECT q_id, doc_id, score,
                        CAST(row_number() OVER (PARTITION BY q_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM fused""",
}


def hybrid_top_k(spark, sf, k=3, source=None):
    """Both halves read the same documents: all, or those of one source."""
    corpus, vectors = D.policies(spark, sf), D.document_vectors(spark, sf)
    if source is not None:
        corpus, vectors = corpus.filter(F.col("policy_name") == source), vectors.filter(F.col("source") == source)
    return RT.hybrid_top_k(_bm25(spark, sf, corpus), vectors, D.question_vectors(spark, sf), k)


_HYB_ALL = {**_bm25_sql(), **_VEC_SQL, **_HYBRID_SQL}


@register("n11_o05_hybrid_rrf_top_k", with_("policies", "questions", extra=_HYB_ALL) +
          "SELECT q_id, doc_id, round(score, 6) AS score, rank FROM hybrid WHERE rank <= 3")
def n11(spark, sf):
    return hybrid_top_k(spark, sf).select("q_id", "doc_id", F.round("score", 6).alias("score"), "rank")


_FILTERED_VEC = {**_VEC_SQL, "dv": _VEC_SQL["dv"] + f" WHERE d.source = '{FILTER_SOURCE}'"}


@register("n11_n12_filtered_hybrid_top_k",
          with_("policies", "questions", extra={**_bm25_sql(f"WHERE policy_name = '{FILTER_SOURCE}'"), **_FILTERED_VEC, **_HYBRID_SQL}) +
          "SELECT q_id, doc_id, round(score, 6) AS score, rank FROM hybrid WHERE rank <= 3")
def n11_filtered(spark, sf):
    return hybrid_top_k(spark, sf, source=FILTER_SOURCE).select("q_id", "doc_id", F.round("score", 6).alias("score"), "rank")


_PROMPT_SQL = {
    "top3": "SELECT * FROM hybrid WHERE rank <= 3",
    "blocks": """SELECT t.q_id, t.rank, p.policy_name, '[' || p.policy_name || ']:' || chr(10) || p.content AS block
                 FROM top3 t JOIN policies p USING (doc_id)""",
    "ctx": """SELECT q_id, string_agg(block, chr(10) || chr(10) ORDER BY rank) AS context,
                     string_agg(policy_name, ', ' ORDER BY rank) AS sources, COUNT(*) AS docs_retrieved
              FROM blocks GROUP BY q_id""",
    "prompts": """SELECT q.q_id, q.question, coalesce(c.context, '') AS context,
       'You are a helpful customer support assistant.' || chr(10) ||
       'Answer the question using ONLY the provided context.' || chr(10) ||
       'If the answer is not in the context, say "I don''t have that information."' || chr(10) || chr(10) ||
       'Context:' || chr(10) || coalesce(c.context, '') || chr(10) || chr(10) || 'Question: ' || q.question ||
       chr(10) || chr(10) || 'Answer:' AS prompt,
       coalesce(c.sources, '') AS sources, coalesce(c.docs_retrieved, 0) AS docs_retrieved
FROM questions q LEFT JOIN ctx c USING (q_id)""",
}


def grounded(spark, sf):
    g = RT.grounded_prompts(hybrid_top_k(spark, sf), D.policies(spark, sf), D.questions(spark, sf))
    return g.withColumn("sources", F.array_join("sources", ", "))


@register("n13_n14_f04_grounded_prompts", with_("policies", "questions", extra={**_HYB_ALL, **_PROMPT_SQL}) +
          "SELECT * FROM prompts")
def n13(spark, sf):
    return grounded(spark, sf)


@register("n17_batch_completion", with_("policies", "questions", extra={**_HYB_ALL, **_PROMPT_SQL}) +
          "SELECT q_id, CAST(length(prompt) AS VARCHAR) || ' chars' AS answer FROM prompts")
def n17(spark, sf):
    return RT.complete(grounded(spark, sf), "prompt", prompt_length_stub).select("q_id", "answer")


@register("n15_f05_corpus_context_500", with_("policies") + """
SELECT substr(string_agg(content, ' ' ORDER BY doc_id), 1, 500) AS context FROM policies""")
def n15(spark, sf):
    return RT.corpus_context(D.policies(spark, sf), "doc_id", "content", 500)
