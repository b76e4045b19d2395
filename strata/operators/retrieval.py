"""Batch retrieval for many questions at once.

* ``bm25_top_k`` and ``vector_top_k``: exact search in blocks of documents and
  questions (``block_search``).
* ``bm25_scores``: the whole list, a row per question and document that share
  a term, for those who need all of it.
* ``hybrid_top_k``: reciprocal-rank fusion of both whole lists; candidates
  from the head of each, then their exact ranks by a counting pass.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.text import ordered_join, spread, tokens
from strata.operators import block_search
from strata.operators.block_search import QUESTIONS_PER_BLOCK, RANK_DIGITS, Lexical, Vectors


def bm25_scores(corpus: DataFrame, questions: DataFrame, id_col: str = "doc_id", text_col: str = "content",
                q_id: str = "q_id", q_text: str = "question", k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """BM25 score of every (question, document) sharing at least one term.

    idf = ln(1 + (N - df + 0.5) / (df + 0.5)); query terms are distinct;
    document ids are unique. Only the questions' vocabulary is indexed.
    Hot terms make the term join skewed; AQE's skew join splits them.
    """
    docs = (spread(corpus.select(id_col, text_col)).select(id_col, tokens(text_col).alias("_tokens"))
            .withColumn("dl", F.size("_tokens")).filter(F.col("dl") > 0))
    stats = docs.agg(F.count(F.lit(1)).alias("n"), F.avg("dl").alias("avgdl"))
    n, avgdl = stats.select("n").scalar(), stats.select("avgdl").scalar()
    qterms = questions.select(q_id, F.explode(F.array_distinct(tokens(q_text))).alias("term"))
    # written once (reliable checkpoint): document frequencies and the scoring join read it
    post = (docs.select(id_col, "dl", F.explode("_tokens").alias("term"))
            .join(qterms.select("term").distinct(), "term", "left_semi")
            .groupBy("term", id_col, "dl").agg(F.count(F.lit(1)).alias("tf")).checkpoint(eager=True))
    df_ = post.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    idf = df_.select("term", F.log(1 + (n - F.col("df") + 0.5) / (F.col("df") + 0.5)).alias("idf"))
    norm = F.col("tf") + F.lit(k1) * (1 - b + b * F.col("dl") / avgdl)
    part = (qterms.join(idf, "term").join(post, "term")
            .select(q_id, id_col, (F.col("idf") * F.col("tf") * (k1 + 1) / norm).alias("s")))
    return part.groupBy(q_id, id_col).agg(F.round(F.sum("s"), RANK_DIGITS).alias("score"))


def rank_top_k(scores: DataFrame, q_id: str, id_col: str, k: int) -> DataFrame:
    """Top-k per question by score desc, id asc; adds a 1-based ``rank``."""
    w = Window.partitionBy(q_id).orderBy(F.col("score").desc(), F.col(id_col).asc())
    return scores.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def ranks_among(scores: DataFrame, wanted: DataFrame, q_id: str, id_col: str) -> DataFrame:
    """Exact (q, doc, rank) in the whole list ``scores`` of the ``wanted``
    (q, doc) pairs that are in it, in one counting pass.

    The wanted documents of a question (a bounded number) cut its list into
    slices; the rank of the j-th is the size of the slices up to it. No task
    sorts or holds a question's list.
    """
    own = scores.join(wanted.select(q_id, id_col), [q_id, id_col])
    marks = own.groupBy(q_id).agg(F.array_sort(F.collect_list(
        F.struct((-F.col("score")).alias("s"), F.col(id_col).alias("d")))).alias("_marks"))

    def before(m):
        return (m["s"] < -F.col("score")) | ((m["s"] == -F.col("score")) & (m["d"] < F.col(id_col)))

    slices = (scores.join(marks, q_id).select(q_id, F.size(F.filter("_marks", before)).alias("_at"))
              .groupBy(q_id, "_at").agg(F.count(F.lit(1)).alias("_n")))
    upto = Window.partitionBy(q_id).orderBy("_at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = slices.select(q_id, "_at", F.sum("_n").over(upto).cast("int").alias("rank"))
    return (marks.select(q_id, F.posexplode("_marks").alias("_at", "_m")).join(ends, [q_id, "_at"])
            .select(q_id, F.col("_m.d").alias(id_col), "rank"))


def _ranked(found: DataFrame, k: int, q_id: str, id_col: str) -> DataFrame:
    return rank_top_k(block_search.top_of(found).select(F.col("q").alias(q_id), F.col("doc").alias(id_col), "score"), q_id, id_col, k)


def vector_top_k(docs: DataFrame, queries: DataFrame, k: int = 3, id_col: str = "doc_id", vec_col: str = "embedding",
                 q_id: str = "q_id", q_vec: str = "embedding", questions_per_block: int = QUESTIONS_PER_BLOCK) -> DataFrame:
    """Exact cosine top-k per query over all document vectors, in blocks of both."""
    index = Vectors(docs, queries, id_col, vec_col, q_id, q_vec)
    return _ranked(block_search.search(index, k, questions_per_block=questions_per_block), k, q_id, id_col)


def bm25_top_k(corpus: DataFrame, questions: DataFrame, k: int = 3, id_col: str = "doc_id", q_id: str = "q_id", **kw) -> DataFrame:
    """Exact BM25 top-k per question, in blocks: no row per question and document."""
    return _ranked(block_search.search(Lexical(corpus, questions, id_col=id_col, q_id=q_id, **kw), k), k, q_id, id_col)


def hybrid_top_k(lexical: DataFrame | Lexical, docs: DataFrame, queries: DataFrame, k: int = 3, c: int = 60,
                 q_id: str = "q_id", id_col: str = "doc_id") -> DataFrame:
    """Top-k of the reciprocal-rank fusion of two whole ranked lists: the
    ``lexical`` one (an index, or scores q_id, id_col, score) and the cosines of ``docs`` to ``queries``.

    Only the first ``depth = c + 2k`` of each list can be among the k best: a
    document beyond it in both scores at most ``2 / (c + depth + 1)``, less
    than the ``1 / (c + k)`` that the first k of either list reach. Those
    candidates get their exact rank in both lists. (The two bounds stay apart
    after rounding for ``c + k`` up to some 10,000.) The lexical blocks are
    scored once, for their best and for the ranks of the vectors' candidates;
    the vectors, which cost less, twice.
    """
    depth, pair = c + 2 * k, ["q", "doc"]
    vectors = Vectors(docs, queries, id_col, q_id=q_id)
    vec = _ranked(block_search.search(vectors, depth), depth, "q", "doc").select(*pair, "rank").checkpoint(eager=True)
    if isinstance(lexical, Lexical):
        found = block_search.search(lexical, depth, block_search.scores_of(lexical, vec)).checkpoint(eager=True)
        lex = _ranked(found, depth, "q", "doc").select(*pair, "rank").checkpoint(eager=True)
        lex_more = block_search.ranks_of(found).join(lex, pair, "left_anti")
    else:
        scores = lexical.select(F.col(q_id).alias("q"), F.col(id_col).alias("doc"), "score").checkpoint(eager=True)
        lex = rank_top_k(scores, "q", "doc", depth).select(*pair, "rank").checkpoint(eager=True)
        lex_more = ranks_among(scores, vec.join(lex, pair, "left_anti"), "q", "doc")
    marks = block_search.scores_of(vectors, lex.join(vec, pair, "left_anti"))
    vec_more = block_search.ranks_of(block_search.search(vectors, 0, marks))
    return rrf_fuse([lex.unionByName(lex_more), vec.unionByName(vec_more)], "q", "doc", k, c).withColumnsRenamed({"q": q_id, "doc": id_col})


def rrf_fuse(ranked: list[DataFrame], q_id: str, id_col: str, k: int = 3, c: int = 60) -> DataFrame:
    """Reciprocal-rank fusion: score = sum over lists of 1 / (c + rank).

    Each input holds (q_id, doc, rank); a document missing from a list
    contributes nothing for it.
    """
    u = None
    for r in ranked:
        x = r.select(q_id, id_col, (F.lit(1.0) / (F.lit(c) + F.col("rank"))).alias("s"))
        u = x if u is None else u.unionByName(x)
    fused = u.groupBy(q_id, id_col).agg(F.round(F.sum("s"), RANK_DIGITS).alias("score"))
    return rank_top_k(fused, q_id, id_col, k)


# Fixed value: the reference's grounded-answer prompt template.
PROMPT_TEMPLATE = (
    "You are a helpful customer support assistant.\n"
    "Answer the question using ONLY the provided context.\n"
    "If the answer is not in the context, say \"I don't have that information.\"\n\n"
    "Context:\n{context}\n\nQuestion: {question}\n\nAnswer:"
)


def grounded_prompts(top: DataFrame, corpus: DataFrame, questions: DataFrame, q_id: str = "q_id",
                     id_col: str = "doc_id", name_col: str = "policy_name", text_col: str = "content",
                     q_text: str = "question") -> DataFrame:
    """Per question, the context ``[name]:\\ncontent`` of its top-k
    documents in rank order joined by blank lines, the prompt, the source
    names and the number of documents retrieved (groups are bounded by k).
    """
    head, rest = PROMPT_TEMPLATE.split("{context}")
    mid, tail = rest.split("{question}")
    docs = top.join(corpus.select(id_col, name_col, text_col), id_col).withColumn(
        "_block", F.concat(F.lit("["), F.col(name_col), F.lit("]:\n"), F.col(text_col)))
    ctx = ordered_join(docs, [q_id], "rank", "_block", "\n\n", "context")
    srcs = (docs.groupBy(q_id).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("rank", name_col))), lambda x: x[name_col]).alias("sources"),
        F.count(F.lit(1)).alias("docs_retrieved")))
    q = questions.select(q_id, q_text)
    # a question with nothing retrieved still gets a record: empty context and sources, 0 documents
    j = q.join(ctx, q_id, "left").join(srcs, q_id, "left")
    context = F.coalesce(F.col("context"), F.lit(""))
    return j.select(
        q_id, F.col(q_text).alias("question"), context.alias("context"),
        F.concat(F.lit(head), context, F.lit(mid), F.col(q_text), F.lit(tail)).alias("prompt"),
        F.coalesce(F.col("sources"), F.array().cast("array<string>")).alias("sources"),
        F.coalesce(F.col("docs_retrieved"), F.lit(0)).cast("long").alias("docs_retrieved"))


def corpus_context(corpus: DataFrame, order_col: str, text_col: str, n_chars: int = 500, sep: str = " ") -> DataFrame:
    """``sep.join(all texts in order)[:n_chars]`` as one row.

    Exact without reading the corpus into one place: only the first
    ``n_chars + 1`` texts can reach the cut (each adds at least its
    separator), and only their first ``n_chars`` characters.
    """
    head = (corpus.filter(F.col(text_col).isNotNull())  # the join skips them, so the limit must too
            .select(order_col, F.substring(text_col, 1, n_chars).alias("_t"))
            .orderBy(order_col).limit(n_chars + 1))
    joined = head.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order_col, "_t"))),
                                               lambda x: x["_t"]), sep).alias("_all"))
    return joined.select(F.substring("_all", 1, n_chars).alias("context"))


def complete(df: DataFrame, prompt_col: str, fn: Callable[[pd.Series], pd.Series], out_col: str = "answer") -> DataFrame:
    """Batch completion through a caller-supplied vectorised function
    (prompts in, answers out), run in Arrow batches on the executors."""
    udf = F.pandas_udf(fn, "string")
    return df.withColumn(out_col, udf(F.col(prompt_col)))
