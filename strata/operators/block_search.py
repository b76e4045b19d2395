"""Ranked search of many questions over all documents, in blocks.

Documents and questions are dealt into blocks by a hash; every question block
meets every document block in one task (an explicit pair of block numbers, so
the work is split by both sides and neither passes through the driver). A task
scores its block with numpy and sends on, per question, its best ``k`` and,
for documents whose rank is asked for, how many of its documents come before
them. Pairs of a question and a document are never shuffled.

Two indexes score blocks: ``Lexical`` (BM25 over the questions' vocabulary) and
``Vectors`` (cosine). Scores are rounded, so the order of a sum cannot flip
ties; equal scores are ordered by id.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.text import spread, tokens
from strata.operators.joins import broadcast_if_small

RANK_DIGITS = 9  # scores are ranked after rounding
VALUES_PER_BLOCK, QUESTIONS_PER_BLOCK = 4 << 20, 512  # values: vector components, or words
MARKS = "array<struct<doc:bigint,score:double>>"
FOUND = "q bigint, doc bigint, score double, before bigint"


def _flat(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column, and where each row's begin (and the last ones end). Nulls are empty."""
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy()
    return pc.list_flatten(column).to_numpy(), np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])


class Vectors:
    """Cosine over float vectors of one length; a zero vector scores 0."""

    def __init__(self, docs: DataFrame, questions: DataFrame, id_col: str = "doc_id", vec_col: str = "embedding",
                 q_id: str = "q_id", q_vec: str = "embedding") -> None:
        self.docs = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(vec_col).cast("array<double>").alias("v")).filter("v IS NOT NULL")
        self.questions = questions.select(F.col(q_id).cast("long").alias("q"), F.col(q_vec).cast("array<double>").alias("v")).filter("v IS NOT NULL")
        self.values = F.size("v")  # of a document

    @staticmethod
    def pairs(docs: pa.Table, questions: pa.Table) -> list[float]:
        """The scores of row i of both, for each i."""
        return np.round((Vectors._unit(docs.column("v")) * Vectors._unit(questions.column("v"))).sum(axis=1), RANK_DIGITS).tolist()

    @staticmethod
    def scorer(docs: pa.Table):
        vectors = Vectors._unit(docs.column("v"))
        every = np.arange(docs.num_rows)

        def score(questions: pa.Table):
            units = Vectors._unit(questions.column("v"))
            for lo in range(0, len(units), 64):  # keeps the matrix of scores at 64 x block rows
                for row in np.round(units[lo:lo + 64] @ vectors.T, RANK_DIGITS):
                    yield every, row

        return score

    @staticmethod
    def _unit(column) -> np.ndarray:
        values, ends = _flat(column)
        m = values.astype(np.float64).reshape(len(ends) - 1, -1)
        size = np.linalg.norm(m, axis=1)
        size[size == 0] = np.inf
        return m / size[:, None]


class Lexical:
    """BM25: idf = ln(1 + (N - df + 0.5) / (df + 0.5)), distinct question terms;
    a document without a common term has no score. Only words that some
    question has are indexed, by number; a document's are one row."""

    def __init__(self, corpus: DataFrame, questions: DataFrame, id_col: str = "doc_id", text_col: str = "content",
                 q_id: str = "q_id", q_text: str = "question", k1: float = 1.2, b: float = 0.75) -> None:
        words = questions.select(F.col(q_id).cast("long").alias("q"), F.explode(F.array_distinct(tokens(q_text))).alias("term"))
        # the empty word, which no text has, is number -1: one more of it keeps each document in the join
        vocabulary = (words.select("term").distinct().withColumn("t", F.monotonically_increasing_id())
                      .unionByName(words.sparkSession.createDataFrame([("", -1)], "term string, t long")).checkpoint(eager=True))
        texts = spread(corpus.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text")))
        split = texts.select("doc", tokens("text").alias("words")).select("doc", F.size("words").alias("size"), "words").filter("size > 0")
        # texts are read once; counts per document and word are gathered per document and written
        known = (split.select("doc", "size", F.explode(F.concat("words", F.array(F.lit("")))).alias("term"))
                 .join(broadcast_if_small(vocabulary), "term").groupBy("doc", "size", "t").agg(F.count(F.lit(1)).cast("double").alias("tf"))
                 .groupBy("doc", "size").agg(F.collect_list(F.when(F.col("t") >= 0, F.struct("t", "tf"))).alias("x")).checkpoint(eager=True))
        n, mean = known.agg(F.count(F.lit(1)), F.coalesce(F.avg("size"), F.lit(1.0))).first()  # two numbers
        df = known.select(F.explode("x.t").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df"))
        idf = F.log(1 + (n - F.col("df") + 0.5) / (F.col("df") + 0.5))
        weighed = words.join(vocabulary, "term").join(df, "t").select("q", F.struct("t", idf.alias("idf")).alias("x"))
        self.docs = known.select("doc", (F.lit(k1) * (1 - b + b * F.col("size") / mean)).alias("norm"), F.col("x.t").alias("terms"), F.col("x.tf").alias("counts"))
        self.questions = weighed.groupBy("q").agg(F.array_sort(F.collect_list("x")).alias("x")).select(
            "q", F.col("x.t").alias("terms"), F.col("x.idf").alias("idf"), F.lit(k1 + 1).alias("scale"))
        self.values = F.size("terms")  # of a document

    @staticmethod
    def pairs(docs: pa.Table, questions: pa.Table) -> list[float | None]:
        """The scores of row i of both, for each i; None without a common term."""
        d_terms, d_ends = _flat(docs.column("terms"))
        d_counts, _ = _flat(docs.column("counts"))
        q_terms, q_ends = _flat(questions.column("terms"))
        idf, _ = _flat(questions.column("idf"))
        norm, scale = docs.column("norm").to_numpy(), questions.column("scale").to_numpy()
        out: list[float | None] = []
        for i in range(docs.num_rows):
            part = slice(d_ends[i], d_ends[i + 1])
            counts, total = dict(zip(d_terms[part].tolist(), d_counts[part].tolist())), None
            for t, w in zip(q_terms[q_ends[i]:q_ends[i + 1]].tolist(), idf[q_ends[i]:q_ends[i + 1]]):
                if tf := counts.get(t):
                    total = (total or 0.0) + w * scale[i] * (tf / (tf + norm[i]))
            out.append(None if total is None else round(float(total), RANK_DIGITS))
        return out

    @staticmethod
    def scorer(docs: pa.Table):
        """Postings of the block by term, then per question a sum over its terms, in their order."""
        terms, ends = _flat(docs.column("terms"))
        row = np.repeat(np.arange(docs.num_rows), np.diff(ends))
        counts, _ = _flat(docs.column("counts"))
        order = np.lexsort((row, terms))
        terms, row, counts = terms[order], row[order], counts[order]
        weight = counts / (counts + docs.column("norm").to_numpy()[row])

        def score(questions: pa.Table):
            q_terms, q_ends = _flat(questions.column("terms"))
            idf, _ = _flat(questions.column("idf"))
            scale = questions.column("scale").to_numpy()
            begin, end = np.searchsorted(terms, q_terms, "left"), np.searchsorted(terms, q_terms, "right")
            sums = np.zeros(docs.num_rows)
            for i in range(questions.num_rows):
                touched = []
                for j in range(q_ends[i], q_ends[i + 1]):
                    at = row[begin[j]:end[j]]
                    sums[at] += idf[j] * scale[i] * weight[begin[j]:end[j]]
                    touched.append(at)
                at = np.unique(np.concatenate(touched)) if touched else np.zeros(0, np.int64)
                yield at, np.round(sums[at], RANK_DIGITS)
                sums[at] = 0

        return score


def best_of(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best by score desc, id asc. Every score from the
    k-th largest up is looked at, so ties at the cut are decided exactly."""
    k = min(k, len(ids))
    if not k:
        return np.zeros(0, np.int64)
    at = np.flatnonzero(scores >= -np.partition(-scores, k - 1)[k - 1])
    return at[np.lexsort((ids[at], -scores[at]))][:k]


def before_marks(ids: np.ndarray, scores: np.ndarray, marked: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """Per mark (a document id and its score, best first): how many of the
    other documents rank before it. Binary search; only ties look at ids."""
    lo, hi = np.searchsorted(-marks, -scores, "left"), np.searchsorted(-marks, -scores, "right")
    counts = np.bincount(hi, minlength=len(marks) + 1)[:len(marks)]  # the marks from hi on are worse than the score
    total = np.cumsum(counts)
    for i in np.flatnonzero(lo < hi):  # documents with a mark's score
        total[lo[i]:hi[i]] += ids[i] < marked[lo[i]:hi[i]]
    own = np.flatnonzero(np.isin(ids, marked))
    for i in own:  # a document never counts for itself, whatever the last digit of its score
        j = int(np.flatnonzero(marked == ids[i])[0])
        total[j] -= (scores[i] > marks[j]) or (scores[i] == marks[j] and ids[i] < marked[j])
    return total


def search(index: Lexical | Vectors, k: int, marks: DataFrame | None = None, questions_per_block: int = QUESTIONS_PER_BLOCK) -> DataFrame:
    """Rows ``q, doc, score`` (the ``k`` best per question and pair of blocks) and,
    for ``marks`` (q, doc, score), rows ``q, doc, before`` to be summed up."""
    docs, questions = index.docs, index.questions
    parallel = docs.sparkSession.sparkContext.defaultParallelism
    n_docs, values = docs.agg(F.count(F.lit(1)), F.coalesce(F.sum(index.values), F.lit(0))).first()
    # enough blocks for all cores, if they hold some hundred documents; beyond that by size
    doc_blocks = max(1, min(parallel, n_docs // 256), math.ceil(values / VALUES_PER_BLOCK))
    q_blocks = max(1, math.ceil(questions.count() / questions_per_block))
    if marks is None:
        questions = questions.withColumn("marks", F.lit(None).cast(MARKS))
    else:  # a bounded number of marks per question
        best_first = F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), F.col("doc").alias("doc"))))
        listed = F.transform(best_first, lambda x: F.struct(x["doc"].alias("doc"), (-x["s"]).alias("score")))
        questions = questions.join(marks.groupBy("q").agg(listed.alias("marks")), "q", "left")

    def number(col: str, blocks: int):  # an int on both sides: as long and int, equal numbers would land in different tasks
        return F.pmod(F.xxhash64(F.lit(7), F.col(col)), F.lit(blocks)).cast("int")

    def each(blocks: int):
        return F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))

    dealt_docs = docs.withColumn("db", number("doc", doc_blocks)).withColumn("qb", each(q_blocks))
    dealt_questions = questions.withColumn("qb", number("q", q_blocks)).withColumn("db", each(doc_blocks))
    scorer = type(index).scorer

    def run(d: pa.Table, q: pa.Table) -> pa.Table:
        out: dict[str, list[np.ndarray]] = {"q": [], "doc": [], "score": [], "before": []}

        def add(question: int, ids: np.ndarray, scores: np.ndarray, before: np.ndarray) -> None:
            for name, values in zip(out, (np.full(len(ids), question, np.int64), ids, scores, before)):
                out[name].append(values)

        if d.num_rows and q.num_rows:
            ids, numbers, asked = d.column("doc").to_numpy(), q.column("q").to_numpy(), q.column("marks").to_pylist()
            for i, (at, scores) in enumerate(scorer(d)(q)):
                top = best_of(ids[at], scores, k)
                add(numbers[i], ids[at][top], scores[top], np.full(len(top), -1))
                if asked[i]:
                    marked = np.array([m["doc"] for m in asked[i]], np.int64)
                    before = before_marks(ids[at], scores, marked, np.array([m["score"] for m in asked[i]]))
                    add(numbers[i], marked, np.full(len(marked), np.nan), before)
        return pa.table({n: np.concatenate(v).astype(np.float64 if n == "score" else np.int64) if v else
                         pa.array([], pa.float64() if n == "score" else pa.int64()) for n, v in out.items()})

    return dealt_docs.groupBy("db", "qb").cogroup(dealt_questions.groupBy("db", "qb")).applyInArrow(run, FOUND)


def scores_of(index: Lexical | Vectors, pairs: DataFrame) -> DataFrame:
    """``q, doc, score`` of the given (q, doc) pairs that have one."""
    score = type(index).pairs
    d, q = index.docs, index.questions
    wide = (pairs.select("q", "doc").join(d.select("doc", F.struct(*d.columns).alias("d")), "doc")
            .join(q.select("q", F.struct(*q.columns).alias("x")), "q"))

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            sides = [pa.Table.from_batches([pa.RecordBatch.from_struct_array(batch.column(c))]) for c in ("d", "x")]
            yield pa.RecordBatch.from_arrays([batch.column("q"), batch.column("doc"), pa.array(score(*sides), pa.float64())], names=["q", "doc", "score"])

    return wide.select("q", "doc", "d", "x").mapInArrow(run, "q long, doc long, score double").filter("score IS NOT NULL")


def top_of(found: DataFrame) -> DataFrame:
    return found.filter("before < 0").select("q", "doc", "score")


def ranks_of(found: DataFrame) -> DataFrame:
    """``q, doc, rank`` of the marked documents."""
    return found.filter("before >= 0").groupBy("q", "doc").agg((F.sum("before") + 1).cast("int").alias("rank"))
