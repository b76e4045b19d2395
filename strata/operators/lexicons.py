"""Word lists learned from marked documents, and scoring with them.

``operators.text`` scores with lists that the caller writes down. Here the
lists are tables that Spark learns: one grouped count of the marked
documents' different words, then a test per word. The lists hold every word
that passes, however many, so scoring joins them by word; a list is
broadcast only after its size is checked.

Nulls, empty texts and rows that repeat: a document without text has no
words, scores 0 and takes the first label. An id marked several times has its
greatest mark. Rows of one id are read as one text when scored. Empty tables
give an empty list, and every text then scores 0.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.text import spread, token_rows, tokens
from strata.operators.joins import broadcast_if_small
from strata.session import checkpoint_root


def _label_counts(docs: DataFrame, marks: DataFrame, labels: Sequence, label_col: str, id_col: str,
                  text_col: str) -> tuple[DataFrame, Column]:
    """Per word the marked documents that hold it (``n``) and those of each
    label (``k0``, ``k1``, ...); the same of all words as a scalar struct."""
    mark = (marks.filter(F.col(label_col).isin(*labels)).groupBy(F.col(id_col).alias("_mark_id"))
            .agg(F.max(label_col).alias("_y")))
    # spread before the join: asking a joined frame for its partitions would shuffle the texts once more
    marked = (spread(docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")))
              .join(broadcast_if_small(mark), F.col("_id") == F.col("_mark_id")).select("_y", "_text"))
    counts = [F.count(F.lit(1)).alias("n"),
              *(F.count_if(F.col("_y") == label).alias(f"k{i}") for i, label in enumerate(labels))]
    # counts of all documents as one struct, so that one subquery serves every expression
    total = marked.agg(*counts).select(F.struct("n", *(f"k{i}" for i in range(len(labels))))).scalar()
    words = marked.select("_y", F.explode(F.array_distinct(tokens("_text"))).alias("term"))
    return words.groupBy("term").agg(*counts), total


def _surprising(n: Column, k: Column, rate: Column, z: float) -> Column:
    """|k - n rate| is at least z standard deviations of a binomial count."""
    off = k.cast("double") - n.cast("double") * rate
    return off * off >= F.lit(float(z * z)) * n.cast("double") * rate * (F.lit(1.0) - rate)


def polarity_words(docs: DataFrame, marks: DataFrame, label_col: str, positive=0, negative=1, *, min_docs: int = 5,
                   z: float = 6.0, shrink: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Words with their polarity in [-1, 1], learned from marked documents.

    With ``p`` and ``q`` the shares of the positive and of the negative
    documents that hold the word, its polarity is ``(p - q) / (p + q)``, drawn
    towards 0 for rare words by ``n / (n + shrink)`` and cut to four places.
    A word counts if at least ``min_docs`` documents hold it and its split
    between the marks is at least ``z`` standard deviations from chance.
    """
    words, total = _label_counts(docs, marks, (positive, negative), label_col, id_col, text_col)
    good = F.col("k0").cast("double") * total["k1"].cast("double")
    bad = F.col("k1").cast("double") * total["k0"].cast("double")
    n = F.col("n").cast("double")
    size = F.floor(F.lit(10000.0) * F.abs(good - bad) * n / ((good + bad) * (n + F.lit(float(shrink)))))
    rate = total["k1"].cast("double") / total["n"].cast("double")
    # with one mark only nothing tells the words apart
    return (words.filter((F.col("n") >= min_docs) & (good + bad > 0) & _surprising(F.col("n"), F.col("k1"), rate, z))
            .select("term", F.col("k0").alias("docs_positive"), F.col("k1").alias("docs_negative"),
                    (F.when(good < bad, -size).otherwise(size) / F.lit(10000)).cast("decimal(6,4)").alias("polarity"))
            .filter(F.col("polarity") != 0))


def label_words(docs: DataFrame, marks: DataFrame, labels: Sequence[str], label_col: str, *, min_docs: int = 5,
                z: float = 6.0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Words that tell each label of a closed list, learned from marked documents.

    A word tells a label if at least ``min_docs`` documents hold it and those
    of the label are at least ``z`` standard deviations more than chance.
    """
    words, total = _label_counts(docs, marks, labels, label_col, id_col, text_col)
    cells = [F.struct(F.lit(label).alias("label"), F.col(f"k{i}").alias("k"), total[f"k{i}"].alias("all"))
             for i, label in enumerate(labels)]
    rate = F.col("c.all").cast("double") / total["n"].cast("double")
    return (words.filter(F.col("n") >= min_docs).select("term", "n", F.explode(F.array(*cells)).alias("c"))
            .filter((F.col("c.k").cast("double") > F.col("n").cast("double") * rate)
                    & _surprising(F.col("n"), F.col("c.k"), rate, z))
            .select("term", F.col("c.label").alias("label"), F.col("n").alias("docs"), F.col("c.k").alias("docs_label")))


def kept(words: DataFrame) -> DataFrame:
    """The list learned once and stored, so that its size check and every use read it back."""
    checkpoint_root(words.sparkSession)
    return words.checkpoint()


def _hits(docs: DataFrame, words: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per occurrence of a listed word, with the list's columns and the text's ``_id``."""
    texts = spread(docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")))
    return token_rows(texts, "_text", ["_id"], "_term").join(broadcast_if_small(words), F.col("_term") == F.col("term"))


def sentiment_by_words(docs: DataFrame, lexicon: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """N01 with a table of words: mean polarity of all occurrences; 0 when there are none."""
    score = (_hits(docs, lexicon, id_col, text_col).groupBy("_id")
             .agg((F.sum("polarity").cast("decimal(18,4)") / F.count(F.lit(1))).cast("decimal(18,6)").alias("_score")))
    return (docs.select(id_col).join(score, F.col(id_col).eqNullSafe(F.col("_id")), "left")
            .select(id_col, F.coalesce("_score", F.lit(0).cast("decimal(18,6)")).alias("sentiment_score")))


def classify_by_words(docs: DataFrame, words: DataFrame, labels: Sequence[str], id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """N04 with a table of words: the label with most occurrences of its words,
    ties to the label listed first; without any the first label, score 0."""
    place = F.array_position(F.array(*(F.lit(x) for x in labels)), F.col("label"))
    count = _hits(docs, words, id_col, text_col).groupBy("_id", "label").agg(F.count(F.lit(1)).alias("_n"))
    best = count.groupBy("_id").agg(F.max(F.struct(F.col("_n"), (-place).alias("_order"), F.col("label"))).alias("_best"))
    return (docs.select(id_col).join(best, F.col(id_col).eqNullSafe(F.col("_id")), "left")
            .select(id_col, F.coalesce("_best.label", F.lit(labels[0])).alias("label"),
                    F.coalesce("_best._n", F.lit(0)).cast("long").alias("score")))
