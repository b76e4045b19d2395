"""Text analytics (N01-N08): lexicon sentiment, keyword rules, closed-label
classification and extractive summaries.

Sentiment and classification are per-row array expressions over the token
list (no explode, no join, no shuffle); the lexicon and keyword lists are
parameters compiled into the plan as literal maps. Summaries need corpus
statistics (document frequency) and therefore a grouped job.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.scalar import first_matching_rule, threshold_label
from strata.functions.text import SENTENCE_SPLIT, ordered_join, spread, token_rows, tokens
from strata.operators.joins import broadcast_if_small

# Terms whose document frequencies are broadcast to score sentences (some 100 MB in an executor)
SUMMARY_TERMS = 1_000_000
SUMMARY_DOCS = 1000  # documents per task

# The reference's ordered keyword rules and label list.
FEEDBACK_RULES = (
    ("shipping", ("shipping", "delivery", "package", "arrived")),
    ("product_quality", ("quality", "product", "purchase", "disappointed")),
    ("customer_service", ("support", "service", "staff", "team")),
)
FEEDBACK_DEFAULT = "general"
CLASSIFY_LABELS = ("shipping", "product_quality", "pricing", "customer_service")

# A small English polarity lexicon of our own (word -> polarity in [-1, 1]).
DEFAULT_LEXICON = {
    "excellent": 1.0, "great": 0.8, "good": 0.7, "love": 0.5, "happy": 0.8, "fast": 0.2, "helpful": 0.6,
    "bad": -0.7, "terrible": -1.0, "poor": -0.4, "slow": -0.3, "broken": -0.4, "disappointed": -0.75,
    "late": -0.3, "rude": -0.6, "worst": -1.0,
}


def _lexicon_map(lexicon: Mapping[str, float]) -> Column:
    kv = []
    for w, p in sorted(lexicon.items()):
        kv += [F.lit(w.lower()), F.lit(p).cast("decimal(6,4)")]
    return F.create_map(*kv)


def sentiment_score(text: str | Column, lexicon: Mapping[str, float] = DEFAULT_LEXICON) -> Column:
    """Mean polarity of the lexicon words in the whole text; 0 when none.

    The mean is a DECIMAL(18,6): polarities are summed exactly, so neither
    the evaluation order nor later rounding (ROUND(score, 2)) depends on
    binary floating point.
    """
    return sentiment_from_tokens(tokens(text), lexicon)


def sentiment_from_tokens(toks: Column, lexicon: Mapping[str, float] = DEFAULT_LEXICON) -> Column:
    """N01 over an already tokenised text (so one tokenisation serves several scores)."""
    m = _lexicon_map(lexicon)
    hits = F.filter(F.transform(toks, lambda t: F.element_at(m, t)), lambda x: x.isNotNull())
    total = F.aggregate(hits, F.lit(0).cast("decimal(18,4)"), lambda acc, x: (acc + x).cast("decimal(18,4)"))
    return (F.when(F.size(hits) == 0, F.lit(0))
            .otherwise(total / F.size(hits)).cast("decimal(18,6)"))


def sentiment_label(score: str | Column, cut: float = 0.1, upper: bool = False) -> Column:
    """Positive / negative / neutral at +-cut (strict); upper-case variant for the report."""
    labels = ("POSITIVE", "NEGATIVE", "NEUTRAL") if upper else ("positive", "negative", "neutral")
    return threshold_label(score, cut, labels)


def keyword_category(text: str | Column, rules=FEEDBACK_RULES, default: str = FEEDBACK_DEFAULT) -> Column:
    """First rule whose any keyword is a substring of the lower-cased text."""
    return first_matching_rule(text, rules, default)


def classify(text: str | Column, label_keywords: Mapping[str, Sequence[str]],
             labels: Sequence[str] = CLASSIFY_LABELS) -> Column:
    """Closed-label classification -> struct(label, score).

    Score of a label = number of text tokens that are one of its keywords;
    the best score wins and label order breaks ties (so a text with no hit
    gets the first label, as a classifier always answers).
    """
    return classify_tokens(tokens(text), label_keywords, labels)


def classify_tokens(toks: Column, label_keywords: Mapping[str, Sequence[str]],
                    labels: Sequence[str] = CLASSIFY_LABELS) -> Column:
    """N04 over an already tokenised text."""
    cands = []
    for i, lab in enumerate(labels):
        kws = [k.lower() for k in label_keywords.get(lab, ())]
        hits = F.size(F.filter(toks, lambda t: t.isin(*kws))) if kws else F.lit(0)
        cands.append(F.struct(hits.alias("score"), F.lit(-i).alias("neg_order"), F.lit(lab).alias("label")))
    best = F.array_max(F.array(*cands))
    return F.struct(best["label"].alias("label"), best["score"].alias("score"))


def feedback_analysis(feedback: DataFrame, lexicon=DEFAULT_LEXICON, rules=FEEDBACK_RULES,
                      id_col: str = "feedback_id", text_col: str = "feedback_text") -> DataFrame:
    """Id, sentiment label, sentiment score, category — one pass over the texts."""
    s = spread(feedback.select(id_col, text_col)).select(
        id_col, sentiment_score(text_col, lexicon).alias("sentiment_score"),
                        keyword_category(text_col, rules).alias("category"))
    return s.select(id_col, sentiment_label("sentiment_score").alias("sentiment_label"), "sentiment_score",
                    "category")


def report_metrics(feedback: DataFrame, lexicon=DEFAULT_LEXICON, cut: float = 0.3,
                   text_col: str = "feedback_text") -> DataFrame:
    """Total, positive, negative and rounded mean, scoring each text once."""
    s = spread(feedback.select(text_col)).select(sentiment_score(text_col, lexicon).alias("s"))
    return s.agg(F.count(F.lit(1)).alias("total"),
                 F.sum(F.when(F.col("s") > cut, 1).otherwise(0)).alias("positive"),
                 F.sum(F.when(F.col("s") < -cut, 1).otherwise(0)).alias("negative"),
                 F.round((F.sum("s") / F.count("s")).cast("decimal(38,6)"), 2).cast("double").alias("avg_score"))


def report_prompt(metrics: DataFrame) -> DataFrame:
    """The executive-summary prompt built from N07's single row."""
    # Fixed value: the reference's report prompt template.
    return metrics.select(F.concat(
        F.lit("Write a 3-sentence executive summary. Total: "), F.col("total").cast("string"),
        F.lit(", Positive: "), F.col("positive").cast("string"),
        F.lit(", Negative: "), F.col("negative").cast("string"),
        F.lit(", Avg sentiment: "), F.col("avg_score").cast("string"),
        F.lit(". Be specific and actionable.")).alias("prompt"))


def summarize(docs: DataFrame, id_col: str, text_col: str, k: int = 2) -> DataFrame:
    """Extractive summary — the ``k`` sentences with the highest mean
    TF-IDF of their tokens, in their original order, joined by a space.

    TF is the term count in the whole document, IDF = ln(N / df). Texts are
    dealt by document once, and all that belongs to one document is worked out
    where its text is; only the terms' document frequencies go elsewhere. If
    they are too many for a broadcast, a row per document and term goes to
    them. Rows without an id count in the frequencies, as one document.
    """
    n_docs = docs.count()
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    # a number of partitions by documents: merged ones would spill the tokens' sorts
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n_docs // SUMMARY_DOCS))
    dealt = texts.filter("_id IS NOT NULL").repartition(parts, "_id")
    tf = (token_rows(_sentences(dealt), "sentence", ["_id", "pos"]).groupBy("_id", "term")
          .agg(F.count(F.lit(1)).alias("tf"), F.collect_list("pos").alias("at")))
    without_id = token_rows(_sentences(spread(texts.filter("_id IS NULL"))), "sentence", []).distinct()
    df_ = (tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
           .unionByName(without_id.select("term", F.lit(1).cast("long").alias("df")))
           .groupBy("term").agg(F.sum("df").alias("df")).checkpoint(eager=True))
    w = tf.join(broadcast_if_small(df_, SUMMARY_TERMS), "term").select(
        "_id", "at", (F.col("tf") * F.log(F.lit(n_docs) / F.col("df"))).alias("w"))
    sc = (w.select("_id", F.explode("at").alias("pos"), "w").groupBy("_id", "pos")
          .agg(F.round(F.avg("w"), 9).alias("score")))
    top = (sc.withColumn("r", F.row_number().over(
        Window.partitionBy("_id").orderBy(F.col("score").desc(), F.col("pos").asc())))
           .filter(F.col("r") <= k).groupBy("_id").agg(F.collect_list("pos").alias("_top")))
    chosen = _sentences(dealt.join(top, "_id"), "_top").filter(F.array_contains("_top", F.col("pos")))
    # every text has a summary: one without tokens has an empty one
    summary = ordered_join(chosen, ["_id"], "pos", "sentence", " ", "summary")
    return (docs.select(id_col).join(summary, F.col(id_col) == F.col("_id"), "left")
            .select(id_col, F.coalesce("summary", F.lit("")).alias("summary")))


def _sentences(texts: DataFrame, *keep: str) -> DataFrame:
    """``_id, pos, sentence`` of rows ``_id, _text``, and the columns to ``keep``."""
    return (texts.select("_id", *keep, F.posexplode(F.split("_text", SENTENCE_SPLIT)).alias("pos", "sentence"))
            .withColumn("sentence", F.trim(F.col("sentence"), F.lit(" "))).filter(F.length("sentence") > 0))
