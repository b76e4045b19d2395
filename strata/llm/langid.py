"""Language identification by nearest centroid.

A text is the vector of its hashed byte trigrams (lower-cased, over letters
and the gaps between them), weighted by TF-IDF and normalised. Each language
has several centroids, clustered by spherical k-means. The nearest centroid by
cosine names the language; a text whose similarity is below the language's
rejection distance is reported as rejected.

The model is fitted on a bounded sample: ``sample_per_lang`` texts of each
language in expectation, chosen by hash among all different ones that are
allowed; a language with fewer is learned from all of them. Prediction reads whole texts and nothing but texts.

Defined results
* Null texts and texts without a letter: ``und``, score 0, rejected.
* Equal similarities go to the language that sorts first.
* Without any labelled text, every prediction is ``und``.
* Repeated rows are separate rows; an empty table gives no rows; other columns
  are carried along, and ``lang_pred``, ``score`` and ``rejected`` replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import slices, with_fields

DIMS = 4096
UNKNOWN = "und"
MAX_LANGS = 1000  # bounds the model: 16 KB per centroid

# bytes that are no letters become a gap; bytes of other scripts stay
_LETTER = np.array([b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)], dtype=np.uint8)


def trigrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashed trigrams of a text that is not empty, and their counts."""
    codes = _LETTER[np.frombuffer(f" {text.lower()} ".encode(), dtype=np.uint8)]
    gap = codes == 32
    codes = codes[~(gap & np.concatenate([[False], gap[:-1]]))].astype(np.uint32)  # one gap between words
    if len(codes) < 3:
        return np.zeros(0, np.int32), np.zeros(0, np.float32)
    mixed = (codes[:-2] * 65536 + codes[1:-1] * 256 + codes[2:]) * np.uint32(2654435761)
    counts = np.bincount(mixed >> np.uint32(20), minlength=DIMS)
    at = np.nonzero(counts)[0]
    return at.astype(np.int32), counts[at].astype(np.float32)


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


@dataclass
class Model:
    langs: list[str]         # of each centroid
    centroids: np.ndarray    # (n, DIMS), normalised
    idf: np.ndarray
    reject: np.ndarray       # of each centroid: similarity below which a text is far

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        if not text or not self.langs or not has_letter(text):
            return UNKNOWN, 0.0, True
        at, tf = trigrams(text)
        if not len(at):
            return UNKNOWN, 0.0, True
        x = (1 + np.log(tf)) * self.idf[at]
        cosine = self.centroids[:, at] @ (x / max(1e-12, float(np.sqrt(x @ x))))
        best = int(cosine.argmax())
        return self.langs[best], float(min(1.0, max(0.0, cosine[best]))), bool(cosine[best] < self.reject[best])


def _clusters(x: np.ndarray, k: int, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means from evenly spaced rows: centroids and members."""
    centres = x[np.linspace(0, len(x) - 1, min(k, len(x))).astype(int)].copy()
    for _ in range(rounds):
        own = (x @ centres.T).argmax(axis=1)
        for c in range(len(centres)):
            if (own == c).any():
                centres[c] = x[own == c].sum(axis=0)
        centres /= np.maximum(1e-12, np.sqrt((centres**2).sum(axis=1, keepdims=True)))
    return centres, (x @ centres.T).argmax(axis=1)


def fit(labelled: DataFrame, sample_per_lang: int = 800, clusters: int = 4, reject_share: float = 0.005,
        text_col: str = "text", lang_col: str = "lang") -> Model:
    """Fit on rows with a language. ``sample_per_lang`` is the documented
    bound; the languages' different texts are counted over all rows."""
    good = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    # copies share a hash and count once, here as in the sample
    counts = (good.select("lang", F.xxhash64("text").alias("hash")).distinct()
              .groupBy("lang").count().limit(MAX_LANGS + 1).collect())  # one row per language
    if len(counts) > MAX_LANGS:
        raise ValueError("too many languages for a model that travels with the tasks")
    if not counts:
        return Model([], np.zeros((0, DIMS), np.float32), np.zeros(DIMS, np.float32), np.zeros(0))
    # a literal map, so that no text is shuffled to choose the sample
    share = F.create_map(*(F.lit(x) for r in counts for x in (r["lang"], float(1 << 30) * sample_per_lang / r["count"])))
    chosen = (good.withColumn("hash", F.xxhash64("text"))
              .where(F.pmod("hash", F.lit(1 << 30)) < F.element_at(share, F.col("lang"))))

    def features(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                pairs = [trigrams(t) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("lang"), part.column("hash"), pa.array([p[0] for p in pairs], pa.list_(pa.int32())),
                                                  pa.array([p[1] for p in pairs], pa.list_(pa.float32()))], names=["lang", "hash", "at", "tf"])

    # copies share a hash, so a chosen text comes with all its copies: each counts once
    sample = (chosen.mapInArrow(features, "lang string, hash bigint, at array<int>, tf array<float>")
              .groupBy("lang", "hash").agg(F.first("at").alias("at"), F.first("tf").alias("tf")).toArrow()
              .sort_by([("lang", "ascending"), ("hash", "ascending")]))  # the same model whatever order rows came in
    lang = np.array(sample.column("lang").to_pylist(), dtype=object)
    rows = [(np.array(a, np.int32), np.array(t, np.float32)) for a, t in zip(sample.column("at").to_pylist(), sample.column("tf").to_pylist())]
    x = np.zeros((len(rows), DIMS), np.float32)
    for i, (at, tf) in enumerate(rows):
        x[i, at] = 1 + np.log(tf)
    idf = np.log((1 + len(x)) / (1 + (x > 0).sum(axis=0))).astype(np.float32) + 1
    x *= idf
    x /= np.maximum(1e-12, np.sqrt((x**2).sum(axis=1, keepdims=True)))
    langs, centroids, reject = [], [], []
    for name in sorted(set(lang)):
        own = x[lang == name]
        centres, member = _clusters(own, clusters)
        for c, centre in enumerate(centres):
            if (member == c).any():
                langs.append(name)
                centroids.append(centre)
                reject.append(float(np.quantile(own[member == c] @ centre, reject_share)))
    return Model(langs, np.array(centroids, np.float32).reshape(-1, DIMS), idf, np.array(reject))


def identify(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``rejected``."""
    src = docs.drop("lang_pred", "score", "rejected")
    schema = with_fields(src, ("lang_pred", T.StringType()), ("score", T.DoubleType()), ("rejected", T.BooleanType()))
    sent = docs.sparkSession.sparkContext.broadcast(model)  # bounded by MAX_LANGS

    def run(batches):
        for batch in batches:
            for part in slices(batch, text_col):
                langs, scores, far = zip(*map(sent.value.predict, part.column(text_col).to_pylist()))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(far, pa.bool_())], names=schema.names)

    return src.mapInArrow(run, schema)


def in_training(id_col: str = "doc_id") -> Column:
    """Rows the contract lets the model learn from."""
    return F.crc32(F.col(id_col).cast("string")) % 3 != 1
