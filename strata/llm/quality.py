"""Quality classifier by attention-based multiple-instance learning.

A document is a bag of passages of ``WORDS`` words. Every passage of the whole
text is encoded (shares of byte classes and of single marks, word lengths,
distinct and repeated words, words that end in a mark, words in capitals, sizes;
no feature sees which words or character pairs there are) and passed through one hidden layer. Gated attention
weighs the passages, with weights learned from document labels alone, and a
logistic unit scores the weighted representation.

The model is fitted on at most ``max_labelled`` documents (in expectation,
chosen by hash of the id), each with every passage; rows that share an id and
texts that are copies of each other count once. Scoring reads every passage.

Defined results
* Null and blank texts are one passage without words and are scored like any other.
* Without two different labels to learn from, every score is the share of label 1 (1 if none).
* Repeated rows are separate rows; an empty table gives no rows. Other columns
  are carried along, and ``score`` and ``predicted`` replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import slices, with_fields

WORDS = 64
THRESHOLD = 0.3

# classes of bytes: blank, line end, lower, upper, digit, other scripts, then marks one by one
_MARKS = b".,;:!?|#$%&*@/\\<>()[]{}=+-_'\""
_CLASS = np.zeros(256, dtype=np.int64)
_CLASS[list(range(128, 256))] = 5
_CLASS[ord("\n")] = 1
for _low, _high, _kind in ((97, 122, 2), (65, 90, 3), (48, 57, 4)):
    _CLASS[_low:_high + 1] = _kind
for _i, _b in enumerate(_MARKS):
    _CLASS[_b] = 6 + _i
N_CLASSES = 6 + len(_MARKS)
_BLANK = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
N_FEATURES = N_CLASSES + 8


def passages(text: str | None) -> np.ndarray:
    """Features of all passages, one row each."""
    data = (text or "").encode()
    codes = np.frombuffer(data, dtype=np.uint8)
    blank = _BLANK[codes]
    starts = np.nonzero(~blank & np.concatenate([[True], blank[:-1]]))[0] if len(codes) else np.zeros(0, np.int64)
    n_words = len(starts)
    n = max(1, -(-n_words // WORDS))
    out = np.zeros((n, N_FEATURES), dtype=np.float32)
    if not n_words:
        out[0, N_CLASSES] = 1
        return out
    edges = starts[::WORDS].copy()
    edges[0] = 0
    sizes = np.diff(np.append(edges, len(codes)))
    owner = np.repeat(np.arange(n), sizes)
    counts = np.bincount(owner * N_CLASSES + _CLASS[codes], minlength=n * N_CLASSES).reshape(n, N_CLASSES)
    out[:, :N_CLASSES] = np.sqrt(counts / np.maximum(1, sizes)[:, None])
    words = data.split()
    counted = np.full(n, WORDS)
    counted[-1] = n_words - WORDS * (n - 1)
    distinct = np.array([len(set(words[i:i + WORDS])) for i in range(0, n_words, WORDS)])
    same = np.fromiter((a == b for a, b in zip(words, words[1:])), dtype=bool, count=n_words - 1)
    again = np.bincount(np.arange(1, n_words)[same] // WORDS, minlength=n)
    marked = np.bincount(np.arange(n_words) // WORDS, weights=[w[-1:] in b"!#$%&*|" and len(w) > 0 for w in words], minlength=n)
    capital = np.bincount(np.arange(n_words) // WORDS, weights=[w.isupper() and len(w) > 1 for w in words], minlength=n)
    out[:, N_CLASSES + 1] = distinct / counted
    out[:, N_CLASSES + 2] = again / counted
    out[:, N_CLASSES + 3] = marked / counted
    out[:, N_CLASSES + 4] = capital / counted
    out[:, N_CLASSES + 5] = np.log1p(sizes / counted)
    out[:, N_CLASSES + 6] = np.log1p(counted) / 4
    out[:, N_CLASSES + 7] = np.log1p(n_words) / 8
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Model:
    """``h = tanh(xW + b)``; attention ``softmax(w (tanh(hV) * sigmoid(hU)))``
    over a bag; score ``sigmoid(c z + d)`` of the weighted sum ``z``."""

    mean: np.ndarray
    scale: np.ndarray
    p: dict[str, np.ndarray]
    share: float = 1.0  # of label 1, if there was nothing to learn

    def scores(self, bags: list[np.ndarray]) -> np.ndarray:
        if not self.p:
            return np.full(len(bags), self.share)
        x, starts = np.concatenate(bags), np.cumsum([0, *map(len, bags)])[:-1]
        return _forward(self.p, (x - self.mean) / self.scale, starts)["y"]


def _forward(p: dict, x: np.ndarray, starts: np.ndarray) -> dict:
    h = np.tanh(x @ p["W"] + p["b"])
    v, u = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
    e = (v * u) @ p["w"]
    sizes = np.diff(np.append(starts, len(x)))
    owner = np.repeat(np.arange(len(starts)), sizes)
    e = np.exp(e - np.maximum.reduceat(e, starts)[owner])
    a = e / np.add.reduceat(e, starts)[owner]
    z = np.add.reduceat(a[:, None] * h, starts, axis=0)
    return {"h": h, "v": v, "u": u, "a": a, "z": z, "owner": owner, "y": _sigmoid(z @ p["c"] + p["d"])}


def _gradients(p: dict, x: np.ndarray, f: dict, starts: np.ndarray, error: np.ndarray) -> dict:
    """Of the summed log loss; ``error`` is weight times (y - label)."""
    dz = error[:, None] * p["c"]
    dzp = dz[f["owner"]]
    da = (dzp * f["h"]).sum(axis=1)
    de = f["a"] * (da - np.add.reduceat(f["a"] * da, starts)[f["owner"]])
    dv = de[:, None] * p["w"] * f["u"] * (1 - f["v"] ** 2)
    du = de[:, None] * p["w"] * f["v"] * f["u"] * (1 - f["u"])
    dh = (f["a"][:, None] * dzp + dv @ p["V"].T + du @ p["U"].T) * (1 - f["h"] ** 2)
    return {"W": x.T @ dh, "b": dh.sum(axis=0), "V": f["h"].T @ dv, "U": f["h"].T @ du, "w": (f["v"] * f["u"]).T @ de,
            "c": f["z"].T @ error, "d": error.sum()}


def train(bags: list[np.ndarray], labels: np.ndarray, hidden: int = 24, attention: int = 12, epochs: int = 40, seed: int = 7) -> Model:
    """Adam on mini-batches of bags; the classes weigh the same in total, so
    that 0.3 is a cautious threshold for dropping a document."""
    y = labels.astype(np.float64)
    if len(set(y.tolist())) < 2:
        return Model(np.zeros(1), np.ones(1), {}, float(y.mean()) if len(y) else 1.0)
    rng, every = np.random.default_rng(seed), np.concatenate(bags).astype(np.float64)
    mean, scale = every.mean(axis=0), every.std(axis=0) + 1e-3
    xs = [(b - mean) / scale for b in bags]
    p = {"W": rng.normal(0, every.shape[1] ** -0.5, (every.shape[1], hidden)), "b": np.zeros(hidden), "V": rng.normal(0, hidden**-0.5, (hidden, attention)),
         "U": rng.normal(0, hidden**-0.5, (hidden, attention)), "w": rng.normal(0, attention**-0.5, attention), "c": rng.normal(0, hidden**-0.5, hidden), "d": np.zeros(())}
    m, s = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
    weight = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(xs))
        for at in range(0, len(order), 64):
            who = order[at:at + 64]
            x, starts = np.concatenate([xs[i] for i in who]), np.cumsum([0, *(len(xs[i]) for i in who)])[:-1]
            f = _forward(p, x, starts)
            g = _gradients(p, x, f, starts, weight[who] * (f["y"] - y[who]) / len(who))
            step += 1
            for k in p:
                d = g[k] + 1e-4 * p[k]
                m[k], s[k] = 0.9 * m[k] + 0.1 * d, 0.999 * s[k] + 0.001 * d * d
                p[k] = p[k] - 0.005 * (m[k] / (1 - 0.9**step)) / (np.sqrt(s[k] / (1 - 0.999**step)) + 1e-8)
    return Model(mean, scale, p)


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = 4000, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Fit on labelled rows outside the held-out fold. Per label, at most
    ``max_labelled / 2`` documents in expectation are taken."""
    known = (labels.where(F.col("quality").isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(id_col))
             .groupBy(id_col).agg(F.max("quality").alias("label"), F.min("quality").alias("least"))
             .where(F.col("label") == F.col("least")).select(F.col(id_col).alias("i"), "label"))
    share = known.groupBy("label").count().select(F.col("label").alias("l"), (F.lit(float(1 << 30)) * (max_labelled / 2) / F.col("count")).alias("share"))
    chosen = known.join(F.broadcast(share), F.col("label") == F.col("l")).where(F.pmod(F.xxhash64("i"), F.lit(1 << 30)) < F.col("share")).select("i", "label")
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), F.col("id") == F.col("i"))
    texts = (texts.groupBy("id", "label").agg(F.min("text").alias("text"))  # an id may come with several rows, a text with several ids
             .groupBy("label", F.xxhash64("text").alias("hash")).agg(F.min(F.struct("id", "text")).alias("one")).select("one.id", "label", "one.text"))

    def features(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                bags = [passages(t).ravel() for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("label"), pa.array(bags, pa.list_(pa.float32()))], names=["id", "label", "bag"])

    schema = T.StructType([texts.schema["id"], texts.schema["label"], T.StructField("bag", T.ArrayType(T.FloatType()))])
    sample = texts.mapInArrow(features, schema).toArrow().sort_by([("id", "ascending")])  # the same model whatever order rows came in
    ends = np.cumsum(pc.list_value_length(sample.column("bag")).to_numpy())
    bags = [b.reshape(-1, N_FEATURES) for b in np.split(pc.list_flatten(sample.column("bag")).to_numpy(), ends[:-1])] if len(ends) else []
    return train(bags, sample.column("label").to_numpy())


def held_out(id_col: str = "doc_id"):
    """Rows the contract keeps from training."""
    return F.crc32(F.col(id_col).cast("string")) % 5 == 0


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (0 or 1)."""
    src = docs.drop("score", "predicted")
    schema = with_fields(src, ("score", T.DoubleType()), ("predicted", T.IntegerType()))

    def run(batches):
        for batch in batches:
            for part in slices(batch, text_col):
                found = model.scores([passages(t) for t in part.column(text_col).to_pylist()])
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found, pa.float64()), pa.array((found >= THRESHOLD).astype(np.int32))], names=schema.names)

    return src.mapInArrow(run, schema)


def keep_good(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the model doesn't reject, as they are."""
    src = docs.select(F.struct(*docs.columns).alias("row"), F.col(text_col).alias("text"))
    return score(src, model).where("predicted = 1").select("row.*")
