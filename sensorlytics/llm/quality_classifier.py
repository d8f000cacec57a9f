"""Quality classifier by positive-unlabelled learning.

Trusted positives are documents labelled good; all documents without a label are unlabelled web text.
Each text becomes a row of shares and ratios (character kinds, repetition, word and line shape), each
cut into quantile bins; the model is a sum of bin weights. The share of good documents among the
unlabelled (the class prior) is estimated by the best bin: a classifier of positives against
unlabelled ranks both, and over the top of that ranking the ratio of their frequencies is smallest
where nearly all unlabelled are good. The weights then minimise the non-negative unbiased risk
``prior * E_p[l(g)] + max(0, E_u[l(-g)] - prior * E_p[l(-g)])`` with the logistic loss, by full-batch
gradient steps; where the second part turns negative its gradient is reversed.

All unlabelled rows outside the held-out fold take part: they are dealt by a hash of the id into groups of about
``UNLABELLED`` rows, each group is fitted against the same positives, and weights and priors are averaged. The
bins are quantiles over all of these rows. Positives are a bounded sample of the labelled rows (``POSITIVES``, those
below a threshold on a hash of the id). Documents labelled bad are not used. Scoring reads every document whole.

Null and empty texts have all features 0 and are scored like any text. Labels that are null are no
labels, and an id labelled both ways is not a trusted positive. Without positives or unlabelled rows
every score is 0.5. Rows of one id and text train once and get equal scores; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlytics.llm.common import fold, frozen, small_batches, table, utf8

POSITIVES, UNLABELLED, HELD_OUT = 20_000, 40_000, 1
BINS, STEPS, RATE, RIDGE = 24, 250, 0.08, 2e-4

_KINDS = {"upper": range(65, 91), "lower": range(97, 123), "digit": range(48, 58), "blank": (32, 9), "line": (10,),
          "stop": b".,;:", "shout": b"!?", "symbol": b"#*$%&|<>@_=+~^/\\{}[]", "high": range(128, 256)}
_KIND_OF = np.full(256, len(_KINDS), np.int64)
for _k, _bytes in enumerate(_KINDS.values()):
    _KIND_OF[list(_bytes)] = _k
FEATURES = [*(f"share_{k}" for k in _KINDS), "log_words", "distinct", "top_word", "same_as_last", "pairs_distinct",
            "word_length", "long_words", "short_words", "words_with_symbol", "line_words", "line_distinct", "bare_words",
            "stop_words", "upper_words", "tail_distinct"]


def features(text: bytes) -> list[float]:
    """The features of one text."""
    if not text:
        return [0.0] * len(FEATURES)
    kinds = np.zeros(len(_KINDS) + 1, np.int64)
    for at in range(0, len(text), 1 << 22):
        kinds += np.bincount(_KIND_OF[np.frombuffer(text, np.uint8, min(1 << 22, len(text) - at), at)], minlength=len(kinds))
    shares = (kinds[:-1] / len(text)).tolist()
    words = text.split()
    n = len(words)
    if not n:
        return shares + [0.0] * (len(FEATURES) - len(shares))
    count = Counter(words)
    sizes = np.fromiter(map(len, words), np.int64, n)
    lines = [x for x in text.split(b"\n") if x.strip()]
    half = words[n // 2:]
    return shares + [
        math.log(n), len(count) / n, max(count.values()) / n, sum(map(bytes.__eq__, words[1:], words)) / n,
        len(set(zip(words, words[1:]))) / n, float(sizes.mean()), float((sizes > 20).mean()), float((sizes < 2).mean()),
        sum(c for w, c in count.items() if w[-1] in b"#*$%&|!") / n, n / len(lines), len(set(lines)) / len(lines),
        sum(c for w, c in count.items() if not w.isalnum()) / n, sum(c for w, c in count.items() if w[-1] in b".,") / n,
        sum(c for w, c in count.items() if w.isupper()) / n, len(set(half)) / max(1, len(half))]


def feature_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, features, text_key) of all documents; the only pass over the texts. ``text_key`` (xxhash64) tells
    rows without an id, or with the same, apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            x = np.array([features(t) for t in utf8(batch.column(1))], np.float32)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.FixedSizeListArray.from_arrays(
                pa.array(x.ravel(), pa.float32()), len(FEATURES)).cast(pa.list_(pa.float32())), batch.column(2)],
                names=["id", "x", "text_key"])

    text = F.col(text_col).cast("string")
    return frozen(docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"),
                              F.xxhash64(F.coalesce(text, F.lit(""))).alias("text_key"))
                  .mapInArrow(run, "id long, x array<float>, text_key long"), "quality-features")


class Model:
    """A sum of bin weights, with its class prior."""

    def __init__(self, edges: list[np.ndarray]):
        self.edges = edges
        self.base = np.cumsum([0, *(len(e) + 1 for e in edges)])
        self.weights, self.bias, self.prior = np.zeros(self.base[-1]), 0.0, 0.5

    def cells(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, i], "right") + self.base[i] for i, e in enumerate(self.edges)], 1)

    def raw(self, cells: np.ndarray) -> np.ndarray:
        return self.weights[cells].sum(1) + self.bias

    def score(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.raw(self.cells(x)))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _descend(model: Model, cells: np.ndarray, gradient, steps: int = STEPS) -> None:
    """Adam on the bin weights; ``gradient(raw)`` is the derivative of the risk by each row's output."""
    m, v = np.zeros(len(model.weights) + 1), np.zeros(len(model.weights) + 1)
    flat, width = cells.ravel(), cells.shape[1]
    for t in range(1, steps + 1):
        d = gradient(model.raw(cells))
        g = np.r_[np.bincount(flat, np.repeat(d, width), len(model.weights)) + RIDGE * model.weights, d.sum()]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = RATE * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
        model.weights -= step[:-1]
        model.bias -= step[-1]


def estimate_prior(ranked_p: np.ndarray, ranked_u: np.ndarray) -> float:
    """Best-bin estimate: the smallest ratio of the shares of unlabelled and positive rows above a cut,
    with a margin for the cut's few rows."""
    cuts = np.quantile(ranked_p, np.linspace(0, 0.99, 200))
    q_p = np.array([(ranked_p >= c).mean() for c in cuts])
    q_u = np.array([(ranked_u >= c).mean() for c in cuts])
    margin = np.sqrt(math.log(400) / 2) * (len(ranked_u)**-0.5 + len(ranked_p)**-0.5)
    best = np.argmin((q_u + margin) / q_p)
    return float(np.clip(q_u[best] / q_p[best], 0.02, 0.98))


def fit(x_p: np.ndarray, x_u: np.ndarray, edges: list[np.ndarray] | None = None) -> Model | None:
    """The model of positives and unlabelled rows; without ``edges`` the bins are their quantiles."""
    if not len(x_p) or not len(x_u):
        return None
    both = np.concatenate([x_p, x_u])
    if edges is None:
        edges = [np.unique(np.quantile(both[:, i], np.linspace(0, 1, BINS + 1)[1:-1])) for i in range(both.shape[1])]

    def grad_pu(z, n_p=len(x_p), n_u=len(x_u)):  # positives against unlabelled
        d = _sigmoid(z)
        return np.r_[(d[:n_p] - 1) / (2 * n_p), d[n_p:] / (2 * n_u)]

    # the prior: train on one half, rank the other
    a_p, a_u = x_p[::2], x_u[::2]
    ranker = Model(edges)
    _descend(ranker, ranker.cells(np.concatenate([a_p, a_u])), lambda z: grad_pu(z, len(a_p), len(a_u)), STEPS // 2)
    prior = estimate_prior(ranker.score(x_p[1::2]) if len(x_p) > 1 else ranker.score(x_p),
                           ranker.score(x_u[1::2]) if len(x_u) > 1 else ranker.score(x_u))
    model = Model(edges)
    model.prior, n_p, n_u = prior, len(x_p), len(x_u)

    def grad_nn(z):
        s = _sigmoid(z)
        loss_neg = np.logaddexp(0, z)  # l(-g)
        negative_part = loss_neg[n_p:].mean() - prior * loss_neg[:n_p].mean()
        sign = 1.0 if negative_part >= 0 else -1.0
        positive = prior * (s[:n_p] - 1) / n_p if sign > 0 else np.zeros(n_p)
        return np.r_[positive - sign * prior * s[:n_p] / n_p, sign * s[n_p:] / n_u]

    _descend(model, model.cells(both), grad_nn)
    return model


def train(rows: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> Model | None:
    """Fit on a feature table: all unlabelled rows, in groups, against one sample of positives."""
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(
        F.col(id_col).cast("long").alias("id")).agg(F.min(F.col(label_col)).cast("int").alias("y"))
    open_rows = rows.where(F.col("id").isNotNull() & (fold(F.col("id"), 3) != HELD_OUT)).dropDuplicates(["id", "text_key"])
    marked = frozen(open_rows.join(known, "id", "left").where("y = 1 OR y IS NULL").select(
        "id", "text_key", "x", (F.col("y") == 1).alias("good")), "quality-training")
    sizes = marked.agg(F.count_if("good").alias("p"), F.count_if(F.col("good").isNull()).alias("u")).first()
    if not sizes["p"] or not sizes["u"]:
        return None
    probs = np.linspace(0, 1, BINS + 1)[1:-1].tolist()
    cuts = marked.agg(*(F.percentile_approx(F.col("x")[i], probs, 2000).alias(f) for i, f in enumerate(FEATURES))).first()
    edges = [np.unique(np.array(cuts[f], np.float32)) for f in FEATURES]

    below = min(POSITIVES, sizes["p"]) * (2**64 - 1) // sizes["p"] - 2**63  # a share of all hashes: tasks send only what stays
    got = marked.where(F.col("good") & (F.xxhash64("id", F.lit(9)) <= F.lit(below))).select("id", "text_key", "x").toPandas()
    got = got.sort_values(["id", "text_key"])
    if not len(got):
        return None
    positives = rows.sparkSession.sparkContext.broadcast(np.array(got["x"].tolist(), np.float32).reshape(-1, len(FEATURES)))

    def fit_group(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["id", "text_key"])  # one order under retries
        model = fit(positives.value, np.array(group["x"].tolist(), np.float32).reshape(-1, len(FEATURES)), edges)
        values = [*model.weights, model.bias, model.prior]
        return pd.DataFrame({"grp": key[0], "at": range(len(values)), "value": values})

    groups = -(-sizes["u"] // UNLABELLED)
    fitted = frozen(marked.where("good IS NULL").select(
        "id", "text_key", "x", F.pmod(F.xxhash64("id", "text_key", F.lit(7)), F.lit(groups)).alias("grp")).groupBy("grp").applyInPandas(
        fit_group, "grp long, at int, value double"), "quality-models")
    mean = [r["value"] for r in fitted.groupBy("at").agg(F.avg("value").alias("value")).orderBy("at").collect()]
    model = Model(edges)
    model.weights, model.bias, model.prior = np.array(mean[:-2]), mean[-2], mean[-1]
    return model


def score_table(rows: DataFrame, model: Model | None) -> DataFrame:
    """(id, score, predicted, text_key) of a feature table."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            n = batch.num_rows
            x = np.asarray(batch.column(1).flatten(), np.float32).reshape(n, len(FEATURES))
            s = shared.value.score(x) if shared.value is not None else np.full(n, 0.5)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s, pa.float64()),
                                              pa.array((s >= 0.5).astype(np.int32), pa.int32()), batch.column(2)],
                                             names=["id", "score", "predicted", "text_key"])

    return rows.select("id", "x", "text_key").mapInArrow(run, "id long, score double, predicted int, text_key long")


def op4_quality_classifier(spark, sf_dir: str) -> DataFrame:
    rows = feature_table(table(spark, sf_dir, "documents"))
    scored = score_table(rows, train(rows, table(spark, sf_dir, "labels")))
    return scored.select(F.col("id").alias("doc_id"), (fold(F.col("id"), 3) == HELD_OUT).alias("held_out"), "score", "predicted")
