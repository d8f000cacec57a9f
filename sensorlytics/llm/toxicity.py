"""Toxicity by compression distance.

A text is read as windows: its words (lower-cased, without punctuation) and its pairs of adjacent words, each in
a fixed frame that gives the compressor something to match. zstandard dictionaries are trained on the windows of
ordinary documents and, apart from them, on those of toxic documents. What both sides hold at one rate tells
nothing, so a window is given to a trainer as often as it occurs beyond what the other side's rate accounts for
(``excess``); there is no least share and no list of words. The toxic dictionary is trained in three sizes: the
smaller ones keep only what recurs most, so the size at which a window is matched tells how common it is.

Each window is compressed with both sides; kind, length, gain (bytes by which the toxic side is shorter) and the
toxic dictionary that gains most form its cell. The labelled documents not used for the dictionaries calibrate
how much a cell speaks for a toxic document. A document's score comes from its strongest windows through a
logistic curve fitted on the same calibration rows. Pairs are compressed only where the largest toxic dictionary
holds them whole: others can gain no more than their words do.

Fitting uses a bounded sample of about ``SAMPLE_ROWS`` labelled rows outside the held-out fold, those below a
threshold on a hash of the id; two thirds train the dictionaries, a third calibrates. At most ``TOXIC_WINDOWS``
and ``ORDINARY_WINDOWS`` windows train a dictionary, those of the largest excess (a dictionary of its size holds
fewer). Scoring reads every document whole.

Null and empty texts have no windows and get the score of a document without evidence. Labels that
are null are no labels; an id labelled both ways counts as toxic. Without labels of both classes all
scores are 0; with both but without any telling window, all are the share of toxic documents. Repeated rows get
equal scores; an empty table gives an empty result; labels, lang, source and doc_id never enter a score.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlytics.llm.common import fold, frozen, most_frequent, small_batches, table, utf8

SAMPLE_ROWS, HELD_OUT, THRESHOLD = 30_000, 1, 0.7
LEVEL, ORDINARY_BYTES, TOXIC_BYTES = 15, 512 << 10, (2 << 10, 16 << 10, 128 << 10)
TOXIC_WINDOWS, ORDINARY_WINDOWS, TRAIN_SAMPLES = 40_000, 100_000, 200_000
SIGMAS = 3.0  # standard deviations of a count that chance may explain
PSEUDO = 1.0  # documents without evidence added to each cell of the calibration
MEMO, PART = 400_000, 200_000
CELL = ("kind", "size", "rung", "gain")
FRAME = bytes([1, 2, 3, 4, 5, 6, 7, 14, 15, 16, 17, 18, 19, 20, 21, 22])
_PUNCTUATION = bytes([*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)])


def words(text: bytes) -> list[bytes]:
    return text.lower().translate(None, _PUNCTUATION).split()


def windows(text: bytes) -> set[bytes]:
    """The distinct words and pairs of adjacent words of a text, without the frame."""
    ws = words(text)
    return {*ws, *(a + b" " + b for a, b in zip(ws, ws[1:]))}


def framed(window: bytes) -> bytes:
    return FRAME + b" " + window + b" "


def excess(own, other, ratio: float, sigmas: float):
    """Documents of one class that hold a window beyond those that the other class's rate accounts for, that
    rate taken ``sigmas`` deviations of its count away; ``ratio`` is this class's size against the other's."""
    return F.round(own - F.greatest(F.lit(0.0), other + sigmas * F.sqrt(other)) * ratio).cast("long")


class Distance:
    """Compressed lengths of windows under the dictionaries of both sides."""

    def __init__(self, ordinary: bytes, toxic: list[bytes], llr: dict | None = None):
        self.ordinary, *self.toxic = [self._compressor(raw) for raw in (ordinary, *toxic)]
        pieces = (piece[1:-1].split(b" ") for piece in toxic[-1].split(FRAME) if piece[:1] == piece[-1:] == b" ")
        self.pairs = {tuple(ws) for ws in pieces if len(ws) == 2}
        self.llr, self.memo = llr, {}

    @staticmethod
    def _compressor(raw: bytes):
        d = zstandard.ZstdCompressionDict(raw)
        d.precompute_compress(level=LEVEL)
        return zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False, write_checksum=False,
                                        write_dict_id=False).compress

    def windows(self, text: bytes) -> set[bytes]:
        """The windows of a text that are compressed."""
        ws = words(text)
        return {*ws, *(a + b" " + b for a, b in self.pairs.intersection(zip(ws, ws[1:])))}

    def cell(self, window: bytes) -> tuple[int, int, int, int]:
        # a window longer than any block is compressed whole; its cell only keeps bounded numbers
        w, last = framed(window), len(self.toxic) - 1
        kind, size = int(b" " in window), min(len(window) // 3, 6)
        ordinary = len(self.ordinary(w))
        gains = [ordinary - len(self.toxic[last](w))]
        if gains[0] <= 0:
            return kind, size, last + 1, 0
        gains = [ordinary - len(c(w)) for c in self.toxic[:last]] + gains
        best = max(gains)
        return kind, size, gains.index(best), min(best, 12)

    def weight(self, window: bytes) -> float:
        v = self.memo.get(window)
        if v is None:
            if len(self.memo) > MEMO:
                self.memo.clear()
            v = self.memo[window] = self.llr.get(self.cell(window), 0.0)
        return v

    def features(self, text: bytes) -> tuple[float, float, float]:
        """Strongest window, sum of the three strongest, log of the number of windows."""
        ws = self.windows(text)
        top = sorted(map(self.weight, ws), reverse=True)[:3]
        return (top[0] if top else 0.0), sum(x for x in top if x > 0), math.log1p(len(ws))


def train_dictionary(counts: list[tuple[bytes, int]], size: int, samples: int = TRAIN_SAMPLES) -> bytes:
    """A zstandard dictionary of about ``size`` bytes; windows are given as often as they count, scaled
    to about ``samples``, in a fixed mixed order. Windows that fit whole are the dictionary, the strongest last
    (nearest), where zstandard's own trainer puts them too."""
    whole = b"".join(framed(w) for w, _ in reversed(counts))
    if len(whole) <= size:
        return whole
    scale = min(1.0, samples / sum(n for _, n in counts))
    out = [framed(w) for w, n in counts for _ in range(max(1, round(n * scale)))]
    order = np.random.default_rng(11).permutation(len(out))
    try:
        return zstandard.train_dictionary(size, [out[i] for i in order], k=64, d=8).as_bytes()
    except zstandard.ZstdError:  # too little text to train on
        return whole[-size:]


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Newton's method for a logistic curve with a small ridge."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (p - y) + ridge * np.r_[0, w[1:]]
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(h, g)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _labelled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, rows: int) -> DataFrame:
    """The bounded training sample: (text, y, key, part); part 0 and 1 train, 2 calibrates. Copies of a text count
    once, so that no group of copies fills a dictionary or meets itself in the calibration."""
    y = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(
        F.col(id_col).cast("long").alias("key")).agg(F.max(F.col(label_col)).cast("int").alias("y")).where(
        fold(F.col("key"), 3) != HELD_OUT)
    known = frozen(y, "toxic-labels")
    total = max(known.count(), 1)
    below = min(rows, total) * (2**64 - 1) // total - 2**63  # a share of all hashes: tasks send only what stays
    few = known.where(F.xxhash64("key", F.lit(3)) <= F.lit(below))  # about ``rows`` ids, binomially: broadcast
    texts = docs.select(F.col(id_col).cast("long").alias("key"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias(
        "text")).join(F.broadcast(few), "key")
    return texts.groupBy("text", "y").agg(F.min("key").alias("key")).withColumn(
        "part", F.pmod(F.xxhash64("key", F.lit(5)), F.lit(3)))


def _window_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: tuple[Counter, Counter] = (Counter(), Counter())

    def flush():
        found = sorted(counts[0].keys() | counts[1].keys())
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary()), *(pa.array([c[w] for w in found], pa.int64())
                                                                          for c in counts)], names=["w", "n0", "n1"])
        for c in counts:
            c.clear()

    for batch in small_batches(batches, "text"):
        for text, y in zip(utf8(batch.column(0)), batch.column(1).to_pylist()):
            counts[int(y > 0)].update(windows(text))
            if len(counts[0]) + len(counts[1]) > PART:
                yield from flush()
    yield from flush()


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        rows: int = SAMPLE_ROWS) -> dict | None:
    """Dictionaries, cell weights and curve; None without labelled documents of both classes."""
    sample = frozen(_labelled(docs, labels, id_col, text_col, label_col, rows), "toxic-texts")
    sizes = {r["y"]: r["n"] for r in sample.where("part < 2").groupBy((F.col("y") > 0).cast("int").alias("y")).agg(
        F.count(F.lit(1)).alias("n")).collect()}
    if not sizes.get(0) or not sizes.get(1):
        return None
    # a pair seen in one toxic document only is chance
    counts = sample.where("part < 2").select("text", "y").mapInArrow(
        _window_counts, "w binary, n0 long, n1 long").groupBy("w").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    told = frozen(counts.where((F.instr(F.col("w").cast("string"), F.lit(" ")) == 0) | (F.col("n1") > 1)).select(
        "w", excess(F.col("n1"), F.col("n0"), sizes[1] / sizes[0], SIGMAS).alias("toxic"),
        excess(F.col("n0"), F.col("n1"), sizes[0] / sizes[1], -SIGMAS).alias("ordinary")), "toxic-windows")
    toxic = most_frequent(told.where("toxic > 0"), "w", TOXIC_WINDOWS, "toxic")
    ordinary = most_frequent(told.where("ordinary > 0"), "w", ORDINARY_WINDOWS, "ordinary")
    if not toxic or not ordinary:
        return {"share": sizes[1] / (sizes[0] + sizes[1])}
    model = {"ordinary": train_dictionary(ordinary, ORDINARY_BYTES),
             "toxic": [train_dictionary(toxic, size) for size in TOXIC_BYTES]}
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)

    def cells(batches):
        found = {0: Counter(), 1: Counter()}
        distance, memo = Distance(shared.value["ordinary"], shared.value["toxic"]), {}
        for batch in small_batches(batches, "text"):
            for text, y in zip(utf8(batch.column(0)), batch.column(1).to_pylist()):
                for w in (ws := distance.windows(text)) - memo.keys():
                    memo[w] = distance.cell(w)
                found[int(y > 0)].update({memo[w] for w in ws})
                if len(memo) > MEMO:
                    memo.clear()
        flat = [(*k, found[0][k], found[1][k]) for k in sorted(set(found[0]) | set(found[1]))]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in flat], pa.int64()) for i in range(6)],
                                         names=[*CELL, "n0", "n1"])

    check = sample.where("part = 2").select("text", "y")
    totals = {r["y"]: r["n"] for r in check.groupBy((F.col("y") > 0).cast("int").alias("y")).agg(F.count(F.lit(1)).alias("n")).collect()}
    n0, n1 = totals.get(0, 0), totals.get(1, 0)
    table_ = check.mapInArrow(cells, "kind long, size long, rung long, gain long, n0 long, n1 long").groupBy(*CELL).agg(
        F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).collect()  # at most 2 * 7 * 4 * 13 cells
    base = (n1 + 1) / (n0 + n1 + 2)  # toxic share; PSEUDO documents of it make an unseen cell say nothing
    model["llr"] = {tuple(r[c] for c in CELL): math.log((r["n1"] + PSEUDO * base) / base)
                    - math.log((r["n0"] + PSEUDO * (1 - base)) / (1 - base)) for r in table_}
    full = spark.sparkContext.broadcast(model)

    def features(batches):
        distance = Distance(full.value["ordinary"], full.value["toxic"], full.value["llr"])
        for batch in small_batches(batches, "text"):
            rows_ = [distance.features(t) for t in utf8(batch.column(0))]
            yield pa.RecordBatch.from_arrays([*(pa.array([r[i] for r in rows_], pa.float64()) for i in range(3)),
                                              pa.array([int(v > 0) for v in batch.column(1).to_pylist()], pa.int32())],
                                             names=["f0", "f1", "f2", "y"])

    rows_ = check.mapInArrow(features, "f0 double, f1 double, f2 double, y int").collect()
    x = np.array([[r["f0"], r["f1"], r["f2"]] for r in rows_]).reshape(-1, 3)
    model["curve"] = _logistic(x, np.array([r["y"] for r in rows_], float)) if len(rows_) else np.zeros(4)
    return model


def score(docs: DataFrame, model: dict | None, id_col: str = "doc_id", text_col: str = "text",
          keep_text: bool = False) -> DataFrame:
    """All columns of ``docs`` (the text only with ``keep_text``), plus score and predicted; columns of
    those two names are replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    source = docs.drop("score", "predicted").withColumn(text_col, F.col(text_col).cast("string"))
    fields = [f for f in source.schema.fields if keep_text or f.name != text_col]
    names = [f.name for f in fields]

    def run(batches):
        m = shared.value
        distance = Distance(m["ordinary"], m["toxic"], m["llr"]) if m and "llr" in m else None
        for batch in small_batches(batches, text_col):
            texts = utf8(batch.column(batch.schema.get_field_index(text_col)))
            if distance:
                x = np.array([distance.features(t) for t in texts]).reshape(-1, 3)
                s = 1 / (1 + np.exp(-np.clip(m["curve"][0] + x @ m["curve"][1:], -500, 500)))
            else:
                s = np.full(len(texts), m["share"] if m else 0.0)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(batch.schema.get_field_index(n)) for n in names), pa.array(s, pa.float64()),
                 pa.array((s >= THRESHOLD).astype(np.int32), pa.int32())], names=[*names, "score", "predicted"])

    return source.mapInArrow(run, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields),
                                             "score double", "predicted int"]))


def op10_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return score(docs, model).select("doc_id", (fold(F.col("doc_id"), 3) == HELD_OUT).alias("held_out"), "score", "predicted")
