"""Hierarchical Pitman-Yor bigram model over words, with Gibbs-sampled seating.

Every training word and the document end is a context with a restaurant of its own, whatever its frequency; all
context restaurants share one parent (the unigram restaurant). The parent's base has no atoms: each word has exactly one
table there, and a new table is a word never seen. No word, context or pair of words is left out or put together with others.

Seating: for each dish (word) of each restaurant, its customers and its tables. A Gibbs sweep unseats the customers
of a dish and seats them anew, given the tables of the rest of the restaurant and the parent's current predictive, for
the dishes of a restaurant in random halves. Up to ``EXACT`` customers the number of tables is drawn from its
distribution (generalised Stirling numbers); more are seated one by one in growing steps, with a Metropolis step on the
sequence's normalisers. A dish with one customer has one table. Strengths are resampled from auxiliary variables. The
tables of all contexts are the parent's customers. After ``BURN_IN`` sweeps the predictives of ``SAMPLES`` seatings are averaged.

Rows of the tables are packed arrays. Texts are encoded once, in blocks of about ``BLOCK`` tokens with a vocabulary
each. Words are counted and numbered in buckets of words; a block's pairs of numbers go to groups of contexts, where the
restaurants are. In a sweep the groups send their tables by word to the parent's buckets, which send back
the customers of the words that each group asked for. A context with more than a thousandth of the tokens (so at most a thousand) is
dealt over all groups by word; of these only the sums of tables pass through the driver, with the strengths.
A block meets what it needs for its own pairs and words by shuffles on block numbers.

Null texts count as empty: one token, the end. Rows with a null id are never held out. Repeated rows
count each and get equal scores. Without training rows every token is new, which then has probability one.
An empty table gives an empty result. Perplexity of a text is ``10 ** (-score / n_tokens)``.
"""

from __future__ import annotations

import math
import struct
import zlib
from collections import Counter
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlytics.llm.common import fold, frozen, small_batches, table, utf8

BLOCK, VOCABULARY, GROUP, EXACT, HEAD = 2_000_000, 250_000, 1_500_000, 64, 32
BURN_IN, SAMPLES, SEED = 6, 4, 20240601
MODULUS, HELD_OUT = 7, 2
END, NEW = 0, 1  # numbers of the end and of a word without training tokens; words are numbered from 2

#: What all tables but blocks and counts hold: packed arrays a and b, sent by ``other`` to ``key``.
MAIL = "key long, other long, kind int, a binary, b binary, x double, y double, z double"
STATE, WORDS, HEAVY, FULL, PAIRS, ASKED, SEATS, IDS, CUSTOMERS, TOP = range(10)


# ------------------------------------------------------------------ packed arrays

def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as bytes: whole numbers in as few bytes as their largest needs, first bytes first, then zstd."""
    out = []
    for a in arrays:
        if a.dtype.kind in "iu" and (not a.size or a.min() >= 0):
            a = a.astype(np.min_scalar_type(int(a.max()) if a.size else 0))
        raw = np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T.tobytes()
        small = pa.compress(raw, codec="zstd", asbytes=True) if raw else b""
        out.append(struct.pack("<cqq", a.dtype.char.encode(), len(raw), len(small)) + small)
    return b"".join(out)


def unpack(data: bytes) -> list[np.ndarray]:
    """The arrays of ``pack``; whole numbers as int64."""
    out, at = [], 0
    while at < len(data):
        char, size, small = struct.unpack_from("<cqq", data, at)
        at += 17
        raw = pa.decompress(data[at:at + small], decompressed_size=size, codec="zstd", asbytes=True) if size else b""
        kind = np.dtype(char.decode())
        a = np.frombuffer(np.frombuffer(raw, np.uint8).reshape(kind.itemsize, -1).T.tobytes(), kind)
        out.append(a.astype(np.int64) if a.dtype.kind in "iu" else a)
        at += small
    return out


def pack_words(words: list[bytes]) -> bytes:
    """Words hold no blank, so blanks may join them."""
    raw = b" ".join(words)
    return struct.pack("<q", len(raw)) + (pa.compress(raw, codec="zstd", asbytes=True) if raw else b"")


def unpack_words(data: bytes) -> list[bytes]:
    size = struct.unpack_from("<q", data)[0]
    return pa.decompress(data[8:], decompressed_size=size, codec="zstd", asbytes=True).split() if size else []


def parts_of(keys: np.ndarray) -> dict[int, np.ndarray]:
    """Where each key is."""
    if len(keys) and keys.max() < 1 << 15:
        keys = keys.astype(np.int16)  # sorted by digits
    order = np.argsort(keys, kind="stable")
    found, first = np.unique(keys[order], return_index=True)
    return dict(zip(found.tolist(), np.split(order, first[1:])))


def mail(rows: list[tuple]) -> pa.Table:
    """Rows (key, other, kind, a, b, x, y, z), of which the last may lack."""
    rows = [r + (None, None, 0.0, 0.0, 0.0)[len(r) - 3:] for r in rows]
    types = (pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.float64(), pa.float64(), pa.float64())
    return pa.table([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)],
                    names=["key", "other", "kind", "a", "b", "x", "y", "z"])


def read(t: pa.Table, kind: int | None = None) -> list[dict]:
    """Rows of a group, in an order that doesn't hang on the shuffle."""
    rows = [r for r in t.to_pylist() if kind is None or r["kind"] == kind]
    return sorted(rows, key=lambda r: (r["kind"], r["other"], r["z"]))


def each(df: DataFrame, make) -> DataFrame:
    """Mail from each row of ``df`` by itself; ``make`` gives lists of rows."""

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                for rows in make({c: batch.column(k)[i].as_py() for k, c in enumerate(batch.schema.names)}):
                    yield from mail(rows).to_batches()

    return df.mapInArrow(run, MAIL)


def meet(left: DataFrame, right: DataFrame, key: str, make, schema: str = MAIL) -> DataFrame:
    return left.groupBy(key).cogroup(right.groupBy("key")).applyInArrow(make, schema)


# ------------------------------------------------------------------ texts to numbers

class Numbers(dict):
    """Numbers words as they come."""

    def __missing__(self, word):
        self[word] = n = len(self)
        return n


BLOCKS = "b long, ids binary, train binary, lens binary, tokens binary, words binary, times binary, n_docs long, n_tokens long, n_words long"


def encode(docs: DataFrame) -> DataFrame:
    """Rows (id, text, train) in blocks: per document its length with the end, all numbers of tokens in the block's
    own vocabulary (0: the end), the vocabulary, and how often the block's training texts hold each of its words."""

    def run(batches):
        part, blocks = TaskContext.get().partitionId(), 0
        words, ids, train, tokens, total = Numbers({b"": END}), [], [], [], 0

        def flush():
            nonlocal blocks, words, ids, train, tokens, total
            lens = np.array([len(x) for x in tokens], np.int64)
            flat = np.concatenate(tokens)
            uses = np.bincount(flat, minlength=len(words))
            uses[END] = len(flat) + 1
            order = np.argsort(-uses, kind="stable")  # frequent words get small numbers
            rank = np.empty_like(order)
            rank[order] = np.arange(len(order))
            flat, spelled = rank[flat], list(words)
            times = np.bincount(flat[np.repeat(np.array(train, bool), lens)], minlength=len(words))
            null = np.array([i is None for i in ids])
            row = [(part << 24) + blocks, pack(np.array([i or 0 for i in ids], np.int64).view("u8"), null), pack(np.array(train, bool)),
                   pack(lens), pack(flat), pack_words([spelled[i] for i in order[1:].tolist()]), pack(times), sum(train), len(flat), len(words)]
            blocks += 1
            words, ids, train, tokens, total = Numbers({b"": END}), [], [], [], 0
            return pa.RecordBatch.from_arrays([pa.array([x], pa.binary() if isinstance(x, bytes) else pa.int64()) for x in row],
                                              names=[c.split()[0] for c in BLOCKS.split(", ")])

        for batch in small_batches(batches, "text"):
            for i, text, t in zip(batch.column(0).to_pylist(), utf8(batch.column(1)), batch.column(2).to_pylist()):
                x = text.lower().split()
                one = np.zeros(len(x) + 1, np.int32)
                one[:-1] = np.fromiter(map(words.__getitem__, x), np.int32, len(x))
                ids.append(i)
                train.append(bool(t))
                tokens.append(one)
                total += len(one)
                if total >= BLOCK or len(words) >= VOCABULARY:
                    yield flush()
        if ids:
            yield flush()

    return frozen(docs.mapInArrow(run, BLOCKS), "lm-blocks")


def _deal_words(blocks: DataFrame, buckets: int) -> DataFrame:
    """The blocks' words to the buckets of words, with their training tokens."""

    def make(r):
        words, times = unpack_words(r["words"]), unpack(r["times"])[0][1:]
        at = np.fromiter(map(zlib.crc32, words), np.int64, len(words)) % buckets
        for h, k in parts_of(at).items():
            yield [(h, r["b"], WORDS, pack_words([words[i] for i in k.tolist()]), pack(times[k]))]

    return each(blocks.select("b", "words", "times"), make)


def word_counts(blocks: DataFrame, buckets: int) -> DataFrame:
    """(h, words, n): the training words of each bucket with their tokens, the most frequent
    first; the i-th is numbered ``2 + h + i * buckets``."""

    def make(key, t):
        total: Counter = Counter()
        for r in read(t):
            for w, n in zip(unpack_words(r["a"]), unpack(r["b"])[0].tolist()):
                total[w] += n
        words = sorted((w for w, n in total.items() if n), key=lambda w: (-total[w], w))
        n = np.array([total[w] for w in words], np.int64)
        return mail([(key[0].as_py(), 0, WORDS, pack_words(words), pack(n), float(n.sum()), float(len(n)))])

    return frozen(_deal_words(blocks, buckets).groupBy("key").applyInArrow(make, MAIL), "lm-words")


def numbered(blocks: DataFrame, counts: DataFrame, buckets: int) -> DataFrame:
    """To each block, from each bucket: numbers and training tokens of the words it sent."""

    def make(key, left, right):
        h, index, n = key[0].as_py(), {}, np.empty(0, np.int64)
        for r in read(right):
            words, n = unpack_words(r["a"]), unpack(r["b"])[0]
            index = dict(zip(words, range(len(words))))
        out = []
        for r in read(left):
            words = unpack_words(r["a"])
            at = np.fromiter((index.get(w, -1) for w in words), np.int64, len(words))
            seen = at >= 0
            c = np.zeros(len(at), np.int64)
            c[seen] = n[at[seen]]
            out.append((r["other"], h, IDS, pack(np.where(seen, 2 + h + at * buckets, NEW)), pack(c)))
        return mail(out)

    return frozen(meet(_deal_words(blocks, buckets), counts, "key", make), "lm-ids")


class Block:
    """A block with the numbers of its words: distinct pairs of words, their groups and tokens."""

    def __init__(self, row: dict, replies: list[dict], m: dict):
        words = unpack_words(row["words"])
        self.sent = {h: 1 + k for h, k in parts_of(np.fromiter(map(zlib.crc32, words), np.int64, len(words)) % m["buckets"]).items()}
        self.ids, self.n = np.zeros(len(words) + 1, np.int64), np.zeros(len(words) + 1, np.int64)
        self.ids[0], self.n[0] = END, m["docs"]
        for r in replies:
            k = self.sent[r["other"]]
            self.ids[k], self.n[k] = unpack(r["a"])[0], unpack(r["b"])[0]
        self.lens, self.local = unpack(row["lens"])[0], unpack(row["tokens"])[0]
        self.train = np.repeat(unpack(row["train"])[0], self.lens)
        self.starts = np.cumsum(self.lens) - self.lens
        before = np.empty_like(self.local)
        before[1:] = self.local[:-1]
        before[self.starts] = END  # the end is the first context, as it is the last token
        self.before = before
        self.code = (self.ids[before] << 32) | self.ids[self.local]

    def pairs(self, m: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, dict]:
        """Distinct pairs, a place and the number of each token's pair, and the pairs of each group of contexts (none
        for contexts without training tokens)."""
        codes, at = np.unique(self.code, return_inverse=True)
        first = np.empty(len(codes), np.int64)
        first[at] = np.arange(len(at))
        groups = parts_of(np.where(codes >> 32 == NEW, -1, group_of(codes, m)))
        return codes, first, at, {g: k for g, k in groups.items() if g >= 0}


def group_of(codes: np.ndarray, m: dict) -> np.ndarray:
    u, w = codes >> 32, codes & 0xFFFFFFFF
    return np.where(np.isin(u, m["heavy"]), u + w, u) % m["groups"]


def _of_blocks(blocks: DataFrame, replies: DataFrame, make, schema: str = MAIL) -> DataFrame:
    def run(key, left, right):
        return make(left.to_pylist()[0], right)

    return meet(blocks, replies, "b", run, schema)


def pairs(blocks: DataFrame, replies: DataFrame, m: dict) -> DataFrame:
    """From each block to the groups of contexts: its distinct pairs and their training tokens (0: only asked for)."""

    def make(row, right):
        block = Block(row, read(right), m)
        codes, _, at, groups = block.pairs(m)
        n = np.bincount(at, weights=block.train, minlength=len(codes)).astype(np.int64)
        out = []
        for g, k in groups.items():
            u, runs = np.unique(codes[k] >> 32, return_counts=True)
            out.append((g, row["b"], PAIRS, pack(u, runs), pack(codes[k] & 0xFFFFFFFF, n[k])))
        return mail(out)

    return _of_blocks(blocks.select("b", "train", "lens", "tokens", "words"), replies, make)


# ------------------------------------------------------------------ seating

def reseat(n: np.ndarray, prior: np.ndarray, others: np.ndarray, d: float, theta: float,
           rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Seat ``n`` customers of each dish anew, given ``others`` tables in the rest of the restaurant and the
    parent's probability of the dish: (tables, log of the product of normalisers).

    The j-th customer opens a table with weight (theta + d * tables) * prior and joins one with weight
    j - 1 - d * own tables. Beyond 20 customers, steps take a twentieth of those seated.
    """
    t, log_w = np.ones(len(n), np.int64), np.zeros(len(n))
    j = 1
    top = int(n.max()) if len(n) else 0
    while j < top:
        live = np.flatnonzero(n > j)
        step = np.minimum(max(1, j // 20), n[live] - j)
        opens = (theta + d * (others[live] + t[live])) * prior[live]
        norm = np.maximum(j - d * t[live], 1e-12) + opens
        p = np.minimum(opens / norm, 1.0)
        t[live] += rng.binomial(step, p)
        log_w[live] += step * np.log(norm)
        j += max(1, j // 20)
    return t, log_w


def stirling(d: float, most: int = EXACT) -> np.ndarray:
    """Logarithms of generalised Stirling numbers: of the ways to seat n customers at t tables."""
    s = np.full((most + 1, most + 2), -np.inf)
    s[1, 1] = 0.0
    for n in range(1, most):
        t = np.arange(1, n + 2)
        with np.errstate(divide="ignore"):
            s[n + 1, t] = np.logaddexp(s[n, t - 1], s[n, t] + np.log(np.maximum(n - d * t, 1e-300)))
    return s


def draw(n: np.ndarray, prior: np.ndarray, others: np.ndarray, d: float, theta: float,
         rng: np.random.Generator, logs: np.ndarray) -> np.ndarray:
    """Tables of dishes of at most ``EXACT`` customers, from their distribution given the rest."""
    out = np.ones(len(n), np.int64)
    for size in np.unique(n[n > 1]).tolist():
        of_size, steps = np.flatnonzero(n == size), np.arange(size)
        for k in np.array_split(of_size, 1 + len(of_size) * size // 500_000):
            w = np.log(theta + d * (others[k, None] + steps)) + np.log(prior[k])[:, None]
            w = np.cumsum(w, axis=1) + logs[size, 1:size + 1]
            p = np.cumsum(np.exp(w - w.max(axis=1, keepdims=True)), axis=1)
            out[k] = np.minimum(1 + (p < rng.random(len(k))[:, None] * p[:, -1:]).sum(axis=1), size)
    return out


def sweep(n: np.ndarray, t: np.ndarray, log_w: np.ndarray, prior: np.ndarray, d: float, theta: float,
          rng: np.random.Generator, row: np.ndarray | None = None, rest: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """One Gibbs sweep over the dishes of restaurants, in random halves: the dishes of a half are reseated
    given the tables of all others. ``row``: a dish's restaurant, ``rest``: tables of each restaurant that are not in ``t``."""
    t, log_w = t.copy(), log_w.copy()
    row = np.zeros(len(n), np.int64) if row is None else row
    rest = np.zeros(int(row.max()) + 1 if len(row) else 1) if rest is None else rest
    half, logs = rng.random(len(n)) < 0.5, stirling(d)
    for mine in (half, ~half):
        tables = rest + np.bincount(row, weights=t, minlength=len(rest))
        few, many = np.flatnonzero(mine & (n > 1) & (n <= EXACT)), np.flatnonzero(mine & (n > EXACT))
        new = draw(n[few], prior[few], tables[row[few]] - t[few], d, theta, rng, logs)
        if len(many):
            new_t, new_w = reseat(n[many], prior[many], tables[row[many]] - t[many], d, theta, rng)
            keep = np.isnan(log_w[many]) | (np.log(rng.random(len(many))) < new_w - log_w[many])
            t[many] = np.where(keep, new_t, t[many])
            log_w[many] = np.where(keep, new_w, log_w[many])
        t[few] = new
    return t, log_w


def predictive(n: np.ndarray, t: np.ndarray, parent: np.ndarray, d: float, theta: float) -> np.ndarray:
    """Probabilities of all dishes; n and t are dense, with zeros for absent dishes."""
    return (np.maximum(n - d * t, 0.0) + (theta + d * t.sum()) * parent) / (theta + n.sum())


def strength(total: np.ndarray, tables: np.ndarray, d: float, theta: float, rng: np.random.Generator) -> tuple[float, float]:
    """Auxiliary sums of a set of restaurants for their shared strength: (sum of y, sum of -log x). A table beyond
    the first million of its restaurant has so small a chance that a Poisson number stands for those."""
    total, tables = total[total > 1], tables[total > 1].astype(np.int64)
    if not len(total):
        return 0.0, 0.0
    x = -np.log(np.maximum(rng.beta(theta + 1, total - 1), 1e-300)).sum()
    top = min(int(tables.max()), 1_000_000)
    above = len(tables) - np.cumsum(np.bincount(np.minimum(tables, top), minlength=top + 1))  # with more than i tables
    i = np.arange(1, top)
    far = tables[tables > top]
    y = rng.binomial(above[1:top], theta / (theta + d * i)).sum() + rng.poisson((theta / d * np.log(far / top)).sum())
    return float(y), float(x)


def discount(ones: int, twos: int) -> float:
    """Share of a customer taken off each table, from how many dishes were seen once and twice."""
    return float(np.clip((ones + 0.5) / (ones + 2 * twos + 1.0), 0.05, 0.95))


def places(have: np.ndarray, want: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of ``want`` are in ``have``, both in order, and where."""
    at = np.searchsorted(have, want)
    hit = have[np.minimum(at, len(have) - 1)] == want if len(have) else np.zeros(len(want), bool)
    return hit, at[hit]


def asked_for(g: int, row: dict, pairs_at: tuple, contexts_at: tuple) -> tuple:
    """What a block asks of a group, as places in its pairs and contexts."""
    a, b = (pack(hit, np.diff(at, prepend=0)) for hit, at in (pairs_at, contexts_at))
    return g, row["other"], ASKED, a, b


def at_places(data: bytes, values: np.ndarray) -> np.ndarray:
    """Values (last axis) at the places of ``asked_for``, zero where there is none."""
    hit, steps = unpack(data)
    out = np.zeros((*values.shape[:-1], len(hit)), values.dtype)
    out[..., hit] = values[..., np.cumsum(steps)]
    return out


def _sent_pairs(t: pa.Table) -> list[tuple]:
    out = []
    for r in read(t, PAIRS):
        (u, runs), (w, n) = unpack(r["a"]), unpack(r["b"])
        out.append((r, (np.repeat(u, runs) << 32) | w, n, u))
    return out


def restaurants(sent: DataFrame, m: dict) -> DataFrame:
    """Of each group: STATE (contexts, their numbers of dishes, customers of each dish, and for dishes of two customers or more
    the place among the group's words, words by bucket, pairs of frequent words; b: all pairs; x, y: dishes with one and two customers), to the parent WORDS (words
    with such dishes; words that are one customer's, with their number) and first SEATS, HEAVY tables, and ASKED."""

    def make(key, t):
        g, got = key[0].as_py(), _sent_pairs(t)
        codes, n = np.concatenate([x[1] for x in got]), np.concatenate([x[2] for x in got])
        merged, at = np.unique(codes, return_inverse=True)
        n = np.bincount(at, weights=n, minlength=len(merged)).astype(np.int64)
        hit, at = (n > 0)[at], (np.cumsum(n > 0) - 1)[at]
        merged, n, ends = merged[n > 0], n[n > 0], np.cumsum([len(x[1]) for x in got])
        u, runs = np.unique(merged >> 32, return_counts=True)
        w = merged & 0xFFFFFFFF
        of = (w % m["buckets"] << 32) | w  # words by bucket of the parent
        dishes, dish = np.unique(of[n > 1], return_inverse=True)
        once, times = np.unique(of[n == 1], return_counts=True)
        tables = np.bincount(dish, minlength=len(dishes)).astype(np.int64)
        h, sizes = np.unique(dishes >> 32, return_counts=True)
        seen = np.flatnonzero(np.isin(merged >> 32, m["head"]) & np.isin(w, m["head"]))
        seen = np.concatenate([seen, w[seen]])
        out = [(g, 0, STATE, pack(u, runs, n, dish, h, sizes, seen), pack(merged), float((n == 1).sum()), float((n == 2).sum()))]
        for p in np.union1d(h, once >> 32).tolist():
            k, k1 = dishes >> 32 == p, once >> 32 == p
            number = lambda x: (x & 0xFFFFFFFF) // m["buckets"]
            out.append((p, g, WORDS, pack(number(dishes[k])), pack(number(once[k1]), times[k1])))
            if k.any():
                out.append((p, g, SEATS, pack(tables[k])))
        for i in np.flatnonzero(np.isin(u, m["heavy"])).tolist():
            out.append((int(u[i]), g, HEAVY, None, None, float(runs[i])))
        for (r, c, _, us), end in zip(got, ends.tolist()):
            k = slice(end - len(c), end)
            out.append(asked_for(g, r, (hit[k], at[k][hit[k]]), places(u, us)))
        return mail(out)

    return frozen(sent.groupBy("key").applyInArrow(make, MAIL), "lm-state")


def ask(sent: DataFrame, state: DataFrame) -> DataFrame:
    """ASKED of blocks that the restaurants were not made from."""

    def make(key, left, right):
        rows = read(right)
        merged = unpack(rows[0]["b"])[0] if rows else np.empty(0, np.int64)
        contexts = unpack(rows[0]["a"])[0] if rows else merged
        return mail([asked_for(key[0].as_py(), r, places(merged, c), places(contexts, u)) for r, c, _, u in _sent_pairs(left)])

    return meet(sent, state.where(F.col("kind") == STATE), "key", make)


def parent_words(state: DataFrame) -> DataFrame:
    """Of each of the parent's buckets: WORDS of each group, and FULL (tables of dishes with one customer)."""

    def make(key, t):
        rows = read(t)
        got = [(unpack(r["a"])[0], *unpack(r["b"])) for r in rows]
        full = np.zeros(1 + max(int(x.max()) for a, b, _ in got for x in (a, b) if len(x)), np.int64)
        for _, once, times in got:
            full[once] += times
        h = key[0].as_py()
        return mail([(h, -1, FULL, pack(full))] + [(h, r["other"], WORDS, r["a"]) for r in rows])

    return frozen(state.where(F.col("kind") == WORDS).groupBy("key").applyInArrow(make, MAIL), "lm-parent")


def customers(words: DataFrame, seats: DataFrame) -> DataFrame:
    """The parent's customers are the tables of all contexts: CUSTOMERS to each group, and FULL with their sum and the
    numbers of words with one and two."""

    def make(key, left, right):
        full, *rows = sorted(read(left), key=lambda r: r["kind"] != FULL)
        m, tables = unpack(full["a"])[0].copy(), {r["other"]: unpack(r["a"])[0] for r in read(right)}
        places = {r["other"]: unpack(r["a"])[0] for r in rows}
        for g, at in places.items():
            if len(at):
                m[at] += tables[g]
        h = key[0].as_py()
        return mail([(g, h, CUSTOMERS, pack(m[at])) for g, at in places.items() if len(at)] + [
            (h, -1, FULL, pack(m), None, float(m.sum()), float((m == 1).sum()), float((m == 2).sum()))])

    return frozen(meet(words, seats.where(F.col("kind") == SEATS), "key", make), "lm-customers")


class Group:
    """A group's restaurants."""

    def __init__(self, row: dict, m: dict):
        self.u, self.runs, self.n, self.dish, self.h, self.sizes, seen = unpack(row["a"])
        self.seen, self.seen_w = np.split(seen, 2)
        self.row = np.repeat(np.arange(len(self.u)), self.runs)
        self.two = self.n > 1
        self.row2, self.n2 = self.row[self.two], self.n[self.two]
        self.single = self.runs - np.bincount(self.row2, minlength=len(self.u))
        total = np.bincount(self.row, weights=self.n, minlength=len(self.u)).astype(np.int64)
        self.heavy = np.flatnonzero(np.isin(self.u, m["heavy"]))
        for i in self.heavy.tolist():
            total[i] = m["heavy_n"][int(self.u[i])]
        self.total = total

    def tables(self, t: np.ndarray) -> np.ndarray:
        return self.single + np.bincount(self.row2, weights=t, minlength=len(self.u)).astype(np.int64)

    def whole(self, tables: np.ndarray, heavy: dict) -> np.ndarray:
        """Tables of contexts, of dealt ones those in all groups."""
        out = tables.copy()
        for i in self.heavy.tolist():
            out[i] = heavy[int(self.u[i])]
        return out

    def seen_part(self, t: np.ndarray, d: float, theta: float) -> np.ndarray:
        """What a pair's own customers give to its probability."""
        all_t = np.ones(len(self.n), np.int64)
        all_t[self.two] = t
        return np.maximum(self.n - d * all_t, 0.0) / (theta + self.total[self.row])


def seatings(state: DataFrame, mailed: DataFrame, m: dict, now: dict, seed: int, step: int) -> DataFrame:
    """A sweep over all groups: SEATS of the group (x, y: sums for the strength), its SEATS to the parent, and HEAVY tables."""

    def make(key, left, right):
        g, group, got = key[0].as_py(), Group(read(left)[0], m), read(right)
        rng = np.random.default_rng([seed, step, g])
        asked = [unpack(r["a"])[0] for r in got if r["kind"] == CUSTOMERS]
        prior = ((np.concatenate(asked) if asked else np.empty(0)) - now["d_top"]) / (now["theta_top"] + now["customers"])
        old = [r for r in got if r["kind"] == SEATS]
        t, log_w = np.ones(len(group.n2), np.int64), np.full(len(group.n2), np.nan)
        many = group.n2 > EXACT
        if old:
            t = unpack(old[0]["a"])[0]
            log_w[many] = unpack(old[0]["b"])[0]
        mine = group.tables(t)
        rest = group.single + group.whole(mine, now["heavy_t"]) - mine
        t, log_w = sweep(group.n2, t, log_w, prior[group.dish], m["d"], now["theta"], rng, group.row2, rest)
        mine = group.tables(t)
        light = np.setdiff1d(np.arange(len(group.u)), group.heavy)
        y, x = strength(group.total[light], mine[light], m["d"], now["theta"], rng)
        sums = np.bincount(group.dish, weights=t, minlength=int(group.sizes.sum())).astype(np.int64)
        ends = np.cumsum(group.sizes)
        out = [(g, -1, SEATS, pack(t), pack(log_w[many]), x, y)]
        sums_of = dict(zip(group.h.tolist(), np.split(sums, ends[:-1]) if len(ends) else []))
        out += [(h, g, SEATS, pack(s)) for h, s in sums_of.items()]
        return mail(out + [(int(group.u[i]), g, HEAVY, None, None, float(mine[i])) for i in group.heavy.tolist()])

    return frozen(meet(state, mailed, "key", make), "lm-seats")


def _heavy_tables(df: DataFrame) -> dict:
    """At most a thousand sums, see ``fit``."""
    return {r["key"]: int(r["t"]) for r in df.where(F.col("kind") == HEAVY).groupBy("key").agg(F.sum("x").alias("t")).collect()}


def seat(state: DataFrame, m: dict, burn_in: int, samples: int, seed: int = SEED) -> tuple[np.ndarray, DataFrame, DataFrame]:
    """``heads``, SEATS of all groups and FULL of the parent, with the sample's number in z; strengths and sums of the
    samples go to ``m["taken"]``."""
    spark = state.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    columns = [F.lit(None).cast("binary").alias("b") if c == "b" else c for c in state.columns]
    groups = state.where(F.col("kind") == STATE).select(columns).repartition(parts, "key").persist(StorageLevel.MEMORY_AND_DISK)
    words = parent_words(state).repartition(parts, "key").persist(StorageLevel.MEMORY_AND_DISK)
    seats = state.where(F.col("kind").isin(SEATS, HEAVY))
    back = seats.where(F.lit(False))
    theta, theta_top, taken, all_seats, all_full = 1.0, 1.0, [], [], []
    heavy = _heavy_tables(seats)
    for step in range(burn_in + samples):
        rng = np.random.default_rng([seed, step])
        sent = customers(words, seats.where(F.col("other") >= 0))
        total, ones, twos = (int(x or 0) for x in sent.where(F.col("kind") == FULL).agg(F.sum("x"), F.sum("y"), F.sum("z")).first())
        y, x = strength(np.array([total]), np.array([m["types"]]), discount(ones, twos), theta_top, rng)
        theta_top = float(rng.gamma(1.0 + y, 1.0 / (1.0 + x)))
        now = {"theta": theta, "theta_top": theta_top, "d_top": discount(ones, twos), "customers": total, "heavy_t": heavy}
        mailed = sent.where(F.col("kind") == CUSTOMERS).unionByName(back)
        seats = seatings(groups, mailed, m, now, seed, step)
        back = seats.where((F.col("kind") == SEATS) & (F.col("other") == -1))
        heavy = _heavy_tables(seats)
        if step >= burn_in:
            z = F.lit(float(len(taken)))
            all_seats.append(back.withColumn("z", z))
            all_full.append(sent.where(F.col("kind") == FULL).withColumn("z", z))
            taken.append(now | {"heavy_t": heavy})
        x, y = (v or 0.0 for v in back.agg(F.sum("x"), F.sum("y")).first())
        y2, x2 = strength(np.array([m["heavy_n"][u] for u in sorted(heavy)], np.int64),
                          np.array([heavy[u] for u in sorted(heavy)], np.int64), m["d"], theta, rng)
        theta = float(rng.gamma(1.0 + y + y2, 1.0 / (1.0 + x + x2)))
    m["taken"] = taken
    all_seats, all_full = reduce(DataFrame.unionByName, all_seats), reduce(DataFrame.unionByName, all_full)
    log_p = heads(groups, all_seats, all_full, m) if m["docs"] else np.zeros((0, 1))
    groups.unpersist()
    words.unpersist()
    return log_p, all_seats, all_full


def answers(asked: DataFrame, state: DataFrame, seats: DataFrame, m: dict) -> DataFrame:
    """To each block, SEATS: what their own customers give to its pairs on average, and its contexts' tables by sample."""

    def make(key, t):
        rows = read(t)
        asks = [r for r in rows if r["kind"] == ASKED]
        states = [r for r in rows if r["kind"] == STATE]
        if not asks or not states:
            none = lambda data: len(unpack(data)[0])
            return mail([(r["other"], r["key"], SEATS, pack(np.zeros(none(r["a"]), np.float32)),
                          pack(np.zeros(none(r["b"]) * len(m["taken"]), np.int64))) for r in asks])
        group = Group(states[0], m)
        own, tables = np.zeros(len(group.n)), []
        for r in (r for r in rows if r["kind"] == SEATS):
            now, seated = m["taken"][int(r["z"])], unpack(r["a"])[0]
            own += group.seen_part(seated, m["d"], now["theta"]) / len(m["taken"])
            tables.append(group.whole(group.tables(seated), now["heavy_t"]))
        own, tables = own.astype(np.float32), np.array(tables)
        return mail([(r["other"], r["key"], SEATS, pack(at_places(r["a"], own)), pack(at_places(r["b"], tables).ravel()))
                     for r in asks])

    columns = [F.when(F.col("kind") != STATE, F.col("b")).alias("b") if c == "b" else c for c in asked.columns]
    plain = state.where(F.col("kind") == STATE).select(
        [F.lit(None).cast("binary").alias("b") if c == "b" else c for c in state.columns])
    return plain.unionByName(asked.select(columns)).unionByName(seats).groupBy("key").applyInArrow(make, MAIL)


def word_customers(replies: DataFrame, full: DataFrame, m: dict) -> DataFrame:
    """To each block, CUSTOMERS: the parent's customers of its words by sample. Words of a bucket are in one bucket of the parent."""

    def make(key, left, right):
        counts = [unpack(r["a"])[0] for r in sorted(read(right), key=lambda r: r["z"])]
        out = []
        for r in read(left):
            ids = unpack(r["a"])[0]
            got = np.zeros((len(m["taken"]), len(ids)), np.int64)
            for s, c in enumerate(counts):
                got[s, ids > NEW] = c[ids[ids > NEW] // m["buckets"]]
            out.append((r["key"], r["other"], CUSTOMERS, pack(got.ravel())))
        return mail(out)

    return meet(replies.withColumn("h", (F.col("other") + 2) % m["buckets"]), full, "h", make)


def parent_p(c: np.ndarray, known: np.ndarray, now: dict, m: dict) -> np.ndarray:
    """The parent's probabilities of words with ``c`` customers; all unknown words share what new tables have."""
    new = now["theta_top"] + now["d_top"] * m["types"]
    return np.where(known, c - now["d_top"], new) / (now["theta_top"] + now["customers"])


def heads(groups: DataFrame, seats: DataFrame, full: DataFrame, m: dict) -> np.ndarray:
    """Averaged log10 probabilities of the most frequent words, all others together, and the end (columns) after
    each of those words and the end (rows): a bounded view of the model."""
    ids = np.array(m["head"])

    def make(key, left, right):
        group, out = Group(read(left)[0], m), []
        mine = np.flatnonzero(np.isin(group.u, ids)).tolist()
        for r in read(right) if mine else []:
            now, seated = m["taken"][int(r["z"])], unpack(r["a"])[0]
            own, tables = group.seen_part(seated, m["d"], now["theta"]), group.tables(seated)
            whole, of_row = np.bincount(group.row, weights=own, minlength=len(group.u)), group.row[group.seen]
            for i in mine:
                k = of_row == i
                p = own[group.seen[k]]
                pairs_ = [*zip(group.seen_w[k].tolist(), p.tolist()), (-1, float(whole[i] - p.sum())), (-2, float(tables[i]))]
                out += [(int(group.u[i]), x, TOP, None, None, y, 0.0, r["z"]) for x, y in pairs_]
        return mail(out)

    def tops(r):
        c = unpack(r["a"])[0]
        yield [(i, 0, TOP, None, None, float(c[i // m["buckets"]]), 0.0, r["z"]) for i in ids.tolist() if i % m["buckets"] == r["key"]]

    own = meet(groups, seats, "key", make)
    own = {(r[0], r[1], int(r[2])): r[3] for r in own.groupBy("key", "other", "z").agg(F.sum("x")).collect()}
    c = {(r["key"], int(r["z"])): r["x"] for r in each(full, tops).collect()}
    out = np.zeros((len(ids), len(ids) + 1))
    for s, now in enumerate(m["taken"]):
        p = parent_p(np.array([c[i, s] for i in ids.tolist()]), True, now, m)
        p = np.insert(p, len(ids) - 1, 1 - p.sum())
        for i, u in enumerate(ids.tolist()):
            seen = np.array([own.get((u, w, s), 0.0) for w in [*ids[:-1].tolist(), -1, END]])
            total = m["n_of"][u]
            out[i] += (seen + (now["theta"] + m["d"] * own[u, -2, s]) / (now["theta"] + total) * p) / len(m["taken"])
    return np.log10(out)


# ------------------------------------------------------------------ the model

def fit_blocks(blocks: DataFrame, burn_in: int, samples: int) -> tuple[dict, DataFrame, DataFrame]:
    """The model, the table of training words, and the numbers of the blocks' words."""
    docs, size, vocabularies = (int(x or 0) for x in blocks.agg(F.sum("n_docs"), F.sum("n_tokens"), F.sum("n_words")).first())
    m = {"buckets": max(12, vocabularies // 1_000_000), "groups": max(12, size // GROUP), "docs": docs}
    counts = word_counts(blocks, m["buckets"])
    total, types = (int(x or 0) for x in counts.agg(F.sum("x"), F.sum("y")).first())
    m |= {"tokens": total + docs, "types": types + (docs > 0)}
    limit = m["tokens"] // 1000

    def top(r):
        n = unpack(r["b"])[0]
        k = max(HEAD, int((n > limit).sum()))
        yield [(2 + r["key"] + i * m["buckets"], r["key"], TOP, None, None, float(x)) for i, x in enumerate(n[:k].tolist())]

    # at most a thousand words have more than a thousandth of the tokens, and each bucket has ``HEAD`` more
    n_of = {r["key"]: int(r["x"]) for r in each(counts, top).collect()}
    most = sorted(n_of, key=lambda i: (-n_of[i], i))
    n_of[END] = docs
    heavy = sorted(i for i in n_of if n_of[i] > limit)
    head = [*most[:HEAD], END]
    m |= {"heavy": heavy, "heavy_n": {i: n_of[i] for i in heavy}, "head": head, "n_of": {i: n_of[i] for i in head}}
    replies = numbered(blocks, counts, m["buckets"])
    state = restaurants(pairs(blocks, replies, m), m)
    ones, twos = (int(x or 0) for x in state.where(F.col("kind") == STATE).agg(F.sum("x"), F.sum("y")).first())
    m["d"] = discount(ones, twos)
    log_p, seats, full = seat(state, m, burn_in, samples)
    m["end"] = [0] * samples
    first = full.where("key = 0")  # the end is in the first bucket

    def of_end(r):
        yield [(0, 0, TOP, None, None, float(unpack(r["a"])[0][0]), 0.0, r["z"])]

    if docs:
        for r in each(first, of_end).collect():
            m["end"][int(r["z"])] = r["x"]
    return m | {"log_p": log_p, "tables": (state, seats, full)}, counts, replies


def fit(train: DataFrame, burn_in: int = BURN_IN, samples: int = SAMPLES) -> tuple[dict, DataFrame]:
    """The model, and the table of training words with their numbers of tokens."""
    blocks = encode(train.select(F.lit(None).cast("long").alias("id"), F.col("text").cast("string").alias("text"), F.lit(True).alias("train")))
    return fit_blocks(blocks, burn_in, samples)[:2]


def score_blocks(blocks: DataFrame, replies: DataFrame, asked: DataFrame, model: dict, id_col: str) -> DataFrame:
    m = {k: v for k, v in model.items() if k not in ("tables", "log_p")}
    state, seats, full = model["tables"]

    def make(row, right):
        got = read(right)
        of = lambda kind: [r for r in got if r["kind"] == kind]
        block = Block(row, of(IDS), m)
        ids, n, known, samples = block.ids, block.n, block.n > 0, len(m["taken"])
        c, tables = np.zeros((samples, len(ids))), np.zeros((samples, len(ids)))
        c[:, 0] = m["end"]
        for r in of(CUSTOMERS):
            c[:, block.sent[r["other"]]] = unpack(r["a"])[0].reshape(samples, -1)
        codes, first, where, groups = block.pairs(m)
        own, order = np.zeros(len(codes)), np.argsort(ids)
        for r in of(SEATS):
            k = groups[r["other"]]
            own[k] = unpack(r["a"])[0]
            u = np.unique(codes[k] >> 32)
            tables[:, order[np.searchsorted(ids[order], u)]] = unpack(r["b"])[0].reshape(samples, -1)
        for s, now in enumerate(m["taken"]):
            hot = np.flatnonzero(np.isin(ids, list(now["heavy_t"])))
            tables[s, hot] = [now["heavy_t"][i] for i in ids[hot].tolist()]
            free = (now["theta"] + m["d"] * tables[s]) / (now["theta"] + n)
            own += free[block.before[first]] * parent_p(c[s], known, now, m)[block.local[first]] / samples
        base = np.log10((n + 1) / (m["tokens"] + m["types"] + 1))
        sums = lambda x: np.add.reduceat(x, block.starts)
        id_, null = unpack(row["ids"])
        return pa.table([pa.array(id_, pa.int64(), mask=null), pa.array(block.lens), pa.array(sums(known[block.local].astype(np.int64))),
                         pa.array(sums(base[block.local])), pa.array(sums(np.log10(own)[where]))],
                        names=[id_col, "n_tokens", "n_known", "base_score", "score"])

    right = replies.unionByName(answers(asked, state, seats, m)).unionByName(word_customers(replies, full, m))
    return _of_blocks(blocks.select("b", "ids", "train", "lens", "tokens", "words"), right, make,
                      f"`{id_col}` long, n_tokens long, n_known long, base_score double, score double")


def score(docs: DataFrame, model: dict, counts: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_tokens, n_known, base_score and score."""
    m = {k: v for k, v in model.items() if k not in ("tables", "log_p")}
    blocks = encode(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"), F.lit(False).alias("train")))
    replies = numbered(blocks, counts, m["buckets"])
    asked = ask(pairs(blocks, replies, m), model["tables"][0])
    return score_blocks(blocks, replies, asked, model, id_col)


def op6_pitman_yor(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    held = lambda c: fold(F.col(c), MODULUS) == HELD_OUT
    blocks = encode(docs.withColumn("train", ~held("id")))
    model, _, replies = fit_blocks(blocks, BURN_IN, SAMPLES)
    asked = model["tables"][0].where(F.col("kind") == ASKED)
    return score_blocks(blocks, replies, asked, model, "doc_id").select(
        "doc_id", held("doc_id").alias("held_out"), "n_tokens", "n_known", F.lit(model["tokens"]).cast("long").alias("train_tokens"),
        "base_score", "score")
