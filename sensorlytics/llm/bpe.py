"""Byte-level BPE over a minimal acyclic transducer of frequent words.

The pre-tokens of the whole corpus are counted; the most frequent ``max_words`` are compiled, with
their merged ids as output, into a minimal acyclic automaton (equal suffixes share states). Each arc
carries how many words sort before it, so walking a word adds up to its number, and the number names
its ids. Each worker writes the compiled file from a broadcast copy and maps it into memory.

A task splits each text as the tokenizer does, walks its new pre-tokens through the automaton all at
once (one vectorised step per byte position) and merges the words the automaton doesn't hold exactly,
by rank. Both outcomes are remembered for the task, up to ``MEMO`` words.

Null text counts as empty (no ids, empty decoded text). Special tokens written out in a text become
their id, as the tokenizers library has it. Long texts are cut between pre-tokens while they are read,
never shortened. Repeated rows, null ids and extra columns pass through; an empty table gives an empty
result.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
import json
import mmap
import struct
import tempfile
from collections import Counter
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorlytics.llm.common import frozen, most_frequent, small_batches, table

TOKENIZER = "byte_bpe_50k.json"
MAX_WORDS, MAX_WORD_BYTES, MEMO = 262_144, 32, 600_000
_CHUNK = 200_000  # pre-tokens held at once
_NONE = 1 << 60
LONG_WORD = 400  # bytes from which parts are merged by a heap


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = itertools.count(256)
    return [chr(b) if b in set(plain) else chr(next(spare)) for b in range(256)]


class Vocabulary:
    """Ranks and ids of a tokenizers file of byte-level BPE."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        ids, letters = spec["model"]["vocab"], byte_letters()
        of_letter = {c: b for b, c in enumerate(letters)}
        self.byte_ids = [ids[c] for c in letters]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.merges.setdefault((ids[a], ids[b]), (rank, ids[a + b]))
        self.rank: list[dict[int, int]] = [{} for _ in range(1 + max(ids.values()))]  # by left id
        for (a, b), (r, _) in self.merges.items():
            self.rank[a][b] = r
        self.new_id = {r: i for r, i in self.merges.values()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.pieces = [b""] * (1 + max([*ids.values(), *self.special.values()]))
        for t, i in itertools.chain(ids.items(), self.special.items()):
            self.pieces[i] = bytes(of_letter[c] for c in t) if all(c in of_letter for c in t) else t.encode()

    def merge(self, word: bytes) -> list[int]:
        """Ids of one pre-token: the pair of lowest rank is joined, leftmost first, until none is left."""
        if len(word) > LONG_WORD:
            return self.merge_long(word)
        parts = [self.byte_ids[b] for b in word]
        rank = self.rank
        ranks = [rank[a].get(b, _NONE) for a, b in zip(parts, parts[1:])]
        while ranks:
            low = min(ranks)
            if low == _NONE:
                break
            i = ranks.index(low)
            joined = parts[i] = self.new_id[low]
            del parts[i + 1], ranks[i]
            if i:
                ranks[i - 1] = rank[parts[i - 1]].get(joined, _NONE)
            if i < len(ranks):
                ranks[i] = rank[joined].get(parts[i + 1], _NONE)
        return parts

    def merge_long(self, word: bytes) -> list[int]:
        """The same by a heap over linked parts: a pair that has changed since it was put there is passed over."""
        parts, rank = [self.byte_ids[b] for b in word], self.rank
        after, before = [*range(1, len(parts)), -1], list(range(-1, len(parts) - 1))
        heap = [(rank[a][b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if b in rank[a]]
        heapq.heapify(heap)
        while heap:
            low, i = heapq.heappop(heap)
            j = after[i]
            if parts[i] < 0 or j < 0 or rank[parts[i]].get(parts[j]) != low:
                continue
            parts[i], parts[j] = self.new_id[low], -1
            after[i] = after[j]
            if after[i] >= 0:
                before[after[i]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b >= 0 and (r := rank[parts[a]].get(parts[b])) is not None:
                    heapq.heappush(heap, (r, a))
        return [p for p in parts if p >= 0]


# ------------------------------------------------------------------ the lexicon

def compile_lexicon(words: list[bytes], vocabulary: Vocabulary) -> bytes:
    """File image of the minimal acyclic automaton over ``words`` with their ids as output."""
    words = sorted(set(words) - {b""})
    # states as [final, {label: state}]; a finished state is replaced by its equal from the register
    register: dict[tuple, int] = {}
    nodes: list[tuple[bool, tuple[tuple[int, int], ...]]] = []

    def settle(node) -> int:
        key = (node[0], tuple(node[1]))
        if key not in register:
            register[key] = len(nodes)
            nodes.append(key)
        return register[key]

    path = [[False, []]]  # open states along the last word
    last = b""
    for word in words:
        same = 0
        while same < min(len(word), len(last)) and word[same] == last[same]:
            same += 1
        for i in range(len(last), same, -1):
            child = settle(path.pop())
            path[-1][1].append((last[i - 1], child))
        for _ in word[same:]:
            path.append([False, []])
        path[-1][0] = True
        last = word
    for i in range(len(last), 0, -1):
        child = settle(path.pop())
        path[-1][1].append((last[i - 1], child))
    root = settle(path.pop())
    # children settle before their parents, so one pass counts the words below every state
    below = []
    for final, arcs in nodes:
        below.append(int(final) + sum(below[t] for _, t in arcs))
    keys, targets, skips = [], [], []
    for s, (final, arcs) in enumerate(nodes):
        skip = int(final)
        for label, t in arcs:
            keys.append(s * 256 + label)
            targets.append(t)
            skips.append(skip)
            skip += below[t]
    outputs = [vocabulary.merge(w) for w in words]
    ends = np.cumsum([0, *map(len, outputs)])
    head = struct.pack("<5q", len(nodes), len(keys), len(words), int(ends[-1]), root)
    return head + b"".join(np.asarray(a, d).tobytes() for a, d in (
        (keys, "<i8"), (ends, "<i8"), (targets, "<i4"), (skips, "<i4"), (list(itertools.chain(*outputs)), "<u4"),
        ([f for f, _ in nodes], "u1")))


class Lexicon:
    """The compiled file, read in place from memory."""

    def __init__(self, buf):
        states, arcs, words, ids, self.root = struct.unpack_from("<5q", buf, 0)
        at = 40
        for name, kind, n, width in (("keys", "<i8", arcs, 8), ("ends", "<i8", words + 1, 8), ("targets", "<i4", arcs, 4),
                                     ("skips", "<i4", arcs, 4), ("ids", "<u4", ids, 4), ("final", "u1", states, 1)):
            setattr(self, name, np.frombuffer(buf, kind, n, at))
            at += n * width

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """The number of each word, or -1: all words step through the automaton together."""
        out = np.full(len(words), -1, np.int64)
        if not len(self.keys) or not words:
            return out
        size = np.fromiter(map(len, words), np.int64, len(words))
        start = np.cumsum(size) - size
        text = np.frombuffer(b"".join(words), np.uint8)
        live = np.flatnonzero((size > 0) & (size <= MAX_WORD_BYTES))
        state, total = np.full(len(live), self.root, np.int64), np.zeros(len(live), np.int64)
        for step in range(MAX_WORD_BYTES + 1):
            done = size[live] == step
            if done.any():
                ended, at = live[done], state[done]
                out[ended] = np.where(self.final[at] == 1, total[done], -1)
                live, state, total = live[~done], state[~done], total[~done]
            if not len(live):
                break
            want = state * 256 + text[start[live] + step]
            arc = np.minimum(np.searchsorted(self.keys, want), len(self.keys) - 1)
            ok = self.keys[arc] == want
            live, arc = live[ok], arc[ok]
            state, total = self.targets[arc].astype(np.int64), total[ok] + self.skips[arc]
        return out

    def packed_ids(self, number: int) -> bytes:
        return self.ids[self.ends[number]:self.ends[number + 1]].tobytes()


def _mapped(image: bytes) -> Lexicon:
    """The compiled lexicon as a memory-mapped file. The file loses its name once it is mapped: the map
    keeps it until the worker ends, and nothing stays behind in the executor's folder."""
    with tempfile.NamedTemporaryFile(prefix="lexicon-") as f:
        f.write(image)
        f.flush()
        return Lexicon(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ))


# ------------------------------------------------------------------ texts to ids and back

class Codec:
    """Encodes and decodes texts with a vocabulary and a lexicon, remembering words."""

    def __init__(self, path: str, image: bytes | None):
        self.vocabulary = Vocabulary(path)
        self.lexicon = _mapped(image) if image else None
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self.memo: dict[str, bytes] = {}
        marks = sorted(self.vocabulary.special, key=len, reverse=True)
        self.marks = regex.compile("(" + "|".join(map(regex.escape, marks)) + ")") if marks else None
        self.merged = 0

    def pre_tokens(self, text: str) -> Iterator[list[str]]:
        """Lists of pre-tokens; a special token stands alone, as a list of itself."""
        parts = self.marks.split(text) if self.marks and any(m in text for m in self.vocabulary.special) else [text]
        for i, part in enumerate(parts):
            if i % 2:
                yield [part]
            elif len(part) <= 4 * _CHUNK:
                yield self.pattern.findall(part)
            else:
                found = (m.group() for m in self.pattern.finditer(part))
                while chunk := list(itertools.islice(found, _CHUNK)):
                    yield chunk

    def learn(self, words: set[str]) -> None:
        """Remember ids of new words: from the automaton, or merged."""
        new = [w for w in words if w not in self.memo]
        if len(self.memo) + len(new) > MEMO:
            self.memo, new = {}, list(words)
        raw = [w.encode() for w in new]
        numbers = self.lexicon.numbers(raw) if self.lexicon else np.full(len(raw), -1)
        for w, r, k in zip(new, raw, numbers.tolist()):
            if w in self.vocabulary.special:
                ids = struct.pack("<I", self.vocabulary.special[w])
            elif k >= 0:
                ids = self.lexicon.packed_ids(k)
            else:
                part = self.vocabulary.merge(r)
                ids = struct.pack(f"<{len(part)}I", *part)
                self.merged += 1
            self.memo[w] = ids

    def pack(self, words: list[str]) -> bytes:
        try:
            return b"".join(map(self.memo.__getitem__, words))
        except KeyError:
            self.learn(set(words))
            return b"".join(map(self.memo.__getitem__, words))

    def encode(self, text: str) -> Iterator[bytes]:
        """Packed ids (little-endian unsigned 32-bit), in pieces."""
        return map(self.pack, self.pre_tokens(text))

    def encode_all(self, texts: list[str]) -> Iterator[Iterator[bytes]]:
        """``encode`` of each text; the new words of all but very long texts are learned at once."""
        cut = [list(self.pre_tokens(t)) if len(t) <= 4 * _CHUNK else None for t in texts]
        words: set[str] = set()
        for parts in cut:
            for part in parts or ():
                words.update(part)
        self.learn(words)
        for text, parts in zip(texts, cut):
            yield self.encode(text) if parts is None else map(self.pack, parts)

    def decode(self, ids: bytes) -> bytes:
        """Bytes of the ids; they are UTF-8 only as a whole."""
        return b"".join(map(self.vocabulary.pieces.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def valid_utf8(raw: bytes) -> bytes:
    """Bytes with broken sequences replaced, as decoding to text does."""
    return raw.decode("utf-8", "replace").encode()


# ------------------------------------------------------------------ operators

def count_words(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Pre-tokens of all texts with their counts: (word binary, n), pre-counted in each task."""

    def count(batches):
        pattern, counts = regex.compile(public_tokenizers.PATTERN), Counter()

        def flush():
            words = [w.encode() for w in counts]
            keep = [i for i, w in enumerate(words) if len(w) <= MAX_WORD_BYTES]
            n = list(counts.values())
            out = pa.RecordBatch.from_arrays([pa.array([words[i] for i in keep], pa.binary()),
                                              pa.array([n[i] for i in keep], pa.int64())], names=["word", "n"])
            counts.clear()
            return out

        for batch in small_batches(batches, "text"):
            for text in batch.column(0).to_pylist():
                if len(text or "") <= 4 * _CHUNK:
                    counts.update(pattern.findall(text or ""))
                else:
                    counts.update(m.group() for m in pattern.finditer(text))
                if len(counts) > MEMO:
                    yield flush()
        yield flush()

    return docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(
        count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def build_lexicon(docs: DataFrame, text_col: str = "text", tokenizer: str | None = None,
                  max_words: int = MAX_WORDS) -> bytes:
    """Compile the ``max_words`` most frequent pre-tokens; about 30 bytes a word.

    Words seen once would save nothing and are left to merging.
    """
    vocabulary = Vocabulary(tokenizer or public_tokenizers.path(TOKENIZER))
    counts = frozen(count_words(docs, text_col).where("n > 1"), "bpe-words")
    return compile_lexicon([w for w, _ in most_frequent(counts, "word", max_words)], vocabulary)


_CODECS: dict[tuple, Codec] = {}


def _codec(path: str, image: str, shared) -> Codec:
    """The worker's codec; it serves all tasks of one lexicon."""
    if (path, image) not in _CODECS:
        _CODECS.clear()
        _CODECS[path, image] = Codec(path, shared.value)
    return _CODECS[path, image]


def _text_map(docs, col, fn, out_cols, lexicon, tokenizer, keep_col=True):
    """Apply ``fn(codec, values) -> rows`` to ``col`` and append ``out_cols`` (name, type) to the rows;
    columns of those names are replaced."""
    spark, path = docs.sparkSession, tokenizer or public_tokenizers.path(TOKENIZER)
    shared, image = spark.sparkContext.broadcast(lexicon), hashlib.sha256(lexicon).hexdigest()
    names = [c for c, _ in out_cols]
    base = docs.drop(*[c for c in names if c != col])

    def run(batches):
        codec = _codec(path, image, shared)
        for batch in small_batches(batches, col, 2 << 20):
            at = batch.schema.get_field_index(col)
            rows = list(fn(codec, batch.column(at).to_pylist()))
            cols = [pa.array([r[i] for r in rows], t) for i, (_, t) in enumerate(out_cols)]
            kept = [i for i in range(batch.num_columns) if keep_col or i != at]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in kept), *cols],
                                             names=[*(batch.schema.names[i] for i in kept), *names])

    kinds = {pa.int64(): "long", pa.binary(): "binary", pa.string(): "string"}
    schema = T.StructType([f for f in base.schema.fields if keep_col or f.name != col])
    for c, t in out_cols:
        schema = schema.add(c, kinds[t])
    return base.mapInArrow(run, schema)


def encode(docs: DataFrame, lexicon: bytes, text_col: str = "text", tokenizer: str | None = None) -> DataFrame:
    """Append ``ids`` (little-endian unsigned 32-bit) and ``n_tokens``."""

    def all_ids(codec, texts):
        for pieces in codec.encode_all([t or "" for t in texts]):
            ids = b"".join(pieces)
            yield ids, len(ids) // 4

    return _text_map(docs, text_col, all_ids, [("ids", pa.binary()), ("n_tokens", pa.int64())], lexicon, tokenizer)


def decode(rows: DataFrame, ids_col: str = "ids", tokenizer: str | None = None) -> DataFrame:
    """Append ``decoded``, the text of the packed ids."""

    def all_texts(codec, packed):
        for ids in packed:
            yield (codec.decode(ids or b"").decode("utf-8", "replace"),)

    return _text_map(rows, ids_col, all_texts, [("decoded", pa.string())], b"", tokenizer)


def round_trip_digests(docs: DataFrame, lexicon: bytes, text_col: str = "text", tokenizer: str | None = None) -> DataFrame:
    """n_tokens, ids_sha256 and decoded_sha256 in place of the text: encode and decode in one task, so
    that neither ids nor decoded texts leave it."""

    def digests(codec, texts):
        for pieces in codec.encode_all([t or "" for t in texts]):
            n, ids_hash, raw = 0, hashlib.sha256(), []
            for ids in pieces:
                ids_hash.update(ids)
                n += len(ids) // 4
                raw.append(codec.decode(ids))
            yield n, ids_hash.hexdigest(), hashlib.sha256(valid_utf8(b"".join(raw))).hexdigest()

    return _text_map(docs, text_col, digests, [("n_tokens", pa.int64()), ("ids_sha256", pa.string()),
                                               ("decoded_sha256", pa.string())], lexicon, tokenizer, keep_col=False)


def op1_bpe(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return round_trip_digests(docs, build_lexicon(docs))
