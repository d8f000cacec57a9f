"""Cross-tokenizer alignment with external spill counting.

Two tokenizers cut the same bytes: A (byte-level BPE) and B (BPE pieces with byte fallback), both over one
space and the text. Where a token of A and a token of B end together, a group of tokens closes, and the two
are linked. Per document come the groups, and how often its links are made in the whole corpus.

*Alignment.* A single space between two other characters starts a new token for both (for A by its pattern,
for B because no piece has a space behind another character, which is checked), so a text is cut there and
each piece is tokenized and aligned by itself, once: a worker remembers up to ``MEMO`` pieces.

*Counting.* Each task gathers its links as (B id, A id, document) records. At ``RUN_LINKS`` records they are
sorted, radix-partitioned on mixed bits of the B id and written as a run: per radix the distinct pairs with
their counts, and beside them the documents of each pair, as zstd blocks in a table on the shared folder.
Per radix the pair streams of up to ``FAN_IN`` runs are merged by a heap, adding counts, level after level,
until one stream is left. It is in B-major order, so each B id's highest count is known when its last pair
has passed. The totals then answer every run's pair stream, and each run adds the answers up per document.
A pair that a third of all links make is one entry a run, so nothing has to be split for it.

Null and empty texts, and texts that a tokenizer does not give back byte for byte, have no tokens: zeros
and no groups. Ids may be null or repeat: documents are told apart by their place in a run. Other columns
are ignored. A run holds whole documents, so a very long text makes a longer run. Special tokens written
out in a text are plain text. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import heapq
import os
from collections.abc import Iterable, Iterator
from operator import itemgetter

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorlytics.llm.bpe import byte_letters
from sensorlytics.llm.common import frozen, small_batches, table

TOKENIZER_A, TOKENIZER_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
MEMO, LONG_PIECE = 600_000, 48  # pieces remembered; longer ones are not
RUN_LINKS, FAN_IN = 2_000_000, 64
RADIX_BITS, A_BITS, B_BITS, DOC_BITS = 6, 18, 18, 27  # a record is one signed 64-bit number
_MIX = 0x9E35  # odd, so that b -> b * _MIX mod 2**B_BITS can be undone
_CUT = regex.compile(r"(?<=\S) (?=\S)")
_UNEVEN = regex.compile(r"\s | \s|^\s| $")


def mixed(b: np.ndarray) -> np.ndarray:
    return (b.astype(np.int64) * _MIX) & ((1 << B_BITS) - 1)


def unmixed(m: np.ndarray) -> np.ndarray:
    return (m.astype(np.int64) * pow(_MIX, -1, 1 << B_BITS)) & ((1 << B_BITS) - 1)


class Grown:
    """A numpy array that grows at its end."""

    def __init__(self, kind):
        self.data, self.size = np.empty(1 << 12, kind), 0

    def extend(self, more: np.ndarray) -> None:
        if self.size + len(more) > len(self.data):
            bigger = np.empty(max(2 * len(self.data), self.size + len(more)), self.data.dtype)
            bigger[:self.size] = self.data[:self.size]
            self.data = bigger
        self.data[self.size:self.size + len(more)] = more
        self.size += len(more)


class Aligner:
    """Both tokenizers, and what is known of pieces of text."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        of_letter = {c: i for i, c in enumerate(byte_letters())}
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                   for i, p in enumerate(pieces)]
        #: can a text be cut at single spaces for B too?
        self.cuttable = not any("▁" in p.lstrip("▁") for p in pieces)
        vocab = self.a.get_vocab()
        bytes_a = [b""] * (1 + max(vocab.values()))
        for t, i in vocab.items():
            bytes_a[i] = bytes(of_letter[c] for c in t) if all(c in of_letter for c in t) else t.encode()
        if len(bytes_a) > 1 << A_BITS or len(bytes_b) > 1 << B_BITS:
            raise ValueError("vocabularies of at most 2**18 ids")
        self.bytes_b = bytes_b
        self.len_a, self.len_b = (np.array([len(x) for x in t], np.int64) for t in (bytes_a, bytes_b))
        #: an id in decimal with what follows it: inside a side, or at its end
        self.text_a = [b"%d%s" % (i, s) for s in (b",", b"|") for i in range(len(bytes_a))]
        self.text_b = [b"%d%s" % (i, s) for s in (b",", b";") for i in range(len(bytes_b))]
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.groups: list[bytes] = []
        self.counts = [Grown(np.int32) for _ in range(4)]  # n_a, n_b, n_groups, well (0 or 1)
        self.start, self.links = Grown(np.int64), Grown(np.int64)
        self.start.extend(np.zeros(1, np.int64))

    def pieces(self, text: str) -> list[str]:
        """Pieces of the text; a space in front of each is understood."""
        if not self.cuttable:
            return [text]
        return _CUT.split(text) if _UNEVEN.search(text) else text.split(" ")

    def learn(self, new: list[str]) -> None:
        """Tokenize and align pieces, all at once."""
        ids_a = [e.ids for e in self.a.encode_batch_fast([" " + p for p in new], add_special_tokens=False)]
        ids_b = self.b.encode(new, num_threads=1)
        get = self.bytes_b.__getitem__
        well = np.fromiter((b"".join(map(get, b)) == b" " + p.encode() for b, p in zip(ids_b, new)), bool, len(new))
        n_a, n_b = (np.fromiter(map(len, x), np.int64, len(new)) * well for x in (ids_a, ids_b))
        a = np.fromiter((i for x, ok in zip(ids_a, well) if ok for i in x), np.int64, int(n_a.sum()))
        b = np.fromiter((i for x, ok in zip(ids_b, well) if ok for i in x), np.int64, int(n_b.sum()))
        ends_a, ends_b = np.cumsum(self.len_a[a]), np.cumsum(self.len_b[b])
        common = np.intersect1d(ends_a, ends_b, assume_unique=True)
        last_a, last_b = np.searchsorted(ends_a, common), np.searchsorted(ends_b, common)
        owner = np.repeat(np.arange(len(new)), n_a)[last_a]
        n_groups = np.bincount(owner, minlength=len(new))
        codes = (mixed(b[last_b]) << A_BITS) | a[last_a]
        # decimal ids in the order group, side, place
        group_a, group_b = np.searchsorted(common, ends_a), np.searchsorted(common, ends_b)
        closes_a, closes_b = np.isin(ends_a, common), np.isin(ends_b, common)
        order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
        words = [*map(self.text_a.__getitem__, (a + closes_a * len(self.len_a)).tolist()),
                 *map(self.text_b.__getitem__, (b + closes_b * len(self.len_b)).tolist())]
        words = [words[i] for i in order.tolist()]
        cuts = np.cumsum(n_a + n_b).tolist()
        base, begin = len(self.groups), 0
        for i, (p, end) in enumerate(zip(new, cuts)):
            self.number[p] = base + i
            self.groups.append(b"".join(words[begin:end]))
            begin = end
        for grown, values in zip(self.counts, (n_a, n_b, n_groups, well)):
            grown.extend(values)
        self.start.extend(self.links.size + np.cumsum(n_groups))
        self.links.extend(codes)

    def align(self, texts: list[str]) -> tuple[np.ndarray, list[bytes], np.ndarray, np.ndarray]:
        """Counts (n_a, n_b, n_groups) per text, its groups, and the link codes with the texts' numbers."""
        cut = [self.pieces(t) if t else [] for t in texts]
        new = {p for part in cut for p in part if p not in self.number}
        if len(self.groups) + len(new) > MEMO:
            self.forget()
            new = {p for part in cut for p in part}
        if new:
            self.learn(list(new))
        number = self.number
        flat = np.fromiter((number[p] for part in cut for p in part), np.int64, sum(map(len, cut)))
        sizes = np.fromiter(map(len, cut), np.int64, len(cut))
        ends = np.cumsum(sizes)

        def per_text(values: np.ndarray) -> np.ndarray:
            run = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
            return run[ends] - run[ends - sizes]

        well = (per_text(self.counts[3].data[flat]) == sizes) & (sizes > 0)
        counts = np.stack([per_text(c.data[flat]) * well for c in self.counts[:3]])
        get, at, groups = self.groups.__getitem__, flat.tolist(), []
        for ok, end, size in zip(well.tolist(), ends.tolist(), sizes.tolist()):
            groups.append(b"".join(map(get, at[end - size:end]))[:-1] if ok else b"")
        # links of all pieces of good texts
        owner = np.repeat(np.arange(len(texts)), sizes)
        keep = well[owner]
        flat, owner = flat[keep], owner[keep]
        first, n = self.start.data[flat], self.start.data[flat + 1] - self.start.data[flat]
        shift = np.repeat(first - (np.cumsum(n) - n), n)
        codes = self.links.data[shift + np.arange(len(shift))]
        for p in [p for p in new if len(p) > LONG_PIECE]:  # its numbers stay, its text does not
            self.groups[number.pop(p)] = b""
        return counts, groups, codes, np.repeat(owner, n)


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def _aligner(paths: tuple[str, str]) -> Aligner:
    if paths not in _ALIGNERS:
        _ALIGNERS.clear()
        _ALIGNERS[paths] = Aligner(*paths)
    return _ALIGNERS[paths]


def _paths(tokenizer_a: str | None, tokenizer_b: str | None) -> tuple[str, str]:
    return (tokenizer_a or public_tokenizers.path(TOKENIZER_A), tokenizer_b or public_tokenizers.path(TOKENIZER_B))


def alignments(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", tokenizer_a: str | None = None,
               tokenizer_b: str | None = None) -> DataFrame:
    """(id, n_a, n_b, n_groups, groups) per document; groups as ``a1,a2|b1;a3|b2,b3``, empty without tokens."""
    paths = _paths(tokenizer_a, tokenizer_b)

    def run(batches):
        aligner = _aligner(paths)
        for batch in small_batches(batches, "text", 2 << 20):
            counts, groups, _, _ = aligner.align([t or "" for t in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, counts), pa.array(groups, pa.binary()).cast(pa.string())],
                                             names=[id_col, "n_a", "n_b", "n_groups", "groups"])

    schema = T.StructType([docs.schema[id_col]])
    for name in ("n_a", "n_b", "n_groups"):
        schema = schema.add(name, "long")
    return docs.select(id_col, F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema.add("groups", "string"))


# ------------------------------------------------------------------ runs

def packed(values: np.ndarray) -> bytes:
    """Integers (ascending ones get small) as a zstd block: differences, byte planes apart."""
    v = np.ascontiguousarray(values, "<i8")
    planes = np.diff(v, prepend=0).astype("<i8").view(np.uint8).reshape(-1, 8).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpacked(block: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(block), np.uint8)
    return np.cumsum(np.ascontiguousarray(raw.reshape(8, -1).T).view("<i8").ravel())


def _run_rows(run: int, keys: np.ndarray, docs: pa.RecordBatch) -> Iterator[dict]:
    """A run's rows from its sorted records (code, document): pairs per radix, then the rest of it."""
    keys = np.sort(keys)
    codes = keys >> DOC_BITS
    first = np.flatnonzero(np.diff(codes, prepend=-1))
    sizes = np.diff(np.append(first, len(codes)))
    pairs = codes[first]
    radix = pairs >> (A_BITS + B_BITS - RADIX_BITS)
    edges = np.searchsorted(radix, np.arange((1 << RADIX_BITS) + 1))
    for r, (i, j) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist())):
        if j > i:
            yield {"run": run, "radix": r, "pairs": packed(pairs[i:j]), "sizes": packed(sizes[i:j])}
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, docs.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
        w.write_batch(docs)
    yield {"run": run, "radix": -1, "sizes": packed(sizes), "records": packed(keys & ((1 << DOC_BITS) - 1)),
           "docs": sink.getvalue().to_pybytes()}


_RUN = pa.schema([("run", pa.int64()), ("radix", pa.int32()), ("pairs", pa.binary()), ("sizes", pa.binary()),
                  ("records", pa.binary()), ("docs", pa.binary())])


def spill_runs(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", tokenizer_a: str | None = None,
               tokenizer_b: str | None = None, run_links: int = RUN_LINKS) -> DataFrame:
    """Align all documents and write their links as runs, a table on the shared folder."""
    paths = _paths(tokenizer_a, tokenizer_b)

    def run(batches: Iterable[pa.RecordBatch]):
        aligner, part, seq = _aligner(paths), TaskContext.get().partitionId(), 0
        keys: list[np.ndarray] = []
        rows: list[pa.RecordBatch] = []
        held = n = 0

        def flush():
            whole = pa.Table.from_batches(rows).combine_chunks().to_batches()[0]
            for row in _run_rows((part << 24) | seq, np.concatenate(keys), whole):
                yield pa.RecordBatch.from_pylist([row], schema=_RUN)

        for batch in small_batches(batches, "text", 2 << 20):
            counts, groups, codes, owner = aligner.align([t or "" for t in batch.column(1).to_pylist()])
            digests = [hashlib.sha256(g).digest() if g else b"" for g in groups]
            rows.append(pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, counts), pa.array(digests, pa.binary())],
                                                   names=["id", "n_a", "n_b", "n_groups", "digest"]))
            keys.append((codes << DOC_BITS) | (owner + n))
            n, held = n + batch.num_rows, held + len(codes)
            if held >= run_links:
                yield from flush()
                keys, rows, held, n, seq = [], [], 0, 0, seq + 1
        if rows:
            yield from flush()

    schema = "run long, radix int, pairs binary, sizes binary, records binary, docs binary"
    return frozen(docs.select(id_col, F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema), "align-runs")


def merge_streams(streams: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Heap-merge sorted (code, count) streams, adding the counts of equal codes."""
    merged = heapq.merge(*(zip(c.tolist(), n.tolist()) for c, n in streams), key=itemgetter(0))
    codes, counts, last = [], [], -1
    for code, n in merged:
        if code == last:
            counts[-1] += n
        else:
            codes.append(code)
            counts.append(n)
            last = code
    return np.array(codes, np.int64), np.array(counts, np.int64)


_PAIRS = "radix int, node long, pairs binary, sizes binary"
_PAIRS_ARROW = pa.schema([("radix", pa.int32()), ("node", pa.int64()), ("pairs", pa.binary()), ("sizes", pa.binary())])


def _merge_nodes(group: pa.Table) -> pa.Table:
    rows = group.to_pylist()
    codes, counts = merge_streams([(unpacked(r["pairs"]), unpacked(r["sizes"])) for r in rows])
    return pa.Table.from_pylist([{"radix": rows[0]["radix"], "node": rows[0]["node"], "pairs": packed(codes),
                                  "sizes": packed(counts)}], schema=_PAIRS_ARROW)


def total_counts(runs: DataFrame, fan_in: int = FAN_IN) -> DataFrame:
    """Pairs of the whole corpus per radix, as one block each: (radix, pairs, sizes)."""
    numbers = runs.where("radix < 0").select("run")
    nodes = max(1, numbers.count())
    level = runs.where("radix >= 0").select("radix", F.col("run").alias("node"), "pairs", "sizes")
    while nodes > 1:
        nodes = -(-nodes // fan_in)
        level = frozen(level.withColumn("node", F.pmod(F.xxhash64("node"), F.lit(nodes)))
                       .groupBy("radix", "node").applyInArrow(_merge_nodes, _PAIRS), "align-level")
    return level.select("radix", "pairs", "sizes")


def best_of_b(codes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Which pairs have the highest count of their B id; the codes are B-major."""
    if not len(codes):
        return np.zeros(0, bool)
    b = codes >> A_BITS
    first = np.flatnonzero(np.diff(b, prepend=-1))
    return counts == np.repeat(np.maximum.reduceat(counts, first), np.diff(np.append(first, len(b))))


def pair_counts(totals: DataFrame) -> DataFrame:
    """The totals as rows: (a_id, b_id, count, best)."""

    def run(batches):
        for batch in batches:
            for pairs, sizes in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                codes, counts = unpacked(pairs), unpacked(sizes)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(codes & ((1 << A_BITS) - 1)), pa.array(unmixed(codes >> A_BITS)), pa.array(counts),
                     pa.array(best_of_b(codes, counts))], names=["a_id", "b_id", "count", "best"])

    return totals.select("pairs", "sizes").mapInArrow(run, "a_id long, b_id long, count long, best boolean")


def _answer(runs: pa.Table, totals: pa.Table) -> pa.Table:
    """Counts of each run's pairs, in the run's order; the lowest bit says whether it is its B id's best."""
    rows = runs.to_pylist()
    out = pa.schema([("run", pa.int64()), ("radix", pa.int32()), ("counts", pa.binary())])
    if not rows:
        return out.empty_table()
    codes = unpacked(totals.column("pairs")[0].as_py())
    counts = unpacked(totals.column("sizes")[0].as_py())
    marked = 2 * counts + best_of_b(codes, counts)
    return pa.Table.from_pylist([{"run": r["run"], "radix": r["radix"], "counts": packed(marked[np.searchsorted(codes, unpacked(r["pairs"]))])}
                                 for r in rows], schema=out)


def _exact_sums(docs: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sums per document, exact: each half of the values is added up as whole floats."""
    low, high = values & 0xFFFFFF, values >> 24
    return sum(np.bincount(docs, part, n).astype(np.int64) << s for part, s in ((low, 0), (high, 24)))


def _give_back(run: pa.Table, answers: pa.Table) -> pa.Table:
    """One run's documents with the sums of its links' counts."""
    row = run.to_pylist()[0]
    docs = pa.ipc.open_stream(row["docs"]).read_all()
    n = docs.num_rows
    sizes, records = unpacked(row["sizes"]), unpacked(row["records"])
    best, sums, at, entry = np.zeros(n, np.int64), np.zeros(n, np.int64), 0, 0
    for a in sorted(answers.to_pylist(), key=itemgetter("radix")):  # in the order of the records
        marked = unpacked(a["counts"])
        here = sizes[entry:entry + len(marked)]
        owner = records[at:at + int(here.sum())]
        entry, at = entry + len(marked), at + len(owner)
        marked = np.repeat(marked, here)
        best += np.bincount(owner, marked & 1, n).astype(np.int64)
        sums += _exact_sums(owner, marked >> 1, n)
    digest = pa.array([d.hex() for d in docs.column("digest").to_pylist()], pa.string())
    return pa.table([docs.column("id"), docs.column("n_a"), docs.column("n_b"), docs.column("n_groups"),
                     docs.column("n_groups"), pa.array(best), pa.array(sums), digest],
                    names=["id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])


def link_sums(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", tokenizer_a: str | None = None,
              tokenizer_b: str | None = None, run_links: int = RUN_LINKS, fan_in: int = FAN_IN) -> DataFrame:
    """Per document: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256. (Each group closes
    with one link.)"""
    runs = spill_runs(docs, text_col, id_col, tokenizer_a, tokenizer_b, run_links)
    totals = frozen(total_counts(runs, fan_in), "align-totals")
    nodes = -(-max(1, runs.where("radix < 0").count()) // fan_in)
    per_node = totals.withColumn("node", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(nodes - 1).cast("long"))))
    asked = runs.where("radix >= 0").select("run", "radix", "pairs", F.pmod(F.xxhash64("run"), F.lit(nodes)).alias("node"))
    answers = asked.groupBy("radix", "node").cogroup(per_node.groupBy("radix", "node")).applyInArrow(
        _answer, "run long, radix int, counts binary")
    rest = runs.where("radix < 0").select("run", "sizes", "records", "docs")
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType)])
    for name in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"):
        schema = schema.add(name, "long")
    out = rest.groupBy("run").cogroup(answers.groupBy("run")).applyInArrow(_give_back, schema.add("groups_sha256", "string"))
    return out.withColumnRenamed("id", id_col)


def op11_token_alignment(spark, sf_dir: str) -> DataFrame:
    return link_sums(table(spark, sf_dir, "documents").select("doc_id", "text"))
