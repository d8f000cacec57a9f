"""Fuzzy line deduplication.

Lines are normalised (A-Z lower-cased, digits to one mark, punctuation dropped, white space runs to one
blank) and hashed; equal ones are copies of a line at any length. A line of marks only, which normalises
to nothing, is named by its marks; blank lines are left alone. Each distinct line of ``MIN_CHARS``
characters or more gets a 64-bit SimHash of its words; a shorter one has no other line within
``SIMILARITY``, as it may not differ in one character. The bits are cut into blocks: two SimHashes that differ in at most
``MAX_BITS`` bits agree in all but ``MAX_BITS`` blocks (pigeonhole), so each choice of that many
untouched blocks is an index key. The number of blocks follows the number of lines, so that chance
meetings stay rare at any size; it doesn't change which hashes are near. Distinct SimHashes that share a
key are compared, near ones are joined, and the joined ones name the candidate groups of lines. Inside a
group, all pairs within ``MAX_BITS`` bits are verified, in tiles of bounded size, by edit similarity,
``1 - distance / characters of the longer line >= SIMILARITY``, with the exact Levenshtein distance over the
characters of the normalised lines. Of every connected group of lines (equal ones included) the first
occurrence by (doc_id, line number) is kept.

``dedup_lines`` returns all columns of the documents with the other occurrences cut out of the text, plus
n_lines and n_removed; ``drop_emptied`` leaves out documents that lost all their text this way. Null
texts stay null, a null id sorts last. Rows that repeat (equal id and text) are one document and get
equal results. An empty table gives an empty result. Columns of any other name pass through.
``least_words`` leaves lines of fewer words alone; its default is 0, all lines that aren't blank.
"""

from __future__ import annotations

import itertools
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlytics.llm.buckets import Union, per_tile, tiled
from sensorlytics.llm.common import components, frozen, mix64, small_batches, split_heavy, table, utf8

JUDGED_WORDS = 20  # a shorter document is not held for a copy by the lines it shares
MIN_WORDS, MAX_BITS, SIMILARITY = 5, 3, 0.9
MIN_CHARS = 10  # the fewest of which a tenth is one character
BROADCAST_ROWS = 500_000
_DIGITS = bytes(48 if 48 <= c <= 57 else c for c in range(256))
_DROP = bytes([*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)])
_MARKS_AND_BLANKS = _DROP + b" \t\x0b\x0c\r"


def normalised(line: bytes) -> list[bytes]:
    """The words of a normalised line."""
    return line.lower().translate(_DIGITS, _DROP).split()


_TO = np.frombuffer(bytes(32 if c in b"\t\x0b\x0c\r" else c for c in _DIGITS.lower()), np.uint8).copy()
_TO[0] = 1  # 0 marks what is dropped; the two control characters count as one
_TO[list(_DROP)] = 0
_BYTE = mix64(np.arange(256, dtype=np.uint64), 31)
WORD_BYTES, PARTS = 32, 2048


def word_hashes(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words data[start:start + size]: byte by byte for all words at once, sorted by
    size so that the words a byte is left of come first; words above ``WORD_BYTES`` one by one."""
    order = np.argsort(-np.minimum(size, WORD_BYTES + 1), kind="stable")
    at, n = start[order], size[order]
    long = int(np.count_nonzero(n > WORD_BYTES))
    h = mix64(n.astype(np.uint64), 32)
    with np.errstate(over="ignore"):
        for k in range(WORD_BYTES):
            left = int(np.searchsorted(-n[long:], -k)) + long
            if left == long:
                break
            h[long:left] = (h[long:left] ^ _BYTE[data[at[long:left] + k]]) * np.uint64(0x9E3779B97F4A7C15)
            h[long:left] ^= h[long:left] >> np.uint64(29)
    for i in range(long):
        h[i] = xxhash.xxh64_intdigest(data[at[i]:at[i] + n[i]].tobytes(), 77)
    out = np.empty(len(h), np.uint64)
    out[order] = mix64(h, 33)
    return out


def simhashes(words: np.ndarray, short: np.ndarray, size: np.ndarray) -> np.ndarray:
    """64-bit SimHash of lines: bit i is set if most of the line's word hashes have it set.

    ``words`` are the word hashes of all lines in order, ``size`` their number per line. Words of up to
    three letters (``short``), which all lines share, count only where a line has fewer than ``MIN_WORDS``
    others. A word's bits are spread over the bytes of eight 64-bit numbers, so that words are summed
    eight bits at a time; long lines are summed in parts of 255 words, ``PARTS`` parts at a time.
    """
    if not len(size):
        return np.empty(0, np.int64)
    line = np.repeat(np.arange(len(size)), size)
    n_long = np.bincount(line[~short], minlength=len(size))
    few = n_long < MIN_WORDS
    words, size = words[~short | few[line]], np.where(few, size, n_long)
    parts = -(-size // 255)
    first = np.cumsum(parts) - parts
    inner = np.arange(int(parts.sum())) - np.repeat(first, parts)
    start = np.append(np.repeat(np.cumsum(size) - size, parts) + 255 * inner, len(words))
    sums = np.empty((len(inner), 64), np.uint8)
    for a in range(0, len(inner), PARTS):
        b = min(a + PARTS, len(inner))
        bits = np.unpackbits(words[start[a]:start[b]].view(np.uint8).reshape(-1, 8), axis=1).view(np.uint64)
        sums[a:b] = np.add.reduceat(bits, start[a:b] - start[a], axis=0).view(np.uint8)
    if len(inner) == len(size):
        return np.packbits(sums.astype(np.int64) * 2 > size[:, None], axis=1).view(np.int64).ravel()
    ones = np.add.reduceat(sums, first, axis=0, dtype=np.int64)
    return np.packbits(ones * 2 > size[:, None], axis=1).view(np.int64).ravel()


def hashed_lines(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, line number, name, SimHash) of every line with ``MIN_WORDS`` words or more."""
    return named_lines(texts, MIN_WORDS)[:4]


def named_lines(texts: list[bytes], least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, line number, name, SimHash, characters) of every line with a word and ``least`` words or more.
    The name is a hash of the normalised line's words and their places."""
    data = _TO[np.frombuffer(b"\n".join(texts), np.uint8)]
    data = data[data != 0]
    ends = np.flatnonzero(data == 10)
    blank = np.ones(len(data) + 2, bool)
    blank[1:-1] = (data == 32) | (data == 10)
    start = np.flatnonzero(blank[:-2] & ~blank[1:-1])
    size = np.flatnonzero(~blank[1:-1] & blank[2:]) + 1 - start
    line = np.searchsorted(ends, start)
    n = np.bincount(line, minlength=len(ends) + 1)
    good = np.flatnonzero(n >= max(least, 1))
    use = (n >= max(least, 1))[line]
    start, size, n = start[use], size[use], n[good]
    h = word_hashes(data, start, size)
    at = np.cumsum(n) - n
    upto = np.append(0, np.cumsum((data & 0xC0) != 0x80))  # bytes that begin a character
    chars = (np.add.reduceat(upto[start + size] - upto[start], at) if len(at) else at) + n - 1
    place = np.arange(len(h)) - np.repeat(at, n)
    with np.errstate(over="ignore"):
        placed = mix64(h + mix64(place.astype(np.uint64), 34), 35)
        names = mix64(np.add.reduceat(placed, at) + n.astype(np.uint64), 36) if len(at) else h
    lines = np.array([t.count(b"\n") + 1 for t in texts], np.int64)
    first = np.cumsum(lines) - lines
    text = np.searchsorted(first, good, "right") - 1
    return text, good - first[text], names.view(np.int64), simhashes(h, size <= 3, n), chars


def marked_lines(texts: list[bytes]) -> tuple[list[int], list[int], list[int]]:
    """(text, line number, name) of every line that has marks but no words."""
    rows = [(i, k, xxhash.xxh64_intdigest(b" ".join(marks), 78) - 2**63)
            for i, text in enumerate(texts) for k, line in enumerate(text.split(b"\n"))
            if not line.translate(None, _MARKS_AND_BLANKS) and (marks := line.split())]
    return tuple([r[i] for r in rows] for i in range(3))


def blocks_for(lines: int) -> int:
    """Blocks of the SimHash: the fewest whose keys put at most some hundred hashes into a bucket by chance
    (a bucket's hashes are compared by a few vectorised operations each)."""
    return next((b for b in range(MAX_BITS + 2, 9) if lines <= 512 * 2 ** (64 * (b - MAX_BITS) // b)), 8)


def index_keys(hashes: np.ndarray, blocks: int) -> np.ndarray:
    """Keys of SimHashes, one column for each choice of untouched blocks."""
    bits, edges = hashes.view(np.uint64), np.linspace(0, 64, blocks + 1).astype(int)
    masks = [((1 << int(b)) - 1) ^ ((1 << int(a)) - 1) for a, b in zip(edges, edges[1:])]
    out = []
    for k, kept in enumerate(itertools.combinations(range(blocks), blocks - MAX_BITS)):
        mask = np.uint64(sum(masks[i] for i in kept))
        with np.errstate(over="ignore"):
            mixed = ((bits & mask) + np.uint64(k + 1)) * np.uint64(0x9E3779B97F4A7C15)
            out.append(((mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)).view(np.int64))
    return np.stack(out, 1)


def levenshtein(a, b) -> int:
    """Exact edit distance of two sequences, bit-parallel over ``a`` (Hyyrö's form of Myers' algorithm on
    long integers)."""
    if not a or not b:
        return len(a) or len(b)
    where: dict = {}
    for i, x in enumerate(a):
        where[x] = where.get(x, 0) | (1 << i)
    full, high = (1 << len(a)) - 1, 1 << (len(a) - 1)
    up, down, dist = full, 0, len(a)
    for x in b:
        eq = where.get(x, 0)
        diag = ((((eq & up) + up) ^ up) | eq | down) & full
        plus, minus = down | (full & ~(diag | up)), up & diag
        if plus & high:
            dist += 1
        elif minus & high:
            dist -= 1
        plus, minus = ((plus << 1) | 1) & full, (minus << 1) & full
        up, down = minus | (full & ~(diag | plus)), plus & diag
    return dist


class Line:
    """A line's parts, here its words, and their counts."""

    def __init__(self, text: str):
        self.parts = text.split(" ")
        self.counts = Counter(self.parts)


class Letters(Line):
    """A line whose parts are its characters."""

    def __init__(self, text: str):
        self.parts = text
        self.counts = Counter(text)


def similar(a: Line, b: Line, least: float = SIMILARITY) -> bool:
    """Whether 1 - (edit distance over parts) / (parts of the longer line) is ``least`` or more.

    Each edit changes the counts by one part at most on either side, so most unlike pairs end at the
    counts; equal beginnings and ends don't change the distance.
    """
    x, y = a.parts, b.parts
    most = int((1 - least) * max(len(x), len(y)) + 1e-9)
    if abs(len(x) - len(y)) > most:
        return False
    only_a = sum(n - b.counts.get(p, 0) for p, n in a.counts.items() if n > b.counts.get(p, 0))
    if max(only_a, only_a + len(y) - len(x)) > most:
        return False
    lo, hi = 0, 0
    short = min(len(x), len(y))
    while lo < short and x[lo] == y[lo]:
        lo += 1
    while hi < short - lo and x[-1 - hi] == y[-1 - hi]:
        hi += 1
    return levenshtein(x[lo:len(x) - hi], y[lo:len(y) - hi]) <= most


# ------------------------------------------------------------------ tables

def _line_batches(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Names of lines; a line too short for a similar one has no SimHash."""
    for batch in small_batches(batches, "text", 4 << 20):
        texts = utf8(batch.column(2))
        row, number, names, hashes, chars = named_lines(texts, least)
        none = chars < MIN_CHARS
        if not least:
            marked = marked_lines(texts)
            row, number, names = (np.append(x, np.array(m, np.int64)) for x, m in zip((row, number, names), marked))
            hashes, none = np.append(hashes, np.zeros(len(marked[0]), np.int64)), np.append(none, np.ones(len(marked[0]), bool))
        at = pa.array(row, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(at), batch.column(1).take(at), pa.array(number, pa.int64()),
             pa.array(names, pa.int64()), pa.array(hashes, pa.int64(), mask=none)],
            names=["id", "text_key", "number", "line", "simhash"])


def band(chars: int) -> int:
    """Band of a line's length; lines that can be similar are in equal or neighbouring bands."""
    return int(np.log(max(1, chars)) / -np.log(SIMILARITY) + 1e-9)


def _text_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The normalised text of line ``number`` of each row."""
    for batch in small_batches(batches, "text"):
        last, parts, out = None, [], []
        for text, k in zip(utf8(batch.column(4)), batch.column(3).to_pylist()):
            if text != last:
                last, parts = text, text.split(b"\n")
            out.append(b" ".join(normalised(parts[k])).decode())
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array([band(len(x)) for x in out], pa.int32()), pa.array(out, pa.string())],
                                         names=["id", "grp", "simhash", "band", "words"])


def verify_tile(tile: pa.Table) -> list[tuple[int, int]]:
    """Links that join the similar lines of one tile."""
    ids, lines, side = tile["id"].to_pylist(), [Letters(x) for x in tile["words"].to_pylist()], np.asarray(tile["side"])
    bits = np.asarray(tile["simhash"]).view(np.uint64)
    union, out = Union(len(ids)), []
    for i in range(len(ids) - 1):
        near = np.bitwise_count(bits[i + 1:] ^ bits[i]) <= MAX_BITS
        meets = (side[i + 1:] == 2) | (side[i + 1:] != side[i])
        for j in (np.flatnonzero(near & meets) + i + 1).tolist():
            if union.root(i) != union.root(j) and similar(lines[i], lines[j]):
                union.join(i, j)
                out.append((ids[i], ids[j]))
    return out


def near_in_bucket(bits: np.ndarray) -> Iterator[tuple[int, int]]:
    """Pairs within ``MAX_BITS`` bits that join the SimHashes of one bucket, all of them compared."""
    union = Union(len(bits))
    for i in range(len(bits) - 1):
        for j in (np.flatnonzero(np.bitwise_count(bits[i + 1:] ^ bits[i]) <= MAX_BITS) + i + 1).tolist():
            if union.join(i, j):
                yield i, j


def near_hashes(hashes: DataFrame, blocks: int) -> DataFrame:
    """Edges (a, b) that join the distinct SimHashes within ``MAX_BITS`` bits of each other.

    A bucket holds distinct SimHashes only, so copies of a line never crowd it.
    """

    def index(batches):
        for batch in batches:
            h = np.asarray(batch.column(0))
            keys = index_keys(h, blocks)
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel(), pa.int64()), pa.array(np.repeat(h, keys.shape[1]), pa.int64())],
                                             names=["key", "h"])

    def meet(batches):
        key, held = None, []

        def pairs():
            bits = np.concatenate(held)
            if len(bits) > 1:
                found = list(near_in_bucket(bits.view(np.uint64)))
                yield from ((int(bits[i]), int(bits[j])) for i, j in found)

        for batch in batches:
            keys, h = np.asarray(batch.column(0)), np.asarray(batch.column(1))
            if not len(keys):
                continue
            starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
            ends = np.r_[starts[1:], len(keys)]
            edges = []
            # buckets of one hash meet nothing, but for the first and last, which may go on in other batches
            busy = np.flatnonzero(ends - starts > 1)
            for k in sorted({0, *busy.tolist(), len(starts) - 1}):
                a, b = int(starts[k]), int(ends[k])
                if key is not None and keys[a] == key:
                    held.append(h[a:b])
                    continue
                if sum(map(len, held)) > 1:
                    edges.extend(pairs())
                key, held = keys[a], [h[a:b]]
            yield _edges(edges)
        if sum(map(len, held)) > 1:
            yield _edges(list(pairs()))

    dealt = hashes.mapInArrow(index, "key long, h long").repartition("key").sortWithinPartitions("key", "h")
    return dealt.mapInArrow(meet, "a long, b long").distinct()


def _edges(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)], names=["a", "b"])


def near_lines(lines: DataFrame, rows: DataFrame, blocks: int) -> DataFrame:
    """Verified groups of distinct lines: (line, comp). ``lines`` has (line, simhash, first)."""
    lines = lines.where("simhash IS NOT NULL")
    hashes = lines.groupBy("simhash").agg(F.count(F.lit(1)).alias("lines"))
    hashes = frozen(hashes, "line-hashes")
    groups = components(frozen(near_hashes(hashes.select("simhash"), blocks), "line-edges"), "line-candidates")
    # lines of a hash that is near another, or that two lines share
    hashes = hashes.join(groups, hashes["simhash"] == groups["id"], "left").select(
        "simhash", "lines", F.coalesce("comp", "simhash").alias("grp"), F.col("comp").isNotNull().alias("near")).where(
        "near OR lines > 1").select("simhash", "grp")
    members = frozen(lines.join(hashes, "simhash").select(
        "line", "grp", "simhash", F.col("first.id").alias("_id"), F.col("first.text_key").alias("_key"),
        F.col("first.number").alias("number")), "line-members")
    few = F.broadcast(members) if members.count() <= BROADCAST_ROWS else members
    texts = rows.join(few, F.col("id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key")))
    payload = frozen(texts.select("line", "grp", "simhash", "number", "text").mapInArrow(
        _text_batches, "id long, grp long, simhash long, band int, words string"), "line-texts")
    links = frozen(per_tile(tiled(payload, "words"), lambda tile: verify_tile(tile), ["a", "b"]), "line-links")
    return components(links, "line-components").select(F.col("id").alias("line"), "comp")


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_words: int = 0) -> DataFrame:
    """Line numbers to cut, per text that has any: (id, text_key, cut, here), ``here`` being those of them
    whose line is kept in the same text."""
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("text_key"),
                       text.alias("text"))
    occ = frozen(rows.mapInArrow(lambda batches: _line_batches(batches, least_words), "id long, text_key long, number long, line long, simhash long"), "line-rows")
    first = F.struct(F.col("id").isNull().alias("none"), F.col("id"), F.col("text_key"), F.col("number"))
    lines = frozen(occ.groupBy("line").agg(F.min(first).alias("first"), F.min("simhash").alias("simhash"),
                                           F.count(F.lit(1)).alias("n")), "line-distinct")
    near = near_lines(lines, rows, blocks_for(lines.count()))
    named = lines.join(near, "line", "left").withColumn("comp", F.coalesce("comp", "line"))
    groups = named.groupBy("comp").agg(F.min("first").alias("keep"), F.sum("n").alias("total")).where("total > 1")
    cuts = frozen(named.join(groups, "comp").select("line", "keep", "n"), "line-cuts")
    total = cuts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    heavy, rest = split_heavy(cuts, "n", total)
    plain = occ.drop("simhash")
    hit = plain.join(F.broadcast(heavy), "line").unionByName(plain.join(rest.hint("shuffle_merge"), "line"))
    here = F.col("keep.id").eqNullSafe(F.col("id")) & (F.col("keep.text_key") == F.col("text_key"))
    own = here & (F.col("keep.number") == F.col("number"))
    return frozen(hit.where(~own).groupBy("id", "text_key").agg(
        F.collect_set("number").alias("cut"), F.collect_set(F.when(here, F.col("number"))).alias("here")), "line-lists")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", drop_emptied: bool = False,
                least_words: int = 0, least_left: float = 0.0) -> DataFrame:
    """The documents with repeated lines cut out of the text, plus n_lines (of the text before) and
    n_removed; with ``drop_emptied``, without the documents that have no word left but had some; without
    those of ``JUDGED_WORDS`` words or more of which less than the share ``least_left`` is left or kept
    elsewhere in the same text (a few lines may be shared by chance). Lines of
    fewer than ``least_words`` words are left alone; 0 takes all lines that aren't blank."""
    lists = repeated_lines(docs, id_col, text_col, least_words).select(
        F.col("id").alias("_id"), F.col("text_key").alias("_key"), F.struct("cut", "here").alias("_cut"))
    n, numbers = lists.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("_cut.cut")), F.lit(0))).first()
    few = F.broadcast(lists) if n <= BROADCAST_ROWS and numbers <= 4 * BROADCAST_ROWS else lists
    base = docs.drop("_cut", "_id", "_key", "n_lines", "n_removed").withColumn(text_col, F.col(text_col).cast("string"))
    joined = base.join(few, F.col(id_col).cast("long").eqNullSafe(F.col("_id")) & (
        F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))) == F.col("_key")), "left").drop("_id", "_key")
    names = base.columns

    def run(batches):
        for batch in small_batches(batches, text_col):
            at = batch.schema.get_field_index(text_col)
            texts, lines, removed, keep = [], [], [], []
            for text, cut in zip(batch.column(at).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()):
                parts = [] if text is None else text.split("\n")
                left, stays = text, True
                if cut:
                    gone = set(cut["cut"])
                    left = "\n".join(x for i, x in enumerate(parts) if i not in gone)
                    words = len(text.encode().split()) if least_left else 0
                    lost = sum(len(parts[i].encode().split()) for i in gone - set(cut["here"])) if words >= JUDGED_WORDS else 0
                    stays = not (drop_emptied and not left.encode().split()) and lost <= (1 - least_left) * words
                texts.append(left)
                lines.append(len(parts))
                removed.append(len(cut["cut"]) if cut else 0)
                keep.append(stays)
            out = pa.RecordBatch.from_arrays(
                [*(pa.array(texts, pa.string()) if i == at else c for i, c in enumerate(batch.columns[:-1])),
                 pa.array(lines, pa.int64()), pa.array(removed, pa.int64())], names=[*names, "n_lines", "n_removed"])
            yield out.filter(pa.array(keep, pa.bool_()))

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema.fields]
    return joined.mapInArrow(run, ", ".join([*fields, "n_lines long", "n_removed long"]))


def op5_line_dedup(spark, sf_dir: str) -> DataFrame:
    """Per document: doc_id, the text left, n_lines and n_removed."""
    return dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
