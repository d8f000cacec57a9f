"""N-gram Jaccard self-join by a partitioned universe (pigeonhole over segments).

Two sets of sizes r and s with Jaccard 9/10 or more differ in at most (r + s) / 19 elements (other
similarities alike). Sets are
put into size bands, so that partners are in the same or neighbouring bands; a band fixes H, the most
elements two partners can differ in. The token universe is hashed into m segments per band. Segment i
has an allowance e_i: 1 if only equal segments are indexed, 2 if the segment's one-deletion
neighbourhood is indexed too. If the allowances sum to H + 1 or more, partners must meet in a segment
(pigeonhole). ``allocate`` picks m, the number of segments with one-deletions and the number of segments
a set may leave out (it leaves out its smallest, which unrelated sets share) by a cost model: index rows a set makes, plus the partners it would meet
by chance. Deletions pay for small sets, plain segments for large ones.

Sets with equal elements are one *class* from the start. Classes that share a signature are tied into
candidate groups (``buckets``). Documents that share a passage can tie very many classes together, so
groups are first cut down by *parity sketches*: bit i of a set's sketch is the parity of its elements with
hash i, so two sketches differ in at most as many bits as the sets differ in elements. Pairs whose sketches
differ in more bits than linked sets may differ in elements are no links; the others join the narrower
groups, inside which all pairs whose sizes allow it are verified exactly.

``near_groups`` returns, per row: n_shingles, n_links (other rows linked to it, equal texts included)
and component_id (smallest id reachable by links). Null or empty texts have an empty set, link with
nothing and are their own component. Rows with a null id take part; the component id is the smallest
id that isn't null. Repeated rows count as equal sets. An empty table gives an empty result. Only the
id and the text are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlytics.llm.buckets import EDGE, StarBuffer, Union, candidate_groups, per_tile, tie_sorted, tiled
from sensorlytics.llm.common import components, frozen, mix64, small_batches, table, utf8

SHINGLE = 3
DOC = 2  # kind of the rows (doc_id, class, size)
BROADCAST_ROWS = 500_000  # 24 bytes each
SKETCH_TILE = 4096  # members of a tile of sketches
_M = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


# ------------------------------------------------------------------ sets

class Shingler:
    """Distinct n-word shingles of texts as 64-bit hashes; remembers word hashes up to a bound."""

    MEMO = 300_000

    def __init__(self, size: int = SHINGLE):
        self.size, self.memo = size, {}

    def hashes(self, words: list[bytes]) -> np.ndarray:
        try:
            return np.fromiter(map(self.memo.__getitem__, words), np.uint64, len(words))
        except KeyError:
            if len(self.memo) > self.MEMO:
                self.memo.clear()
            for w in set(words):
                self.memo.setdefault(w, xxhash.xxh64_intdigest(w))
            return np.fromiter(map(self.memo.__getitem__, words), np.uint64, len(words))

    def __call__(self, text: bytes) -> np.ndarray:
        """Sorted distinct shingles; fewer words than a shingle has are one shingle as a whole."""
        words = text.lower().split()
        if not words:
            return np.empty(0, np.uint64)
        h = self.hashes(words)
        k = min(self.size, len(words))
        with np.errstate(over="ignore"):
            acc = np.full(len(words) - k + 1, k, np.uint64)
            for i in range(k):
                acc = (acc ^ (acc >> np.uint64(29))) * _M[i % len(_M)] + mix64(h[i:len(words) - k + 1 + i], i)
        return np.unique(mix64(acc, k))


def class_of(elements: np.ndarray) -> int:
    """64-bit name of a set."""
    with np.errstate(over="ignore"):
        total = mix64(elements, 101).sum(dtype=np.uint64) + np.uint64(len(elements)) * _M[0]
    return int(mix64(np.array([total], np.uint64), 102).view(np.int64)[0])


# ------------------------------------------------------------------ bands and allowances

def most_apart(r: int, s: int, num: int = 9, den: int = 10) -> int:
    """Most elements sets of sizes r and s differ in if their Jaccard similarity is num/den or more."""
    return (r + s) * (den - num) // (den + num)


@lru_cache(maxsize=None)
def bands(top: int, num: int = 9, den: int = 10) -> tuple[int, ...]:
    """Upper size of each band, up to a band that holds ``top``: partners are at most one band apart."""
    out, low = [], 1
    while not out or out[-1] < top:
        out.append(max(low, low * den // num))
        low = out[-1] + 1
    return tuple(out)


def band_of(n: int, num: int = 9, den: int = 10) -> int:
    return int(np.searchsorted(bands(1 << max(4, n.bit_length()), num, den), n))


@lru_cache(maxsize=None)
def allocate(upper: int, num: int = 9, den: int = 10, peers: int = 1_000_000) -> tuple[int, int, int]:
    """(m, deletions, skips) of the band with sizes up to ``upper``.

    The first ``deletions`` segments have allowance 2, the others 1; a set may leave out any ``skips`` of
    those, so that two sets leave out at most 2 * skips between them:
    m + deletions - 2 * skips = H + 1. (0, 0, 0) if partners can only be equal.
    """
    apart = max(most_apart(upper, upper, num, den), upper * (den - num) // num)
    if apart == 0:
        return 0, 0, 0
    best = None
    for deletions in range(min(4, apart + 1) + 1):
        for skips in [*range(24), *(int(24 * 1.25**k) for k in range(14))]:
            m = apart + 1 - deletions + 2 * skips
            if m < max(1, deletions):
                continue
            # a set leaves about Poisson(m / e^size) segments empty and indexes those beyond the skips
            mean = m * math.exp(-upper / m)
            p, more = math.exp(-mean), 0.0
            for k in range(1, skips + 100 + int(mean)):
                p *= mean / k
                more += max(0, k - skips) * p
            cost = m + deletions * upper / m + peers * more * more / m
            if best is None or cost < best[0]:
                best = cost, (m, deletions, skips)
    return best[1]


def signatures(elements: np.ndarray, num: int = 9, den: int = 10) -> np.ndarray:
    """Index keys of a set, in its own band and, if partners can be there, in the band below."""
    n, out = len(elements), []
    if n == 0:
        return np.empty(0, np.int64)
    own = band_of(n, num, den)
    uppers = bands(1 << max(4, n.bit_length()), num, den)
    value = mix64(elements, 5)
    for band in (own, own - 1):
        if band < 0 or (band < own and uppers[band] * den < n * num):
            continue
        m, deletions, skips = allocate(uppers[band], num, den)
        if m == 0:
            continue
        segment = (mix64(elements, 1000 + band) % np.uint64(m)).astype(np.int64)
        sums, count = np.zeros(m, np.uint64), np.bincount(segment, minlength=m)
        np.add.at(sums, segment, value)
        tag = mix64(np.arange(m, dtype=np.uint64) + np.uint64(band << 32), 7)
        use = np.ones(m, bool)
        if skips:
            # leave out the segments that say least: the smallest of those with allowance 1
            use[np.argsort(count[deletions:], kind="stable")[:skips] + deletions] = False
        with np.errstate(over="ignore"):
            out.append(mix64(sums[use] + tag[use], 9))
            if deletions:
                at = segment < deletions
                out.append(mix64(sums[segment[at]] - value[at] + tag[segment[at]], 9))
    return np.unique(np.concatenate(out)).view(np.int64) if out else np.empty(0, np.int64)


# ------------------------------------------------------------------ parity sketches

def sketch_bits(n: int) -> int:
    """Bits of the sketch of a set of n elements: the power of two from 2 n up, at least 256."""
    return max(256, 1 << (2 * n - 1).bit_length())


def parity_sketch(elements: np.ndarray) -> bytes:
    """Bit i: whether an odd number of elements hash to i. The hash of a smaller sketch is the lower bits of
    the same hash, so XOR of a sketch's halves is the sketch of half the bits."""
    bits = sketch_bits(len(elements))
    spot = (mix64(elements, 211) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(spot, minlength=bits) & 1).astype(np.uint8), bitorder="little").tobytes()


def join_sketches(tile: pa.Table, num: int = 9, den: int = 10) -> list[tuple[int, int]]:
    """Edges (a, b) that join the members of one tile whose sketches allow a link.

    Members are sorted by size; a member's partners are the next ones up to the largest size a link allows,
    whose sketches are folded to the length of its own.
    """
    tile = tile.sort_by([("n", "ascending"), ("id", "ascending")])
    ids, n, side = (np.asarray(tile[c]).astype(np.int64) for c in ("id", "n", "side"))
    sketches = tile["sketch"].to_pylist()
    words = np.array([len(x) // 8 for x in sketches], np.int64)
    start = {int(w): int(np.searchsorted(words, w)) for w in np.unique(words)}
    own = {w: np.frombuffer(b"".join(sketches[a:a + np.count_nonzero(words == w)]), np.uint64).reshape(-1, w)
           for w, a in start.items()}

    def folded(w: int, to: int) -> np.ndarray:
        m = own[w]
        while m.shape[1] > to:
            half = m.shape[1] // 2
            m = m[:, :half] ^ m[:, half:]
        return m

    union, out = Union(len(ids)), []
    views: dict = {}
    for i in range(len(ids) - 1):
        w, last = int(words[i]), int(np.searchsorted(n, n[i] * den // num, "right"))
        me = own[w][i - start[w]]
        for v in own:
            a, b = max(i + 1, start[v]), min(last, start[v] + len(own[v]))
            if v < w or a >= b:
                continue
            if (v, w) not in views:
                views[v, w] = folded(v, w)
            apart = np.bitwise_count(views[v, w][a - start[v]:b - start[v]] ^ me).sum(axis=1, dtype=np.int64)
            near = apart * (den + num) <= (n[i] + n[a:b]) * (den - num)
            meets = (side[a:b] == 2) | (side[a:b] != side[i])
            for j in (np.flatnonzero(near & meets) + a).tolist():
                if union.join(i, j):
                    out.append((ids[i], ids[j]))
    return out


# ------------------------------------------------------------------ the join

def _index_batches(batches: Iterator[pa.RecordBatch], shingle: int, num: int, den: int) -> Iterator[pa.RecordBatch]:
    shingler, buffer = Shingler(shingle), StarBuffer()
    for batch in small_batches(batches, "text"):
        classes, sizes, sketches = [], [], []
        for text in utf8(batch.column(1)):
            elements = shingler(text)
            name = class_of(elements)
            classes.append(name if len(elements) else None)
            sizes.append(len(elements))
            sketches.append(parity_sketch(elements) if len(elements) else None)
            keys = signatures(elements, num, den)
            yield from _as_rows(buffer.add(keys, np.full(len(keys), name, np.int64)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(batch.num_rows, DOC, np.int8), pa.int8()), batch.column(0), pa.array(classes, pa.int64()),
             pa.array(sizes, pa.int64()), batch.column(2), pa.array(sketches, pa.binary())],
            names=["kind", "a", "b", "n", "text_key", "sketch"])
    yield from _as_rows(buffer.flush())


def _as_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        none = pa.nulls(b.num_rows, pa.int64())
        yield pa.RecordBatch.from_arrays([*b.columns, none, none, pa.nulls(b.num_rows, pa.binary())],
                                         names=["kind", "a", "b", "n", "text_key", "sketch"])


def _tie_and_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``tie_sorted`` of the index rows; rows of documents pass as they are."""
    waiting: list[pa.RecordBatch] = []

    def index_rows():
        for batch in batches:
            doc = pc.equal(batch.column(0), pa.scalar(DOC, pa.int8()))
            docs = batch.filter(doc)
            if docs.num_rows:
                waiting.append(docs)
            rest = batch.filter(pc.invert(doc))
            if rest.num_rows:
                yield rest.select([0, 1, 2])

    for edges in tie_sorted(index_rows()):
        while waiting:
            yield waiting.pop()
        if edges.num_rows:
            yield from _as_rows([edges])
    while waiting:
        yield waiting.pop()


def _set_batches(batches: Iterator[pa.RecordBatch], shingle: int, num: int, den: int) -> Iterator[pa.RecordBatch]:
    shingler = Shingler(shingle)
    for batch in small_batches(batches, "text"):
        sets = [shingler(t) for t in utf8(batch.column(batch.schema.get_field_index("text")))]
        bands_ = [band_of(len(s), num, den) if len(s) else 0 for s in sets]
        packed = pa.array([s.tobytes() for s in sets], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(bands_, pa.int32()),
                                          packed], names=["id", "grp", "copies", "band", "elements"])


def verify_tile(tile: pa.Table, num: int = 9, den: int = 10) -> list[tuple[int, int, int]]:
    """Exact links of one tile: spanning links as (id, other, 0) and, as (id, id, links), the weight of each
    member's links.

    The elements are renumbered once; then each member marks its elements and all others count theirs
    among the marks, one gather for the whole tile.
    """
    sets = [np.frombuffer(x, np.uint64) for x in tile["elements"].to_pylist()]
    ids, copies, side = (np.asarray(tile[c]) for c in ("id", "copies", "side"))
    n = np.array([len(s) for s in sets], np.int64)
    links = np.zeros(len(sets), np.int64)
    spanning, union = [], Union(len(sets))
    codes = np.unique(np.concatenate(sets), return_inverse=True)[1]
    start = np.cumsum(n) - n
    mark = np.zeros(int(codes.max()) + 1, bool)
    for i in range(len(sets) - 1):
        own = codes[start[i]:start[i] + n[i]]
        mark[own] = True
        shared = np.add.reduceat(mark[codes[start[i + 1]:]], start[i + 1:] - start[i + 1], dtype=np.int64)
        mark[own] = False
        meets = (side[i + 1:] == 2) | (side[i + 1:] != side[i])
        for j in (np.flatnonzero(meets & (shared * den >= (n[i] + n[i + 1:] - shared) * num)) + i + 1).tolist():
            links[i] += copies[j]
            links[j] += copies[i]
            if union.join(i, j):
                spanning.append((ids[i], ids[j], 0))
    return spanning + [(i, i, k) for i, k in zip(ids.tolist(), links.tolist()) if k]


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                similarity: tuple[int, int] = (9, 10), with_group: bool = False) -> DataFrame:
    """Per row: id, n_shingles, component_id, n_links (see the module); links need a Jaccard similarity of
    ``similarity`` (a fraction) or more on sets of ``shingle``-word shingles. ``with_group`` adds what tells
    rows without an id, or with the same, apart: text_key (xxhash64 of the text) and grp, a name of the component."""
    num, den = similarity
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"),
                       F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("text_key"))
    schema = "kind byte, a long, b long, n long, text_key long, sketch binary"
    indexed = rows.mapInArrow(lambda it: _index_batches(it, shingle, num, den), schema)
    dealt = indexed.repartition(F.col("kind"), F.xxhash64("a", F.when(F.col("kind") != 0, F.col("b")))).sortWithinPartitions(
        "kind", "a", "b")
    found = frozen(dealt.mapInArrow(_tie_and_pass, schema), "ngram-index")
    members = found.where(F.col("kind") == DOC).select(F.col("a").alias("id"), F.col("b").alias("cls"), "n", "text_key", "sketch")
    groups = candidate_groups(found.where(F.col("kind") == EDGE).select("a", "b"), "ngram-candidates")
    classes = frozen(members.where("cls IS NOT NULL").groupBy("cls").agg(
        F.min("id").alias("first_id"), F.count(F.lit(1)).alias("copies"), F.any_value("n").alias("n"),
        F.min(F.struct(F.col("id").isNull(), F.col("id"), F.col("text_key"))).alias("rep"),
        F.any_value("sketch").alias("sketch")), "ngram-classes")
    band = F.udf(lambda n: band_of(n, num, den), "int")
    sketches = frozen(classes.join(groups.withColumnRenamed("id", "cls"), "cls").select(
        F.col("cls").alias("id"), "grp", "n", band("n").alias("band"), "sketch"), "ngram-sketches")
    close = frozen(per_tile(tiled(sketches, "sketch", tile=SKETCH_TILE, name="ngram-sketch-tiles"),
                            lambda tile: join_sketches(tile, num, den), ["a", "b"]), "ngram-close")
    groups = candidate_groups(close, "ngram-narrow")
    reps = classes.join(groups.withColumnRenamed("id", "cls"), "cls").select(
        "cls", "grp", "copies", F.col("rep.id").alias("rep_id"), F.col("rep.text_key").alias("text_key"))
    reps = frozen(reps, "ngram-members")
    if reps.count() <= BROADCAST_ROWS:
        reps = F.broadcast(reps)
    texts = rows.join(reps, (rows["text_key"] == reps["text_key"]) & rows["id"].eqNullSafe(reps["rep_id"])).select(
        F.col("cls").alias("id"), "grp", "copies", "text")
    sets = frozen(texts.mapInArrow(lambda it: _set_batches(it, shingle, num, den),
                                   "id long, grp long, copies long, band int, elements binary"), "ngram-sets")
    checked = frozen(per_tile(tiled(sets, "elements"), lambda tile: verify_tile(tile, num, den), ["id", "other", "links"]),
                     "ngram-links")
    comp = components(checked.where("links = 0").select(F.col("id").alias("a"), F.col("other").alias("b")), "ngram-components")
    links = checked.where("links > 0").groupBy(F.col("id").alias("cls")).agg(F.sum("links").alias("other_links"))
    named = classes.drop("sketch", "n", "rep").join(comp.withColumnRenamed("id", "cls"), "cls", "left").withColumn("comp", F.coalesce("comp", "cls"))
    first = named.groupBy("comp").agg(F.min("first_id").alias("component_id"))
    named = named.join(first, "comp").join(links, "cls", "left").select(
        "cls", "component_id", F.col("comp").alias("grp"), (F.coalesce("other_links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    return members.join(named, "cls", "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), *(["text_key", "grp"] if with_group else []))


def op7_ngram_join(spark, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents"))


#: DuckDB SQL for the rows of ``op7_ngram_join``: equal sets are one vertex, links are counted on single shingles.
ORACLE = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents
), single AS (
  SELECT DISTINCT rid, array_to_string(ws[pos:pos + 2], ' ') AS g
  FROM (SELECT rid, ws, unnest(range(1, greatest(len(ws) - 1, 2))) AS pos FROM d WHERE len(ws) > 0)
), sets AS (
  SELECT rid, list_sort(list(g)) AS gs FROM single GROUP BY rid
), classes AS (
  SELECT gs, min(doc_id) AS cls, count(*) AS copies, len(gs) AS n FROM sets JOIN d USING (rid) GROUP BY gs
), one AS (
  SELECT cls, n, unnest(gs) AS g FROM classes
), near AS (
  SELECT a.cls AS x, b.cls AS y FROM one a JOIN one b ON a.g = b.g AND a.cls < b.cls
  WHERE 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
  GROUP BY a.cls, b.cls, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))
), links AS (
  SELECT x, y FROM near UNION ALL SELECT y, x FROM near
), reach(x, y) AS (
  SELECT cls, cls FROM classes UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x
), comp AS (
  SELECT x AS cls, min(y) AS component_id FROM reach GROUP BY x
), degree AS (
  SELECT l.x AS cls, sum(c.copies) AS n FROM links l JOIN classes c ON c.cls = l.y GROUP BY l.x
)
SELECT d.doc_id, CAST(coalesce(c.n, 0) AS BIGINT) AS n_shingles, coalesce(comp.component_id, d.doc_id) AS component_id,
       CAST(coalesce(degree.n, 0) + coalesce(c.copies - 1, 0) AS BIGINT) AS n_links
FROM d LEFT JOIN sets USING (rid) LEFT JOIN classes c ON c.gs = sets.gs LEFT JOIN comp ON comp.cls = c.cls
LEFT JOIN degree ON degree.cls = c.cls
"""
