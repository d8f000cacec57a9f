"""Best-fit packing of documents into fixed-size training sequences under conflicts.

A bin holds ``capacity`` words, at most one document of each source and at most one of each duplicate
cluster. Open bins are ordered by residual; each carries a bitmap of its sources and one of its
clusters. A document takes the tightest bin that holds it: the search starts at the successor of its
length and goes on to the next residual until a bin without a conflict is found; only if none is left
a bin is opened. Documents come in falling length (ties by id), longer ones than a bin are cut into
pieces, of which the full ones fill bins alone and the rest is packed like a document.

Documents are dealt into blocks of about ``block_docs`` by a hash, and a block is packed in one task,
so memory is bounded and a hot source or a large cluster is spread evenly over the blocks. Only ids,
lengths, sources and cluster names are shuffled.

Returns one row per piece: id, piece, n_pieces, n_words, bin_id, bin_words, bin_docs. Null and empty
texts have one row with n_words 0 and a null bin. A null source is a source of its own; a null id
sorts first. Repeated rows are in one cluster, so they go to different bins. An empty table gives an
empty result.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlytics.llm.common import frozen, small_batches, table, utf8

CAPACITY, BLOCK_DOCS = 1024, 8192


class Bins:
    """Open bins of one block."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.words: list[int] = []
        self.docs: list[int] = []
        self.sources: list[int] = []
        self.clusters: list[int] = []
        self.residuals: list[int] = []  # sorted, each value once
        #: residual -> source bitmap -> bins, in order of arrival
        self.at: dict[int, dict[int, list[int]]] = {}

    def _file(self, b: int) -> None:
        left = self.capacity - self.words[b]
        if left <= 0:
            return
        if left not in self.at:
            self.at[left] = {}
            insort(self.residuals, left)
        self.at[left].setdefault(self.sources[b], []).append(b)

    def _take(self, left: int, sources: int, pos: int) -> int:
        group = self.at[left][sources]
        b = group.pop(pos)
        if not group:
            del self.at[left][sources]
            if not self.at[left]:
                del self.at[left]
                del self.residuals[bisect_left(self.residuals, left)]
        return b

    def find(self, size: int, source: int, cluster: int) -> int | None:
        """The tightest compatible bin, taken out of the order. Bins of equal residual and equal sources
        are passed over together."""
        for i in range(bisect_left(self.residuals, size), len(self.residuals)):
            left = self.residuals[i]
            for sources, group in self.at[left].items():
                if not sources & source:
                    for pos, b in enumerate(group):
                        if not self.clusters[b] & cluster:
                            return self._take(left, sources, pos)
        return None

    def put(self, size: int, source: int, cluster: int) -> int:
        b = self.find(size, source, cluster)
        if b is None:
            b = len(self.words)
            for column in (self.words, self.docs, self.sources, self.clusters):
                column.append(0)
        self.words[b] += size
        self.docs[b] += 1
        self.sources[b] |= source
        self.clusters[b] |= cluster
        self._file(b)
        return b


def pack_block(sizes, sources, clusters, capacity: int = CAPACITY) -> tuple[list[int], Bins]:
    """Bin of each item, in the given order of items (largest first)."""
    source_bit: dict = {}
    cluster_bit: dict = {}
    times: dict = {}
    for c in clusters:
        times[c] = times.get(c, 0) + 1
    bins, out = Bins(capacity), []
    for size, s, c in zip(sizes, sources, clusters):
        bit = 1 << source_bit.setdefault(s, len(source_bit))
        # a cluster with one member in the block can't conflict and needs no bit
        dup = 1 << cluster_bit.setdefault(c, len(cluster_bit)) if times[c] > 1 else 0
        out.append(bins.put(size, bit, dup))
    return out, bins


def _pack(pdf: pd.DataFrame, id_col: str, capacity: int) -> pd.DataFrame:
    pdf = pdf.sort_values(["n_words", id_col, "cluster"], ascending=[False, True, True], na_position="first", kind="stable")
    full, rest = pdf["n_words"] // capacity, pdf["n_words"] % capacity
    pieces = full + (rest > 0)
    rows = []
    lone = 0
    block = int(pdf["block"].iloc[0]) << 32
    items = pdf.assign(rest=rest, full=full, pieces=pieces)
    for r in items[items["full"] > 0].itertuples(index=False):
        for k in range(r.full):
            rows.append((getattr(r, id_col), k, r.pieces, capacity, block + (1 << 31) + lone, capacity, 1))
            lone += 1
    part = items[items["rest"] > 0].sort_values("rest", ascending=False, kind="stable")
    at, bins = pack_block(part["rest"].tolist(), part["source"].tolist(), part["cluster"].tolist(), capacity)
    for r, b in zip(part.itertuples(index=False), at):
        rows.append((getattr(r, id_col), r.full, r.pieces, r.rest, block + b, bins.words[b], bins.docs[b]))
    for r in items[items["n_words"] == 0].itertuples(index=False):
        rows.append((getattr(r, id_col), 0, 1, 0, None, None, None))
    out = pd.DataFrame(rows, columns=[id_col, "piece", "n_pieces", "n_words", "bin_id", "bin_words", "bin_docs"])
    return out.astype({c: "Int64" for c in out.columns})


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small_batches(batches, "text"):
        cut = [t.lower().split() for t in utf8(batch.column(2))]
        names = np.fromiter((xxhash.xxh64_intdigest(b" ".join(w)) for w in cut), np.uint64, len(cut)).view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array([len(w) for w in cut], pa.int64()), pa.array(names, pa.int64())],
            names=["id", "source", "n_words", "cluster"])


def pack(docs: DataFrame, capacity: int = CAPACITY, block_docs: int = BLOCK_DOCS, id_col: str = "doc_id",
         text_col: str = "text", source_col: str = "source", cluster_col: str | None = None) -> DataFrame:
    """Pack ``docs``; duplicate clusters come from ``cluster_col`` (long), or are texts that agree but for
    A-Z case and white space."""
    cluster = F.col(cluster_col).cast("long") if cluster_col else F.lit(None).cast("long")
    sized = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(source_col).cast("string"), F.lit("\0null")).alias("source"),
                        F.col(text_col).cast("string").alias("text"), cluster.alias("given"))
    if cluster_col:
        given = sized.withColumn("source", F.concat_ws("\1", "source", F.coalesce(F.col("given").cast("string"), F.lit(""))))
        rows = given.drop("given").mapInArrow(_measure, "id long, source string, n_words long, cluster long")
        rows = rows.withColumn("cluster", F.coalesce(F.nullif(F.split("source", "\1")[1], F.lit("")).cast("long"), F.col("cluster"))
                               ).withColumn("source", F.split("source", "\1")[0])
    else:
        rows = sized.drop("given").mapInArrow(_measure, "id long, source string, n_words long, cluster long")
    rows = frozen(rows.withColumn("row", F.monotonically_increasing_id()), "packing-rows")
    blocks = max(8, -(-rows.count() // block_docs))
    # rows of one id (or none) and length go to one block, unless they are more than a block holds: there
    # are at most n / block_docs such pairs
    many = rows.groupBy("id", "n_words").count().where(F.col("count") > block_docs).select(
        F.col("id").alias("_id"), F.col("n_words").alias("_n"), F.lit(True).alias("many"))
    rows = rows.join(F.broadcast(many), F.col("id").eqNullSafe(F.col("_id")) & (F.col("n_words") == F.col("_n")), "left")
    dealt = F.when(F.col("many"), F.xxhash64("row")).otherwise(F.xxhash64("id", "n_words"))
    rows = rows.select(F.col("id").alias(id_col), "source", "n_words", "cluster", F.pmod(dealt, F.lit(blocks)).alias("block"))
    return rows.groupBy("block").applyInPandas(
        lambda pdf: _pack(pdf, id_col, capacity),
        f"{id_col} long, piece long, n_pieces long, n_words long, bin_id long, bin_words long, bin_docs long")


def op3_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
