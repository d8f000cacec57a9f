"""Candidate groups from bucket keys, and exact checks inside them.

Rows of a similarity join meet in buckets (``key``, ``id``). Members of a bucket are tied to its first
member by *star edges*, never to each other, so the number of edges is linear in the rows. Every task
ties what it has seen before anything is shuffled and sends on one row per bucket, so a bucket that
very many rows share costs one row per task. Connected components of the star edges are the candidate
groups: any two rows that share a bucket are in one group. Inside a group all pairs that sizes allow
are then checked, in tiles of bounded size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlytics.llm.common import components, frozen

KEY, EDGE = 0, 1
FLUSH = 2_000_000  # bucket rows a task holds
TILE, TILE_BYTES = 1024, 16 << 20


def star(keys: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bucket keys, their first ids, edge from, edge to) of rows (key, id)."""
    order = np.lexsort((ids, keys))
    keys, ids = keys[order], ids[order]
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    first = ids[np.flatnonzero(new)][np.cumsum(new) - 1]
    other = first != ids
    return keys[new], ids[new], first[other], ids[other]


def distinct_edges(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(a):
        return a, b
    pairs = np.unique(np.stack([a, b], 1), axis=0)
    return pairs[:, 0], pairs[:, 1]


def _rows(kind: int, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(a), kind, np.int8), pa.int8()), pa.array(a, pa.int64()),
                                       pa.array(b, pa.int64())], names=["kind", "a", "b"])


class StarBuffer:
    """Gathers (key, id) rows of one task and ties them before they are shuffled."""

    def __init__(self):
        self.keys, self.ids, self.n = [], [], 0

    def add(self, keys: np.ndarray, ids: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.keys.append(keys)
        self.ids.append(ids)
        self.n += len(keys)
        if self.n >= FLUSH:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.n:
            keys, firsts, a, b = star(np.concatenate(self.keys), np.concatenate(self.ids))
            self.__init__()
            for at in range(0, len(keys), 100_000):
                yield _rows(KEY, keys[at:at + 100_000], firsts[at:at + 100_000])
            a, b = distinct_edges(a, b)
            for at in range(0, len(a), 100_000):
                yield _rows(EDGE, a[at:at + 100_000], b[at:at + 100_000])


def tie_sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges of rows sorted by (kind, a, b); one open bucket is carried from batch to batch."""
    key = first = None
    for batch in batches:
        kind, a, b = (np.asarray(c) for c in batch.columns)
        own = kind == KEY
        if (~own).any():
            yield _rows(EDGE, a[~own], b[~own])
        a, b = a[own], b[own]
        if not len(a):
            continue
        new = np.ones(len(a), bool)
        new[1:] = a[1:] != a[:-1]
        firsts = b[np.flatnonzero(new)]
        if key is not None and a[0] == key:
            firsts[0] = first
        of = firsts[np.cumsum(new) - 1]
        key, first = a[-1], of[-1]
        other = of != b
        yield _rows(EDGE, *distinct_edges(np.minimum(of, b)[other], np.maximum(of, b)[other]))


def candidate_groups(edges: DataFrame, name: str) -> DataFrame:
    """(id, grp) of all ids that share a bucket with another."""
    return components(edges, name).select("id", F.col("comp").alias("grp"))


def tiled(members: DataFrame, payload: str, band_col: str = "band", tile: int = TILE, name: str = "tiles") -> DataFrame:
    """Deal members (id, grp, band, ``payload``, ...) of candidate groups into tiles that together hold every
    pair of equal or neighbouring bands once.

    A group of up to ``tile`` members and ``TILE_BYTES`` of payload is one tile. A larger one is cut by band
    and by a hash of the id into cells of about that size, and each pair of cells is a tile. Tiles are
    worked out on ids alone; the payload is moved once to its tiles. Adds tile (string) and side: 0 and 1
    are the two cells of a tile, 2 marks members that all meet.
    """
    ids = members.select("id", "grp", band_col, F.octet_length(payload).cast("long").alias("bytes"))
    cells = frozen(ids.groupBy("grp", band_col).agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes")), f"{name}-cells")
    big = cells.groupBy("grp").agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes")).where(
        (F.col("n") > tile) | (F.col("bytes") > TILE_BYTES)).select("grp")
    cuts = frozen(cells.join(big, "grp").select("grp", F.col(band_col).alias("b"), F.greatest(
        F.ceil(F.col("n") / tile), F.ceil(F.col("bytes") / TILE_BYTES)).cast("int").alias("cells")), f"{name}-cuts")

    def cut_of(shift: int, as_: str) -> DataFrame:
        return cuts.select(F.col("grp").alias("g2"), (F.col("b") - shift).alias("b2"), F.col("cells").alias(as_))

    m = ids.drop("bytes")
    for shift, as_ in ((0, "here"), (1, "above"), (-1, "below")):
        c = cut_of(shift, as_)
        m = m.join(c, (m["grp"] == c["g2"]) & (m[band_col] == c["b2"]), "left").drop("g2", "b2")
    m = m.withColumn("cell", F.pmod(F.xxhash64("id", F.lit(17)), F.coalesce("here", F.lit(1))).cast("int"))
    label = lambda b1, c1, b2, c2: F.concat_ws(":", F.col("grp").cast("string"), b1, c1, b2, c2)
    span = lambda n: F.sequence(F.lit(0), n - 1)
    band = F.col(band_col).cast("string")
    up, down = (F.col(band_col) + 1).cast("string"), (F.col(band_col) - 1).cast("string")
    cell = F.col("cell").cast("string")
    spots = F.when(F.col("here").isNull(), F.array(F.struct(F.col("grp").cast("string").alias("tile"), F.lit(2).alias("side")))).otherwise(F.concat(
        F.transform(span(F.coalesce("here", F.lit(1))), lambda o: F.struct(
            F.when(o < F.col("cell"), label(band, o.cast("string"), band, cell)).otherwise(
                label(band, cell, band, o.cast("string"))).alias("tile"),
            F.when(o == F.col("cell"), 2).when(o < F.col("cell"), 1).otherwise(0).alias("side"))),
        F.when(F.col("above") > 0, F.transform(span(F.col("above")), lambda o: F.struct(
            label(band, cell, up, o.cast("string")).alias("tile"), F.lit(0).alias("side")))).otherwise(F.array()),
        F.when(F.col("below") > 0, F.transform(span(F.col("below")), lambda o: F.struct(
            label(down, o.cast("string"), band, cell).alias("tile"), F.lit(1).alias("side")))).otherwise(F.array())))
    spots = m.select("id", F.explode(spots).alias("spot")).select("id", "spot.tile", "spot.side")
    return members.join(spots, "id")


def per_tile(tiles: DataFrame, work: Callable[[pa.Table], list[tuple]], columns: list[str]) -> DataFrame:
    """Rows (of longs) that ``work`` makes of each tile. It gets the tile's members, distinct and sorted by
    id; a tile of one member has no pairs and is passed over. Tiles are read one after another from
    sorted partitions, so a task holds one tile at a time.
    """

    def rows_of(parts: list[pa.RecordBatch]) -> list[tuple]:
        if sum(p.num_rows for p in parts) < 2:
            return []
        tile = pa.Table.from_batches(parts)
        first = np.unique(np.asarray(tile["id"]), return_index=True)[1]
        return work(tile.take(first)) if len(first) > 1 else []

    def run(batches):
        name, held = None, []
        for batch in batches:
            names, found = np.array(batch.column(0).to_pylist(), object), []
            starts = [0, *(np.flatnonzero(names[1:] != names[:-1]) + 1).tolist(), batch.num_rows]
            for a, b in zip(starts, starts[1:]):
                if a == b:
                    continue
                if names[a] != name:
                    found.extend(rows_of(held))
                    name, held = names[a], []
                held.append(batch.slice(a, b - a))
            yield _longs(found, columns)
        yield _longs(rows_of(held), columns)

    dealt = tiles.select("tile", *(c for c in tiles.columns if c != "tile")).repartition("tile").sortWithinPartitions("tile")
    return dealt.mapInArrow(run, ", ".join(f"{c} long" for c in columns))


def _longs(rows: list[tuple], columns: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in range(len(columns))], names=columns)


class Union:
    """Union by smallest index, for the members of one tile."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        self.up[max(i, j)] = min(i, j)
        return i != j
