"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorlytics.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def frozen(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared checkpoint folder and read it back: cuts lineage and
    survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def utf8(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    """The column's texts as UTF-8; null counts as empty. ``bytes.split()`` cuts them at exactly the bytes
    20 and 09 to 0D, and ``bytes.lower()`` changes A-Z only, as the contracts ask."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def small_batches(batches: Iterable[pa.RecordBatch], column: str, limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds about ``limit`` bytes of ``column`` (one row at least)."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        col = batch.column(batch.schema.get_field_index(column))
        sizes = np.asarray(pc.fill_null(pc.binary_length(col), 0), dtype=np.int64)
        part = (np.cumsum(sizes) // limit)
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                yield batch.slice(a, b - a)


def fold_of(doc_id, modulus: int) -> int:
    """crc32 of the id's decimal text, modulo ``modulus`` (the fold rule of the contracts)."""
    return zlib.crc32(str(doc_id).encode()) % modulus


def fold(col, modulus: int):
    """The same in SQL; a null id falls into fold -1, which no rule holds out."""
    return F.coalesce(F.crc32(col.cast("string").cast("binary")) % modulus, F.lit(-1))


def mix64(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finaliser: multiply, shift, xor."""
    with np.errstate(over="ignore"):
        z = x.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & (2**64 - 1))
        z = (z ^ (z >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
        return z ^ (z >> np.uint64(33))


def split_heavy(flags: DataFrame, count_col: str, total: int, most: int = 5000) -> tuple[DataFrame, DataFrame]:
    """Keys in a table of key counts, as (heavy, rest).

    ``total`` is the sum of the counts, so at most ``most`` keys can have ``total / most`` or more:
    the heavy part's size is proven and may be broadcast; each key of the rest has few rows, so a
    shuffle join on it is even.
    """
    limit = max(1, total // most) if total else 1
    return flags.where(F.col(count_col) > limit), flags.where(F.col(count_col) <= limit)


def most_frequent(counts: DataFrame, key: str, most: int, n: str = "n") -> list[tuple]:
    """At most ``most`` rows (key, n) of a table of counts with the largest counts, largest first (ties by
    key). The cut is a count, found from how many keys have which count, so tasks send only rows that
    stay: keys tied at the cut are all left out if they don't fit."""
    left, cut = most, None
    sizes = counts.groupBy(n).count().orderBy(F.col(n).desc())
    for size, keys in sizes.limit(most).collect():
        if keys > left:
            break
        left, cut = left - keys, size
    if cut is None:
        return []
    rows = counts.where(F.col(n) >= cut).select(key, n).collect()
    return sorted(((bytes(k) if isinstance(k, bytearray) else k, c) for k, c in rows), key=lambda r: (-r[1], r[0]))


def components(edges: DataFrame, name: str = "cc") -> DataFrame:
    """Connected components of undirected ``edges`` (a, b): rows (id, comp), ``comp`` the smallest id.

    Each round hooks every vertex to its smallest neighbour, follows the hooks to their roots by
    pointer jumping, and contracts the edges; contracted edges shrink until none is left. All state
    is in tables; only row counts reach the driver.
    """
    spark = edges.sparkSession
    cur = frozen(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                 .where("a < b").distinct(), f"{name}-edges")
    labels = None
    while cur.head(1):
        both = cur.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            cur.select(F.col("b").alias("u"), F.col("a").alias("v")))
        hook = frozen(both.groupBy("u").agg(F.min("v").alias("m"))
                      .select("u", F.least("u", "m").alias("p")), f"{name}-hook")
        while True:  # pointer jumping: p <- p(p)
            up = hook.select(F.col("u").alias("p"), F.col("p").alias("pp"))
            moved = frozen(hook.join(up, "p", "left").select(
                "u", F.coalesce("pp", "p").alias("p"), (F.col("pp") < F.col("p")).alias("moved")), f"{name}-jump")
            hook = moved.select("u", "p")
            if not moved.where("moved").head(1):
                break
        if labels is None:
            labels = hook.select(F.col("u").alias("id"), F.col("p").alias("comp"))
        else:
            old = labels.select("id", F.col("comp").alias("u"))
            labels = frozen(old.join(hook, "u", "left").select("id", F.coalesce("p", "u").alias("comp")),
                            f"{name}-labels")
        a = hook.select(F.col("u").alias("a"), F.col("p").alias("pa"))
        b = hook.select(F.col("u").alias("b"), F.col("p").alias("pb"))
        cur = frozen(cur.join(a, "a").join(b, "b").select(F.least("pa", "pb").alias("a"),
                                                         F.greatest("pa", "pb").alias("b"))
                     .where("a < b").distinct(), f"{name}-edges")
    if labels is None:
        return spark.createDataFrame([], "id long, comp long").select(
            F.col("id").cast(dict(edges.dtypes)["a"]).alias("id"), F.col("comp").cast(dict(edges.dtypes)["a"]).alias("comp"))
    return labels
