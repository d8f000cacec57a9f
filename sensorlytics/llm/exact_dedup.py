"""Exact deduplication through a minimal perfect hash over the digests seen before.

Rows are reduced to SHA-256 digests. The *history* (rows up to an id watermark, as an earlier run
would have stored them) is grouped by digest and dealt by digest into shards; each shard holds a
minimal perfect hash of its distinct digests, and every slot holds the full digest, the winner's
locator (its doc_id) and the number of rows. The later rows, pre-grouped by digest, are looked up in
their shard: the hash names one slot, and its 32 bytes decide. Members join the stored group;
nonmembers form groups of their own.

The hash has levels of bit arrays: at each level the keys that land alone keep their place, the
others go on; the rank of a key's bit is its slot.

Null text counts as empty. Groups of any size are counted map-side before each shuffle, so a text
that a third of the rows share costs one row per task. The winner is the largest doc_id; a null
doc_id never wins unless the whole group has none (then keep_id is null and kept is false). Rows
that repeat the winner's id are all marked kept. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlytics.llm.common import frozen, mix64, table

#: Distinct digests a shard is sized for (48 bytes each).
SHARD_KEYS = 50_000


class PerfectHash:
    """Minimal perfect hash of distinct 64-bit key pairs, built and asked in numpy."""

    GAMMA = 1.6

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self.ranks, base = [], 0
        for bits in levels:
            self.ranks.append(base + np.cumsum(bits, dtype=np.int64) - bits)
            base += int(bits.sum())

    @staticmethod
    def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mix64(keys[:, level % keys.shape[1]], level + 1) % np.uint64(size)).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        levels, level = [], 0
        while len(keys):
            size = max(8, int(cls.GAMMA * len(keys)))
            at = cls._place(keys, level, size)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(alone)
            keys = keys[~alone[at]]
            level += 1
            if level > 200:
                raise ValueError("keys are not distinct")
        return cls(levels)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; -1 for keys that no level takes (no members)."""
        out = np.full(len(keys), -1, np.int64)
        rest = np.arange(len(keys))
        for level, bits in enumerate(self.levels):
            at = self._place(keys[rest], level, len(bits))
            hit = bits[at]
            out[rest[hit]] = self.ranks[level][at[hit]]
            rest = rest[~hit]
            if not len(rest):
                break
        return out

    def to_bytes(self) -> bytes:
        sizes = np.array([len(self.levels), *map(len, self.levels)], "<i8")
        return sizes.tobytes() + b"".join(np.packbits(b).tobytes() for b in self.levels)

    @classmethod
    def from_bytes(cls, raw: bytes) -> PerfectHash:
        n = int(np.frombuffer(raw, "<i8", 1)[0])
        sizes, at, levels = np.frombuffer(raw, "<i8", n, 8), 8 + 8 * n, []
        for s in sizes.tolist():
            size = (s + 7) // 8
            levels.append(np.unpackbits(np.frombuffer(raw, np.uint8, size, at))[:s].astype(bool))
            at += size
        return cls(levels)


def _keys(digests) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(b"".join(digests), np.uint8).reshape(-1, 32)
    return raw, np.ascontiguousarray(raw).view("<u8").reshape(-1, 4)


def build_index(grouped: DataFrame) -> DataFrame:
    """One row per shard from (shard, digest, winner, n): the hash, the digests by slot, and per slot
    the winner's id (null where the group has none) and the row count."""

    def build(key, pdf: pd.DataFrame) -> pd.DataFrame:
        raw, keys = _keys(pdf["digest"])
        ph = PerfectHash.build(keys)
        slot = ph.slots(keys)
        order = np.argsort(slot)
        winner = pdf["winner"].astype("Int64")
        return pd.DataFrame([{"shard": key[0], "hash": ph.to_bytes(), "digests": raw[order].tobytes(),
                              "winners": [None if w is pd.NA else int(w) for w in winner.iloc[order]],
                              "counts": pdf["n"].to_numpy()[order].tolist()}])

    return grouped.groupBy("shard").applyInPandas(
        build, "shard long, hash binary, digests binary, winners array<long>, counts array<long>")


def probe(index: DataFrame, fresh: DataFrame) -> DataFrame:
    """Groups over history and fresh rows: (digest, keep_id, group_size).

    ``fresh`` has (shard, digest, winner, n), one row per digest.
    """

    def look(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        new_w = right["winner"].astype("Int64")
        if not len(left):
            return pd.DataFrame({"digest": right["digest"], "keep_id": new_w, "group_size": right["n"]})
        row = left.iloc[0]
        stored = np.frombuffer(row["digests"], np.uint8).reshape(-1, 32)
        keep = pd.array(list(row["winners"]), dtype="Int64")
        size = np.array(row["counts"], np.int64)
        member = np.zeros(len(right), bool)
        if len(right):
            raw, keys = _keys(right["digest"])
            slot = PerfectHash.from_bytes(row["hash"]).slots(keys)
            member = (slot >= 0) & (stored[slot] == raw).all(axis=1)  # all 32 bytes decide
            at, ids = slot[member], new_w[member]
            both = pd.concat([pd.Series(keep[at]).reset_index(drop=True), pd.Series(ids).reset_index(drop=True)], axis=1)
            keep[at] = both.max(axis=1, skipna=True).astype("Int64").array
            size[at] += right["n"].to_numpy()[member]
        old = pd.DataFrame({"digest": [x.tobytes() for x in stored], "keep_id": keep, "group_size": size})
        own = pd.DataFrame({"digest": right["digest"][~member], "keep_id": new_w[~member],
                            "group_size": right["n"][~member]})
        return pd.concat([old, own], ignore_index=True)

    return index.groupBy("shard").cogroup(fresh.groupBy("shard")).applyInPandas(
        look, "digest binary, keep_id long, group_size long")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, keep_id, group_size, kept and the digest of its text (see the module)."""
    rows = frozen(docs.select(F.col(id_col).cast("long").alias("id"), F.unhex(
        F.sha2(F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary"), 256)).alias("digest")), "digests")
    n, lo, hi = rows.agg(F.count(F.lit(1)), F.min("id"), F.max("id")).first()
    shards = max(8, -(-n // SHARD_KEYS))
    mark = (lo + hi) // 2 if lo is not None else 0

    def grouped(part: DataFrame) -> DataFrame:
        return part.groupBy("digest").agg(F.max("id").alias("winner"), F.count(F.lit(1)).alias("n")).select(
            F.pmod(F.xxhash64("digest"), F.lit(shards)).alias("shard"), "digest", "winner", "n")

    index = frozen(build_index(grouped(rows.where(F.col("id") <= mark))), "perfect-hash")
    groups = probe(index, grouped(rows.where((F.col("id") > mark) | F.col("id").isNull())))
    return rows.join(groups, "digest").select(
        F.col("id").alias(id_col), "keep_id", "group_size",
        F.coalesce(F.col("id") == F.col("keep_id"), F.lit(False)).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))


def op2_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


ORACLE = """
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
g AS (SELECT text, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY text)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(text) AS text_sha256 FROM t JOIN g USING (text)
"""
