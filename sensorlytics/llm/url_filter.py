"""URL filter over a sorted digest array.

Each entry of a list (a ``host/path`` prefix) is kept as its 64-bit xxhash in one sorted array,
written with the full strings to a file that every task maps into memory. A url asks for all its
keys (each suffix of its host by labels, each prefix of its path that can matter) in one vectorised
binary search per batch, and each hit is confirmed against the stored string, so a hash collision
never decides.

A list of up to ``max_index_bytes`` goes to the executors as a broadcast file; a larger one is dealt
into segments by digest, and distinct url keys meet their segment by a shuffle (``probe_dealt``).

Nulls: a null url, or one without ``://``, has an empty host and path and matches nothing. Repeated
rows and ids give one result each; an empty table gives an empty result; columns other than the id
and the url are not read.
"""

from __future__ import annotations

import mmap
import os
import struct
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlytics.llm.common import table

#: (host, path, verdict) of the contract: fixed values.
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"),
         ("org", "/fr/", "allow")]
#: Hosts on the method's own block list where no rule fits (fixed values, a parameter).
BLOCKED_HOSTS = ["ads-track.example.com", "spam-farm.example.com", "casino-win.example.com"]
MAX_INDEX_BYTES = 64 << 20


def build_index(entries: list[tuple[str, str]]) -> bytes:
    """File image of a list of (key, value): count, path lengths, sorted digests, offsets, strings.

    Equal keys: the last one given wins.
    """
    pairs = sorted((xxhash.xxh64_intdigest(k.encode()), k.encode(), v.encode()) for k, v in dict(entries).items())
    digests = np.array([d for d, _, _ in pairs], "<u8")
    offsets, blob = [0], bytearray()
    for _, k, v in pairs:
        blob += struct.pack("<I", len(k)) + k + v
        offsets.append(len(blob))
    lengths = sorted({len(k) - k.index("/") if "/" in k else 0 for k in (k.decode() for _, k, _ in pairs)})
    head = struct.pack("<QQ", len(pairs), len(lengths)) + np.array(lengths, "<u8").tobytes()
    return head + digests.tobytes() + np.array(offsets, "<u8").tobytes() + bytes(blob)


class DigestArray:
    """The memory-mapped list of ``build_index``."""

    def __init__(self, buf):
        n, m = struct.unpack_from("<QQ", buf, 0)
        at = 16
        self.path_lengths = np.frombuffer(buf, "<u8", m, at).tolist()
        at += 8 * m
        self.digests = np.frombuffer(buf, "<u8", n, at)
        self.offsets = np.frombuffer(buf, "<u8", n + 1, at + 8 * n)
        self.strings, self.base = buf, at + 8 * n + 8 * (n + 1)

    def entry(self, slot: int) -> tuple[bytes, bytes]:
        a, b = self.base + int(self.offsets[slot]), self.base + int(self.offsets[slot + 1])
        (k,) = struct.unpack_from("<I", self.strings, a)
        return bytes(self.strings[a + 4:a + 4 + k]), bytes(self.strings[a + 4 + k:b])

    def probe(self, keys: list[bytes]) -> list[bytes | None]:
        """Value of each key, or None: binary search over all keys at once, then string checks."""
        if not keys or not len(self.digests):
            return [None] * len(keys)
        want = np.fromiter((xxhash.xxh64_intdigest(k) for k in keys), np.uint64, len(keys))
        lo, hi = np.searchsorted(self.digests, want, "left"), np.searchsorted(self.digests, want, "right")
        out: list[bytes | None] = [None] * len(keys)
        for i in np.flatnonzero(hi > lo).tolist():
            for slot in range(lo[i], hi[i]):  # more than one only where digests collide
                key, value = self.entry(slot)
                if key == keys[i]:
                    out[i] = value
                    break
        return out


_MAPPED: dict[str, DigestArray] = {}


def mapped(image: bytes) -> DigestArray:
    """The list as a memory-mapped file in the task's own temporary folder, written once per executor
    from the broadcast copy (any new executor writes its own)."""
    name = f"digests-{xxhash.xxh64_hexdigest(image)}-{len(image)}.bin"
    if name not in _MAPPED:
        path = os.path.join(tempfile.gettempdir(), name)
        if not os.path.exists(path):
            part = f"{path}.{uuid.uuid4().hex}"
            with open(part, "wb") as f:
                f.write(image)
            os.replace(part, path)
        with open(path, "rb") as f:
            _MAPPED[name] = DigestArray(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ))
    return _MAPPED[name]


_UPPER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def host_path(url: str | None) -> tuple[str, str]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: from
    there up to ``?``, ``#`` or the end."""
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    cut = min((i for i in (rest.find(c) for c in "/?#") if i >= 0), default=len(rest))
    path = rest[cut:]
    end = min((i for i in (path.find(c) for c in "?#") if i >= 0), default=len(path))
    return rest[:cut].translate(_UPPER), path[:end]


def keys_of(host: str, path: str, path_lengths: list[int]) -> list[str]:
    """All list keys that can fit, longest host first, and for one host the longest path first."""
    if not host:
        return []
    labels = host.split(".")
    ends = [path[:n] for n in sorted(path_lengths, reverse=True) if n <= len(path)]
    return [".".join(labels[i:]) + e for i in range(len(labels)) for e in ends]


def probe_batches(image, batches: Iterator[pa.RecordBatch], id_col: str) -> Iterator[pa.RecordBatch]:
    index = mapped(image.value)
    for batch in batches:
        ids, urls = batch.column(0), batch.column(1).to_pylist()
        parts = [host_path(u) for u in urls]
        asked = [keys_of(h, p, index.path_lengths) for h, p in parts]
        flat = list(dict.fromkeys(k for ks in asked for k in ks))
        found = dict(zip(flat, index.probe([k.encode() for k in flat])))
        rules, verdicts = [], []
        for ks in asked:
            hits = [(k, found[k]) for k in ks if found[k] is not None]
            hit = max(hits, key=lambda h: (h[1].endswith(b"!"), len(h[0])), default=None)
            rule = hit is not None and hit[1].endswith(b"!")
            rules.append(hit[0] if rule else None)
            verdicts.append(hit[1].rstrip(b"!").decode() if hit else "allow")
        yield pa.RecordBatch.from_arrays(
            [ids, pa.array([h for h, _ in parts], pa.string()), pa.array([p for _, p in parts], pa.string()),
             pa.array(rules, pa.string()), pa.array(verdicts, pa.string())],
            names=[id_col, "host", "path", "rule", "verdict"])


def entries_of(rules=RULES, blocked_hosts=BLOCKED_HOSTS) -> list[tuple[str, str]]:
    """List entries: a rule's value ends in ``!`` and outranks every plain entry."""
    own = [(h + "/", "block") for h in blocked_hosts]
    return own + [(h + p, v + "!") for h, p, v in rules]


def url_verdicts(pages: DataFrame, entries: list[tuple[str, str]] | None = None, id_col: str = "page_id",
                 url_col: str = "url") -> DataFrame:
    """Per url: id, host, path, the rule that fits (or null) and the verdict.

    The longest rule wins; without a rule the block list decides; without either the url is allowed.
    """
    image = build_index(entries_of() if entries is None else entries)
    if len(image) > MAX_INDEX_BYTES:
        raise ValueError("the list exceeds max_index_bytes: give it as a table to probe_dealt")
    shared = pages.sparkSession.sparkContext.broadcast(image)
    kind = dict(pages.dtypes)[id_col]
    return pages.select(F.col(id_col), F.col(url_col).cast("string").alias("url")).mapInArrow(
        lambda it: probe_batches(shared, it, id_col),
        f"{id_col} {kind}, host string, path string, rule string, verdict string")


def probe_dealt(keys: DataFrame, entries: DataFrame, segment_entries: int = 1_000_000) -> DataFrame:
    """For lists of any size: which distinct ``key`` of ``keys`` are in ``entries`` (key, value).

    Both sides are dealt by key digest into segments of about ``segment_entries`` list rows; a
    segment's task sorts its digests into the same array and probes its keys. Returns (key, value).
    Null keys match nothing.
    """
    n = max(8, -(-entries.count() // segment_entries))
    seg = F.pmod(F.xxhash64("key"), F.lit(n)).alias("seg")
    mine = entries.where("key IS NOT NULL").groupBy("key").agg(F.max("value").alias("value")).select(seg, "key", "value")
    asked = keys.select("key").where("key IS NOT NULL").distinct().select(seg, "key")

    def probe(left, right):
        index = DigestArray(build_index(list(zip(left["key"], left["value"]))))
        found = index.probe([k.encode() for k in right["key"]])
        right = right.assign(value=[None if v is None else v.decode() for v in found])
        return right.loc[right["value"].notna(), ["key", "value"]]

    return mine.groupBy("seg").cogroup(asked.groupBy("seg")).applyInPandas(probe, "key string, value string")


def op8_url_filter(spark, sf_dir: str) -> DataFrame:
    return url_verdicts(table(spark, sf_dir, "pages"))


ORACLE = """
WITH u AS (
  SELECT page_id, CASE WHEN contains(coalesce(url, ''), '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
h AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(regexp_extract(rest, '^([^/?#]*)', 1)) + 1), '^([^?#]*)', 1) AS path
  FROM u),
r AS (SELECT * FROM (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'),
                            ('org', '/fr/', 'allow')) t(rh, rp, rv)),
m AS (
  SELECT h.page_id, arg_max(rh || rp, length(rh || rp)) AS rule, arg_max(rv, length(rh || rp)) AS rv
  FROM h JOIN r ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY h.page_id),
b AS (SELECT * FROM (VALUES ('ads-track.example.com'), ('spam-farm.example.com'), ('casino-win.example.com')) t(bh))
SELECT h.page_id, host, path, rule,
       coalesce(rv, CASE WHEN EXISTS (SELECT 1 FROM b WHERE (host = bh OR ends_with(host, '.' || bh)) AND starts_with(path, '/'))
                         THEN 'block' ELSE 'allow' END) AS verdict
FROM h LEFT JOIN m USING (page_id)
"""
