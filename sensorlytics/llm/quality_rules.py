"""Quality rules with cross-document line frequency.

Per document: word counts and the base rules (too short, too many repeated 8-word windows). Across
documents: every line is normalised (A-Z lower-cased, white space runs to one blank) and hashed; for
each host (``source``) the distinct documents that hold a line are counted, exact copies of a text
counting as one document. Lines in more than ``max(min_docs, max_share * documents of the host)`` are
removed, and a document that loses more than ``max_lost`` of its words to that is depleted and
rejected, as is one that fails the base rules.

Null text has no lines and no words (it fails the base rule on length); a null host is a host of its
own. Repeated rows each get their result. An empty table gives an empty result. Documents of any
length are taken whole, one at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlytics.llm.common import frozen, small_batches, split_heavy, table, utf8

MIN_DOCS, MAX_SHARE, MAX_LOST = 20, 0.10, 0.50
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 20, 30, 8
SYMBOLS = b"#*$%&|<>"


def repeated_words(word_ids: np.ndarray, window: int = WINDOW) -> int:
    """Words inside windows of ``window`` words that occur twice or more in the text.

    Windows are named exactly by doubling: pairs of names get a name of their own, so two windows
    share a name only if all their words agree.
    """
    n = len(word_ids) - window + 1
    if n < 2:
        return 0
    names, span = word_ids.astype(np.int64), 1
    while span < window:
        step = min(span, window - span)
        top = int(names.max()) + 1
        pair = names[:len(names) - step] * top + names[step:]
        names = np.unique(pair, return_inverse=True)[1]
        span += step
    names = names[:n]
    often = np.flatnonzero(np.bincount(names)[names] > 1)
    if not len(often):
        return 0
    edge = np.zeros(len(word_ids) + 1, np.int64)
    np.add.at(edge, often, 1)
    np.add.at(edge, often + window, -1)
    return int(np.count_nonzero(np.cumsum(edge[:-1]) > 0))


def describe(text: bytes) -> dict:
    """Base counts of one text, and (hash, words) of each line that has a word."""
    words = text.split()
    names: dict[bytes, int] = {}
    ids = np.fromiter((names.setdefault(w, len(names)) for w in words), np.int64, len(words))
    lines, seen, dup = [], set(), 0
    for raw in text.split(b"\n"):
        parts = raw.split()
        if parts:
            if raw in seen:
                dup += 1
            seen.add(raw)
            lines.append((xxhash.xxh64_intdigest(b" ".join(parts).lower()) - 2**63, len(parts)))
    packed = b"".join(words)
    return {"n_words": len(words), "word_chars": len(packed.decode("utf-8", "surrogatepass")),
            "n_symbols": len(text) - len(text.translate(None, SYMBOLS)), "n_dup_lines": dup,
            "n_repeat_words": repeated_words(ids), "lines": lines}


_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _describe_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small_batches(batches, "text"):
        found = [describe(t) for t in utf8(batch.column(2))]
        keys = pa.array([xxhash.xxh64_intdigest(t) - 2**63 for t in utf8(batch.column(2))], pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), keys,
             *(pa.array([d[c] for d in found], pa.int64()) for c in _COUNTS),
             pa.array([[h for h, _ in d["lines"]] for d in found], pa.list_(pa.int64())),
             pa.array([[n for _, n in d["lines"]] for d in found], pa.list_(pa.int32()))],
            names=["doc_id", "host", "text_key", *_COUNTS, "line", "line_words"])


def described(docs: DataFrame, id_col: str, text_col: str, host_col: str) -> DataFrame:
    """One row per input row with its base counts and line hashes; texts are read here only."""
    return frozen(docs.select(F.col(id_col).cast("long").alias("doc_id"),
                              F.coalesce(F.col(host_col).cast("string"), F.lit("\0null")).alias("host"),
                              F.col(text_col).cast("string").alias("text")).mapInArrow(
        _describe_batches, "doc_id long, host string, text_key long, n_words long, word_chars long, n_symbols long,"
                           " n_dup_lines long, n_repeat_words long, line array<long>, line_words array<int>"), "lines")


def frequent_lines(rows: DataFrame, min_docs: int = MIN_DOCS, max_share: float = MAX_SHARE) -> DataFrame:
    """Lines above their host's limit: (host, line, docs)."""
    hosts = rows.groupBy("host", "text_key").count().groupBy("host").agg(F.count(F.lit(1)).alias("host_docs"))
    lines = (rows.select("host", "text_key", F.explode("line").alias("line"))
             .groupBy("host", "line", "text_key").count()
             .groupBy("host", "line").agg(F.count(F.lit(1)).alias("docs")).where(F.col("docs") > min_docs))
    return lines.join(hosts, "host").where(F.col("docs") > F.col("host_docs") * max_share).select("host", "line", "docs")


def document_verdicts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
                      min_docs: int = MIN_DOCS, max_share: float = MAX_SHARE, max_lost: float = MAX_LOST) -> DataFrame:
    """Per row: the counts, base_failed, kept, and the words and lines that line frequency removed."""
    rows = described(docs, id_col, text_col, host_col)
    above = frozen(frequent_lines(rows, min_docs, max_share), "frequent-lines")
    total = above.agg(F.coalesce(F.sum("docs"), F.lit(0))).first()[0]
    exploded = rows.where(F.size("line") > 0).select(
        "host", "text_key", F.explode(F.arrays_zip("line", "line_words")).alias("l")).groupBy(
        "host", "text_key", F.col("l.line").alias("line"), F.col("l.line_words").alias("line_words")).agg(
        F.count(F.lit(1)).alias("seen"))
    heavy, rest = split_heavy(above, "docs", total)
    hit = exploded.join(F.broadcast(heavy.select("host", "line")), ["host", "line"]).unionByName(
        exploded.join(rest.select("host", "line").hint("shuffle_merge"), ["host", "line"]))
    copies = rows.groupBy("host", "text_key").agg(F.count(F.lit(1)).alias("copies"))
    lost = (hit.groupBy("host", "text_key").agg(F.sum(F.col("seen") * F.col("line_words")).alias("w"), F.sum("seen").alias("n"))
            .join(copies, ["host", "text_key"])
            .select("host", "text_key", (F.col("w") / F.col("copies")).cast("long").alias("removed_words"),
                    (F.col("n") / F.col("copies")).cast("long").alias("removed_lines")))
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)
    return rows.drop("line", "line_words").join(lost, ["host", "text_key"], "left").select(
        F.col("doc_id").alias(id_col), *_COUNTS, failed.alias("base_failed"),
        (~failed & (F.coalesce("removed_words", F.lit(0)) <= F.col("n_words") * max_lost)).alias("kept"),
        F.coalesce("removed_words", F.lit(0)).alias("removed_words"),
        F.coalesce("removed_lines", F.lit(0)).alias("removed_lines"))


def without_frequent_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
                           min_docs: int = MIN_DOCS, max_share: float = MAX_SHARE) -> DataFrame:
    """The documents with their lines above the limit cut out of ``text_col``; other columns stay.

    A document's own frequent lines travel to it as a list (no longer than its lines).
    """
    rows = described(docs, id_col, text_col, host_col)
    above = frozen(frequent_lines(rows, min_docs, max_share), "frequent-lines")
    per_text = (rows.select("host", "text_key", F.explode(F.array_distinct("line")).alias("line")).distinct()
                .join(above.select("host", "line"), ["host", "line"])
                .groupBy("host", "text_key").agg(F.collect_list("line").alias("_cut")))
    ids = rows.select("doc_id", "host", "text_key").distinct().join(per_text, ["host", "text_key"]).select(
        F.col("doc_id").alias("_id"), F.col("host").alias("_host"), "_cut").dropDuplicates(["_id", "_host"])

    def cut(batches):
        for batch in small_batches(batches, text_col):
            at, cuts = batch.schema.get_field_index(text_col), batch.column(batch.schema.get_field_index("_cut")).to_pylist()
            out = []
            for raw, gone in zip(batch.column(at).to_pylist(), cuts):
                if raw is not None and gone:
                    gone = set(gone)
                    raw = "\n".join(x for x in raw.split("\n") if not x.encode().split() or xxhash.xxh64_intdigest(
                        b" ".join(x.encode().split()).lower()) - 2**63 not in gone)
                out.append(raw)
            cols = [pa.array(out, pa.string()) if i == at else c for i, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays(cols, names=batch.schema.names)

    with_cuts = docs.withColumn(text_col, F.col(text_col).cast("string")).join(
        ids, (docs[id_col].cast("long").eqNullSafe(F.col("_id")))
        & (F.coalesce(docs[host_col].cast("string"), F.lit("\0null")) == F.col("_host")), "left").drop("_id", "_host")
    return with_cuts.mapInArrow(cut, with_cuts.schema).drop("_cut")


def op9_quality_rules(spark, sf_dir: str) -> DataFrame:
    return document_verdicts(table(spark, sf_dir, "documents"))


#: DuckDB SQL for the rows of ``op9_quality_rules``.
ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(source, 'null host') AS host, text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws
  FROM documents
), w AS (
  SELECT rid, len(ws) AS n, unnest(range(1, len(ws) - 6)) AS pos, ws FROM d WHERE len(ws) >= 8
), again AS (
  SELECT rid, pos, count(*) OVER (PARTITION BY rid, array_to_string(ws[pos:pos + 7], ' ')) AS times FROM w
), repeated AS (
  SELECT rid, count(DISTINCT word) AS n FROM (SELECT rid, unnest(range(pos, pos + 8)) AS word FROM again WHERE times > 1) GROUP BY rid
), raw AS (
  SELECT rid, host, coalesce(text, '') AS text, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM d
), lines AS (
  SELECT rid, host, text, line, len(parts) AS n, translate(array_to_string(parts, ' '),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
  FROM (SELECT *, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS parts FROM raw) WHERE len(parts) > 0
), dup AS (
  SELECT rid, count(*) - count(DISTINCT line) AS n FROM lines GROUP BY rid
), hosts AS (
  SELECT host, count(DISTINCT coalesce(text, '')) AS docs FROM d GROUP BY host
), above AS (
  SELECT host, norm FROM (SELECT host, norm, count(DISTINCT text) AS docs FROM lines GROUP BY host, norm) l
  JOIN hosts USING (host) WHERE l.docs > MIN_DOCS AND l.docs > hosts.docs * MAX_SHARE
), lost AS (
  SELECT rid, sum(n) AS words, count(*) AS lines FROM lines JOIN above USING (host, norm) GROUP BY rid
), base AS (
  SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
         CAST(length(coalesce(text, '')) - length(regexp_replace(coalesce(text, ''), '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(dup.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(repeated.n, 0) AS BIGINT) AS n_repeat_words,
         len(ws) < 20 OR 100 * coalesce(repeated.n, 0) > 30 * len(ws) AS base_failed,
         CAST(coalesce(lost.words, 0) AS BIGINT) AS removed_words, CAST(coalesce(lost.lines, 0) AS BIGINT) AS removed_lines
  FROM d LEFT JOIN dup USING (rid) LEFT JOIN repeated USING (rid) LEFT JOIN lost USING (rid)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND removed_words <= n_words * MAX_LOST AS kept, removed_words, removed_lines
FROM base
""".replace("MIN_DOCS", str(MIN_DOCS)).replace("MAX_SHARE", str(MAX_SHARE)).replace("MAX_LOST", str(MAX_LOST))
