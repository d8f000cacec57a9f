"""Document fingerprints: SimHash with permuted block tables, in DataFrame expressions only.

*Fingerprint.* A text's terms are its distinct lower-cased words, words beyond 12 letters cut into pieces
of 12 (so that text without blanks has terms too). Each term's xxhash64 votes on 64 signed bits with the
weight of its length. A bit is set where more than half of the weight votes for it. The votes are sums: bits
i and i + 32 share one long, which is exact below 2**32 of weight. Terms of a row stand next to each other, so
the sums are complete before anything is shuffled.

*Radius search.* Fingerprints within ``radius`` bits agree on all but ``radius`` of any blocks. Each of the
block selections is a table with these blocks in front; pairs that meet in a table are compared in full. A
pair that meets in several tables counts in the first only. Crowded entries are split by the same rule over
the blocks that are left, so their pairs are compared only where more bits agree. Fingerprints that several
documents share go through once, with their number.

*Next document* (for edited texts): documents follow each other by descending ``doc_id``, the first after
the last. Ids are put in order by a range sort with a window inside each range; a document sends its successor's
beginning by a join on the id. Rows that share an id (or have none: these come last) have the same next
document; for rows before them, the one with the least xxhash64 of the text stands for the id. Ids that
many rows share are salted, and equal rows count once, with their number.

Null texts count as empty; an empty text has one empty term. Other columns are ignored, whatever their
names; texts may be of any length. An empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorlytics.llm.common import frozen, table
from sensorlytics.plans.attach import attach, probe

TERM = r"[^\x20\x09-\x0D]{1,12}"
BITS, RADIUS, BLOCKS, CROWD = 64, 3, 6, 1000
_LANES = 0x0000000100000001
KEY = ["none", "id"]


def _long(x: int) -> Column:
    """An unsigned 64-bit number as Spark's signed one."""
    return F.lit(x - (1 << 64) if x >> 63 else x).cast("long")


# ------------------------------------------------------------------ fingerprints

def terms(text: Column) -> Column:
    found = F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0)))
    return F.when(F.size(found) > 0, found).otherwise(F.array(F.lit("")))


def fingerprints(texts: DataFrame, keys: list[str], text_col: str = "text") -> DataFrame:
    """(keys, copies, fp) of rows with ``text_col``: one row per distinct ``keys``, which must tell texts
    apart, with how often it occurred."""
    words = texts.select(*keys, F.posexplode(terms(F.col(text_col))).alias("at", "term"))
    weight = F.greatest(F.length("term"), F.lit(1)).cast("long")
    votes = words.select(*keys, "at", F.xxhash64("term").alias("h"), weight.alias("w"))
    lanes = [F.sum(F.shiftrightunsigned("h", i).bitwiseAND(F.lit(_LANES).cast("long")) * F.col("w")).alias(f"v{i}")
             for i in range(BITS // 2)]
    sums = votes.groupBy(*keys).agg(F.sum("w").alias("all"), F.sum(F.when(F.col("at") == 0, 1).otherwise(0)).alias("copies"), *lanes)

    def bit(i: int) -> Column:
        for_it = F.col(f"v{i}").bitwiseAND(F.lit(0xFFFFFFFF).cast("long")) if i < 32 else F.shiftrightunsigned(f"v{i - 32}", 32)
        return F.when(2 * for_it > F.col("all"), _long(1 << i)).otherwise(F.lit(0).cast("long"))

    return sums.select(*keys, "copies", reduce(Column.bitwiseOR, map(bit, range(BITS))).alias("fp"))


def hex_of(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), BITS // 4, "0"))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits."""
    return 1 - F.bit_count(a.bitwiseXOR(b)) / F.lit(float(BITS))


# ------------------------------------------------------------------ radius search

def _cut(bits: list[int], parts: int) -> list[int]:
    """Masks of ``parts`` blocks over these bit positions, sizes as equal as they can be."""
    edges = [len(bits) * i // parts for i in range(parts + 1)]
    return [sum(1 << b for b in bits[i:j]) for i, j in zip(edges, edges[1:])]


def table_masks(bits: list[int], blocks: int, radius: int) -> list[int]:
    """For each permuted table, the bits of the blocks in front."""
    return [sum(front) for front in combinations(_cut(bits, blocks), blocks - radius)]


def _first(x: Column, masks: list[Column]) -> Column:
    """Number of the first table in which two fingerprints meet, ``x`` being their difference."""
    out = F.when(x.bitwiseAND(masks[0]) == 0, 0)
    for i, m in enumerate(masks[1:], 1):
        out = out.when(x.bitwiseAND(m) == 0, i)
    return out


def near_pairs(fps: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, crowd: int = CROWD) -> DataFrame:
    """All pairs (a, b), a < b, of distinct fingerprints in ``fps`` (fp) within ``radius`` bits."""
    masks = table_masks(list(range(BITS)), blocks, radius)
    rest = [[b for b in range(BITS) if not m >> b & 1] for m in masks]
    inner = [table_masks(r, blocks, radius) for r in rest]  # by table, then by inner table
    outer = [_long(m) for m in masks]
    entries = fps.select("fp").distinct().select("fp", F.posexplode(F.array(*outer)).alias("t", "mask"))
    entries = frozen(entries.select("fp", "t", F.col("fp").bitwiseAND(F.col("mask")).alias("front")), "simhash-entries")
    sizes = entries.groupBy("t", "front").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    placed = frozen(entries.join(sizes, ["t", "front"]), "simhash-placed")  # entries that meet another

    def met(rows: DataFrame, keys: list[str], ok) -> DataFrame:
        a, b = rows.select(*keys, F.col("fp").alias("a")), rows.select(*keys, F.col("fp").alias("b"))
        x = F.col("a").bitwiseXOR(F.col("b"))
        found = a.join(b, keys).where((F.col("a") < F.col("b")) & (F.bit_count(x) <= radius) & ok(x))
        return found.select("a", "b")

    plain = met(placed.where(F.col("n") <= crowd), ["t", "front"], lambda x: _first(x, outer) == F.col("t"))
    # crowded entries: the same once more over the bits that are left
    by_inner = [F.element_at(F.array(*[_long(per_t[s]) for per_t in inner]), F.col("t") + 1) for s in range(len(inner[0]))]
    split = (placed.where(F.col("n") > crowd)
             .select("fp", "t", "front", F.posexplode(F.array(*by_inner)).alias("s", "mask"))
             .select("fp", "t", "s", F.col("fp").bitwiseAND(F.col("mask")).bitwiseOR(F.col("front")).alias("more")))
    crowded = met(split, ["t", "s", "more"],
                  lambda x: (_first(x, outer) == F.col("t")) & (_first(x, by_inner) == F.col("s")))
    return plain.unionByName(crowded)


def near_counts(documents: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Per fingerprint of ``documents`` (fp, copies): n documents that have it, and near, how many other
    documents are within ``radius`` bits of each of them."""
    n = frozen(documents.groupBy("fp").agg(F.sum("copies").alias("n")), "simhash-counts")
    pairs = frozen(near_pairs(n, radius), "simhash-pairs")
    both = pairs.select(F.col("a").alias("fp"), F.col("b").alias("other")).unionByName(
        pairs.select(F.col("b").alias("fp"), F.col("a").alias("other")))
    others = both.join(n.select(F.col("fp").alias("other"), F.col("n").alias("m")), "other").groupBy("fp").agg(F.sum("m").alias("m"))
    return n.join(others, "fp", "left").select("fp", "n", (F.coalesce("m", F.lit(0)) + F.col("n") - 1).alias("near"))


# ------------------------------------------------------------------ documents and their successors

def _keyed(docs: DataFrame) -> DataFrame:
    """(none, id, text, row): a null id is 0 with the mark ``none``."""
    doc_id = F.col("doc_id").cast("long")
    return docs.select(doc_id.isNull().alias("none"), F.coalesce(doc_id, F.lit(0).cast("long")).alias("id"),
                       F.coalesce("text", F.lit("")).alias("text"), F.monotonically_increasing_id().alias("row"))


def successors(ids: DataFrame) -> DataFrame:
    """``ids`` (none, id, ...; one row an id) with next_none, next_id, by descending id, nulls last."""
    spark = ids.sparkSession
    order = [F.col("none"), F.col("id").desc()]
    ranged = ids.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *order)
    ranged = frozen(ranged.withColumn("part", F.spark_partition_id()), "simhash-order")
    after = F.lead(F.struct(*KEY)).over(Window.partitionBy("part").orderBy(*order))
    led = ranged.withColumn("after", after)
    # one row a range: its first id, and so the one that follows the range before it
    heads = ranged.groupBy("part").agg(F.min(F.struct("none", F.bitwise_not("id").alias("not_id"))).alias("h"))
    heads = heads.select("part", F.struct(F.col("h.none").alias("none"), F.bitwise_not("h.not_id").alias("id")).alias("head"))
    by_part = Window.orderBy("part")
    heads = heads.select("part", F.coalesce(F.lead("head").over(by_part), F.first("head").over(
        by_part.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("wrapped"))
    led = led.join(F.broadcast(heads), "part").withColumn("after", F.coalesce("after", "wrapped"))
    return led.select(*ids.columns, F.col("after.none").alias("next_none"), F.col("after.id").alias("next_id"))


def edited_texts(docs: DataFrame) -> tuple[DataFrame, DataFrame, dict]:
    """Rows (none, id, hash, n_chars, text, edited): the last third of each text (rounded down) replaced by as
    much of the next document's beginning. With it the ids in order, and how joins on ids are to be made."""
    rows = _keyed(docs)
    third = F.floor(F.length("text") / 3)
    ids = rows.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n"), F.max(third).alias("third"), F.min(F.xxhash64("text")).alias("hash"))
    ids = frozen(successors(ids), "simhash-ids")
    how = probe(ids, KEY)
    wanted = ids.select(F.col("next_none").alias("none"), F.col("next_id").alias("id"), F.col("third").alias("take"),
                        F.col("none").alias("for_none"), F.col("id").alias("for_id"))
    wanted = wanted.join(ids.select(*KEY, "n", "hash"), KEY)
    # a difference, not an equation: as a join key the hash would move the texts twice, and not by id alone
    begun = attach(rows, wanted, KEY, salt_cols=["row"], decided=how).where(
        F.xxhash64("text").bitwiseXOR(F.col("hash")) == 0)
    begun = begun.select(F.col("for_none").alias("none"), F.col("for_id").alias("id"),
                         F.substring("text", F.lit(1), F.col("take").cast("int")).alias("head"))
    heads = begun.groupBy(*KEY).agg(F.min("head").alias("head")).join(ids.select(*KEY, "n"), KEY)
    shuffled = {**how, "shape": "shuffle" if how["bounded"] else "salted"}  # heads are texts: never broadcast
    both = attach(rows, heads, KEY, salt_cols=["row"], decided=shuffled)
    n, k = F.length("text"), third.cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - k), F.substring("head", F.lit(1), k))
    return both.select(*KEY, F.xxhash64("text").alias("hash"), n.cast("long").alias("n_chars"), "text",
                       edited.alias("edited")), ids, shuffled


def compared(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Per document of ``docs`` (doc_id, text): doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next, n_near (other documents within ``radius`` bits)."""
    rows, ids, how = edited_texts(docs)
    keys = [*KEY, "hash", "n_chars", "edited_sha256"]
    both = rows.select(*KEY, "hash", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
                       F.posexplode(F.array("text", "edited")).alias("which", "t"))
    each = fingerprints(both, [*keys, "which"], "t")
    found = frozen(each.groupBy(*keys).agg(F.max("copies").alias("copies"), F.max(F.when(F.col("which") == 0, F.col("fp"))).alias("fp"),
                                           F.max(F.when(F.col("which") == 1, F.col("fp"))).alias("edited_fp")), "simhash-found")
    of_id = found.groupBy(*KEY).agg(F.min_by("fp", "hash").alias("next_fp"))
    after = ids.select(*KEY, "n", "next_none", "next_id").join(
        of_id.select(F.col("none").alias("next_none"), F.col("id").alias("next_id"), "next_fp"), ["next_none", "next_id"])
    found = attach(found, after.select(*KEY, "n", "next_fp"), KEY, salt_cols=["hash"], decided=how)
    near = frozen(near_counts(found, radius), "simhash-near")
    found = attach(found.drop("n"), near, ["fp"], salt_cols=[*KEY, "hash"])
    return found.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select(
        F.when(~F.col("none"), F.col("id")).alias("doc_id"), "n_chars", "edited_sha256", hex_of(F.col("fp")).alias("fingerprint"),
        hex_of(F.col("edited_fp")).alias("edited_fingerprint"), likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
        likeness(F.col("fp"), F.col("next_fp")).alias("near_next"), F.col("near").alias("n_near"))


def op13_fingerprints(spark, sf_dir: str) -> DataFrame:
    return compared(table(spark, sf_dir, "documents").select("doc_id", "text"))
