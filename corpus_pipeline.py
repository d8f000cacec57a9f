"""Corpus pipeline: five stages over ``documents``, each one operator of ``sensorlytics.llm``.

Each stage takes (spark, docs, sf_dir), works on all documents that the stage before kept, and returns
the columns of documents; the last returns the packed pieces. ``run`` writes each stage as a table and
reads it back as the next one's documents.

1. quality_classifier: documents predicted bad go. A document without a word is not judged and stays.
2. toxicity: documents predicted toxic go.
3. line_dedup: repeated lines are cut out of the texts. A document that loses more than half of its words
   (of 20 or more) to lines kept in other documents is a copy, exact or near, of what stays there: it goes as a
   whole, not as a remnant that no later stage can tell for a copy. One that only repeats itself stays.
4. ngram_join: of each group of near duplicates (five-word shingles are the default of this library's
   near-duplicate stages; here Jaccard 0.8 on them) one row stays, that of the smallest doc_id.
5. best_fit_packing: documents are packed into sequences.

Verdicts go by row, so ids may be null or repeat: stages 1 to 3 judge each row by its own text, and of equal
rows in a group of stage 4 one stays (rows without an id come last). An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorlytics.llm import line_dedup, ngram_join, packing, quality_classifier, toxicity
from sensorlytics.llm.common import frozen, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: No stage but the packing's arithmetic can be put in SQL: the models and the joins are tested against
#: brute-force versions.
ORACLE_SQL = None


#: Share of its words that a document must not have lost to other documents in line deduplication.
LEAST_LEFT = 0.5


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = quality_classifier.feature_table(docs)
    scored = quality_classifier.score_table(rows, quality_classifier.train(rows, table(spark, sf_dir, "labels")))
    bad = scored.where("predicted = 0").select(F.col("id").alias("_id"), F.col("text_key").alias("_key")).distinct()
    has_words = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    return docs.join(bad, has_words & F.col("doc_id").eqNullSafe(F.col("_id")) & (
        F.xxhash64(F.coalesce("text", F.lit(""))) == F.col("_key")), "left_anti").select(*COLUMNS)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, keep_text=True).where("predicted = 0").select(*COLUMNS)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    left = line_dedup.dedup_lines(docs, drop_emptied=True, least_words=0, least_left=LEAST_LEFT)
    return left.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(
        F.col("n_chars"))).select(*COLUMNS)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = frozen(ngram_join.near_groups(docs, shingle=5, similarity=(8, 10), with_group=True).where("n_shingles > 0").groupBy(
        "grp", "doc_id", "text_key").count(), "pipeline-groups")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    stays = rows.groupBy("grp").agg(F.min(place).alias("stays"))
    verdicts = rows.join(stays, "grp").select(
        F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), (place != F.col("stays")).alias("_gone"),
        (F.col("count") > 1).alias("_again")).where("_gone OR _again")
    verdicts = frozen(verdicts, "pipeline-verdicts")
    judged = docs.join(verdicts, F.col("doc_id").eqNullSafe(F.col("_id")) & (
        F.xxhash64(F.coalesce("text", F.lit(""))) == F.col("_key")), "left").where("_gone IS NULL OR NOT _gone")
    if verdicts.where("NOT _gone").isEmpty():
        return judged.select(*COLUMNS)
    judged = frozen(judged, "pipeline-judged")  # equal rows are among those that stay: one of them does
    return judged.where("_again IS NULL").unionByName(judged.where("_again").dropDuplicates(["_id", "_key"])).select(*COLUMNS)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [("quality_classifier", quality_stage), ("toxicity", toxicity_stage), ("line_dedup", line_stage),
          ("ngram_join", near_duplicate_stage), ("best_fit_packing", packing_stage)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(*COLUMNS)
    for name, stage in STAGES:
        docs = frozen(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
