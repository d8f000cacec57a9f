"""Ingest jobs: raw text / JSON / CSV → typed readings, plus a rejects table.

* strict text (two column orders): split on ``,`` or ``;`` followed by optional spaces;
  trailing delimiters are ignored (as a Java ``split`` drops trailing empty tokens);
  exactly three fields and two parsable, finite numbers, else the line is rejected
  (``mode="quarantine"``) or the job fails (``mode="failfast"``);
* lenient text: split on ``,`` only, unparsable numbers become 0, extra fields are
  ignored, fewer than three fields is a reject (the reference throws there);
* typed CSV with a fixed schema, failfast;
* JSON count messages (``from_json``); a message without ``urn`` is a reject.

Number parsing follows Spark's ``try_cast`` rules (spaces around numbers are trimmed).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The field delimiters. Strict: "," or ";" followed by optional spaces.
# Lenient: "," only. Both drop trailing empty fields (Java split semantics).
STRICT_DELIMITER = r"[,;]\s*"
LENIENT_DELIMITER = ","

READING_CSV_SCHEMA = "urn STRING, timestamp BIGINT, value DOUBLE"
COUNTS_JSON_SCHEMA = ("urn STRING, timestamp BIGINT, valuesCount BIGINT, outliersCount BIGINT, "
                      "outliersOnValuesCount BIGINT, outliersOnOutliersCount BIGINT")


def _finite(c: Column) -> Column:
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf")))


def parsed_lines(lines: DataFrame, order: str, strict: bool = True, line_col: str = "line") -> DataFrame:
    """Every line with ``urn, value, timestamp`` and ``reason`` (null: a good reading), next to its other columns.

    A line is split once: the fields leave a generator as one column, which no filter or projection
    behind it can evaluate again.
    """
    if order not in ("uvt", "utv"):
        raise ValueError("order must be 'uvt' or 'utv'")
    extra = [c for c in lines.columns if c != line_col]
    fields = F.split(F.col(line_col), STRICT_DELIMITER if strict else LENIENT_DELIMITER)
    cut = lines.select(*extra, F.col(line_col), F.explode(F.array(fields)).alias("_f"))
    f = F.col("_f")
    vi, ti = (1, 2) if order == "uvt" else (2, 1)
    v, t = F.get(f, F.lit(vi)).try_cast("double"), F.get(f, F.lit(ti)).try_cast("long")
    if strict:  # three fields, and after them empty ones only
        matched = (F.get(f, F.lit(2)) != "") & ((F.size(f) == 3) | (F.array_join(F.slice(f, 4, 1 << 30), "") == ""))
        reason = (F.when(v.isNull(), F.lit("bad_value")).when(~_finite(v), F.lit("non_finite_value"))
                  .when(t.isNull(), F.lit("bad_timestamp")))
        value, ts = v, t
    else:
        # three fields or more once trailing empty ones are gone; a parsable NaN or Infinity is no 0: it is rejected
        matched = (F.size(f) >= 3) & (F.array_join(F.slice(f, 3, 1 << 30), "") != "")
        reason = F.when(v.isNotNull() & ~_finite(v), F.lit("non_finite_value"))
        value, ts = F.coalesce(v, F.lit(0.0)), F.coalesce(t, F.lit(0).cast("long"))
    reason = F.when(~F.coalesce(matched, F.lit(False)), F.lit("field_count")).otherwise(reason)
    return cut.select(*extra, line_col, f[0].alias("urn"), value.alias("value"), ts.alias("timestamp"), reason.alias("reason"))


def parse_readings(lines: DataFrame, order: str, strict: bool = True, mode: str = "quarantine",
                   line_col: str = "line") -> tuple[DataFrame, DataFrame]:
    """Parse text lines into ``(urn, value, timestamp)``; returns ``(good, rejects)``.

    ``order`` is ``"uvt"`` (urn, value, timestamp) or ``"utv"`` (urn, timestamp, value);
    there is no default because the two layouts share file names in the reference.
    Other columns of ``lines`` are carried through to both outputs. Each output reads the lines;
    :func:`ingest_lines` writes both in one pass.
    """
    if mode not in ("quarantine", "failfast"):
        raise ValueError("mode must be 'quarantine' or 'failfast'")
    extra = [c for c in lines.columns if c != line_col]
    rows = parsed_lines(lines, order, strict, line_col)
    reason, line = F.col("reason"), F.col(line_col)
    ok = reason.isNull()
    good, rejects = [*extra, "urn", "value", "timestamp"], [*extra, line_col, "reason"]
    if mode == "failfast":
        # a filter, not a column: no later projection can prune it
        guard = F.when(ok, F.lit(True)).otherwise(F.raise_error(
            F.concat(F.lit("malformed reading ("), reason, F.lit("): "), F.coalesce(line, F.lit("null")))).cast("boolean"))
        return rows.where(guard).select(*good), rows.where(F.lit(False)).select(*rejects)
    return rows.where(ok).select(*good), rows.where(~ok).select(*rejects)


def ingest_lines(lines: DataFrame, order: str, path: str, strict: bool = True, line_col: str = "line") -> tuple[DataFrame, DataFrame]:
    """Parse the lines once and write good readings and rejects in the same pass, below ``path/rejected=…``
    (a retry replaces both); returns them read back, as :func:`parse_readings` does."""
    spark, extra = lines.sparkSession, [c for c in lines.columns if c != line_col]
    rows = parsed_lines(lines, order, strict, line_col)
    bad = F.col("reason").isNotNull()
    # a reading needs its line no more
    written = rows.withColumn(line_col, F.when(bad, F.col(line_col))).withColumn("rejected", bad)
    written.write.mode("overwrite").partitionBy("rejected").parquet(path)
    back = spark.read.schema(written.schema).parquet(path)
    return (back.where(~F.col("rejected")).select(*extra, "urn", "value", "timestamp"),
            back.where("rejected").select(*extra, line_col, "reason"))


def read_text_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text-file source (one reading per line) → ``line`` column."""
    return spark.read.text(path).withColumnRenamed("value", "line")


def write_typed_csv(readings: DataFrame, path: str) -> None:
    """Write ``(urn, timestamp, value)`` as headerless CSV (many part files, overwrite)."""
    readings.select("urn", "timestamp", "value").write.mode("overwrite").csv(path)


def read_typed_csv(spark: SparkSession, path: str) -> DataFrame:
    """Typed CSV scan with a fixed schema; a malformed record fails the job."""
    return (spark.read.schema(READING_CSV_SCHEMA).option("mode", "FAILFAST").csv(path)
            .select("urn", "value", "timestamp"))


def parse_counts_json(messages: DataFrame, payload_col: str = "payload") -> tuple[DataFrame, DataFrame]:
    """JSON count messages → (urn, timestamp, values_count, outliers_count, ...); rejects
    are messages that do not parse, have a field of the wrong type, or have no ``urn``. Unknown
    fields are ignored; absent ones are 0."""
    extra = [c for c in messages.columns if c != payload_col]
    parsed = messages.select(*extra, F.col(payload_col), F.from_json(
        F.col(payload_col), COUNTS_JSON_SCHEMA + ", _bad STRING", {"columnNameOfCorruptRecord": "_bad"}).alias("m"))
    ok = F.col("m.urn").isNotNull() & F.col("m._bad").isNull()
    good = parsed.where(ok).select(
        *extra, F.col("m.urn").alias("urn"), F.coalesce("m.timestamp", F.lit(0).cast("long")).alias("timestamp"),
        F.coalesce("m.valuesCount", F.lit(0).cast("long")).alias("values_count"),
        F.coalesce("m.outliersCount", F.lit(0).cast("long")).alias("outliers_count"),
        F.coalesce("m.outliersOnValuesCount", F.lit(0).cast("long")).alias("outliers_on_values_count"),
        F.coalesce("m.outliersOnOutliersCount", F.lit(0).cast("long")).alias("outliers_on_outliers_count"))
    rejects = parsed.where(~ok).select(*extra, F.col(payload_col), F.lit("bad_message").alias("reason"))
    return good, rejects
