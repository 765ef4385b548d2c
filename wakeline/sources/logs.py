"""Prediction log: JSON lines written by scoring, read back by monitoring.

One object per line: ``timestamp`` (ISO text, UTC), ``features`` (struct),
``vessel_type`` (predicted class) and ``probabilities`` (class -> probability).
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

log = logging.getLogger(__name__)


def log_schema(features) -> T.StructType:
    return T.StructType([
        T.StructField("timestamp", T.StringType()),
        T.StructField("features", T.StructType([T.StructField(f, T.DoubleType()) for f in features])),
        T.StructField("vessel_type", T.StringType()),
        T.StructField("probabilities", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("_corrupt_record", T.StringType()),
    ])


def to_log_rows(scored: DataFrame, features, prediction: str = "prediction",
                ts=None) -> DataFrame:
    """Shape scored rows as log entries (timestamp defaults to now, UTC)."""
    stamp = ts if ts is not None else F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    return scored.select(stamp.alias("timestamp"),
                         F.struct(*[F.col(f).cast("double").alias(f) for f in features]).alias("features"),
                         F.col(prediction).alias("vessel_type"), F.col("probabilities"))


def append_log(scored: DataFrame, log_dir: str, features, prediction: str = "prediction") -> DataFrame:
    """Append entries; a failed write is reported, the predictions are still returned."""
    try:
        to_log_rows(scored, features, prediction).write.mode("append").json(log_dir)
    except Exception as e:  # noqa: BLE001 - any sink failure must not lose the prediction
        log.warning("Failed to write prediction log: %s", e)
    return scored


def append_log_once(scored: DataFrame, log_dir: str, features, scoring_id: str, prediction: str = "prediction",
                    ts=None) -> bool:
    """A12 for a scoring that may be run again: its entries are in the log once.

    They are written to a folder of their own, which a run that failed leaves
    unpromoted and the next one writes anew; promotion is a note beside it, after
    which the same id is not written again.  Returns whether it
    wrote.  Readers of the log see promoted scorings only."""
    spark = scored.sparkSession
    done = promoted_scorings(spark, log_dir)
    if done is not None and not done.where(F.col("scoring_id") == scoring_id).isEmpty():
        return False
    to_log_rows(scored, features, prediction, ts).write.mode("overwrite").json(f"{log_dir}/scorings/{scoring_id}")
    spark.createDataFrame([(scoring_id,)], "scoring_id string").coalesce(1).write.mode("overwrite").parquet(f"{log_dir}/promoted/{scoring_id}")
    return True


def promoted_scorings(spark: SparkSession, log_dir: str) -> DataFrame | None:
    from .sinks import path_exists
    if not path_exists(spark, f"{log_dir}/promoted"):
        return None
    return spark.read.option("recursiveFileLookup", True).parquet(f"{log_dir}/promoted")


def read_scorings(spark: SparkSession, log_dir: str, features) -> DataFrame:
    """The entries of all promoted scorings."""
    lines = (spark.read.option("recursiveFileLookup", True).text(f"{log_dir}/scorings")
             .withColumn("scoring_id", F.element_at(F.split("_metadata.file_path", "/"), -2)))
    done = promoted_scorings(spark, log_dir)
    if done is None:
        return parse_log(lines.limit(0), features)
    return parse_log(lines.join(done.distinct(), "scoring_id", "left_semi"), features)


# ---------------------------------------------------------------- ledger of log files

LEDGER = ["path", "length", "modificationTime"]


def log_files(spark: SparkSession, log_dir: str) -> DataFrame:
    """One row per file of the log; listed only, not read."""
    return spark.read.format("binaryFile").load(log_dir).select(*LEDGER)


def unread_files(spark: SparkSession, log_dir: str, ledger: str) -> DataFrame:
    """The files that the ledger does not have, or has in another size or of
    another time (a file that was written again is a new one).  Stored, so
    that what is read is what is marked later."""
    from ..session import materialize
    from .sinks import path_exists
    files = log_files(spark, log_dir)
    if path_exists(spark, ledger):
        files = files.join(spark.read.parquet(ledger), LEDGER, "left_anti")
    return files.transform(materialize)


def read_files(spark: SparkSession, files: DataFrame, features) -> DataFrame:
    """The entries of these files.  The paths go through the driver, as the
    files of every Spark read do."""
    paths = [r["path"] for r in files.select("path").collect()]
    lines = spark.read.text(paths) if paths else spark.createDataFrame([], "value string")
    return parse_log(lines, features)


def mark_read(files: DataFrame, ledger: str) -> None:
    files.coalesce(1).write.mode("append").parquet(ledger)


def parse_log(lines: DataFrame, features, text_col: str = "value") -> DataFrame:
    """Parse JSON text lines; blank and malformed lines are dropped.

    Returns the log columns plus ``ts`` (TIMESTAMP) and a ``valid`` flag is not
    kept: malformed lines simply do not survive.
    """
    schema = log_schema(features)
    parsed = lines.where(F.trim(F.col(text_col)) != "").select(
        F.from_json(F.col(text_col), schema, {"mode": "PERMISSIVE",
                                              "columnNameOfCorruptRecord": "_corrupt_record"}).alias("j"),
        F.col(text_col).alias("_line"))
    ok = parsed.where(F.col("j").isNotNull() & F.col("j._corrupt_record").isNull()
                      & F.col("j.timestamp").isNotNull())
    return ok.select("j.timestamp", "j.features", "j.vessel_type", "j.probabilities",
                     F.to_timestamp("j.timestamp").alias("ts")).where(F.col("ts").isNotNull())


def log_quality(lines: DataFrame, features, text_col: str = "value") -> DataFrame:
    """Counts of lines read, blank, malformed and valid (one aggregate pass)."""
    schema = log_schema(features)
    j = F.from_json(F.col(text_col), schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    blank = F.trim(F.col(text_col)) == ""
    valid = (~blank & j.isNotNull() & j["_corrupt_record"].isNull() & j["timestamp"].isNotNull()
             & F.to_timestamp(j["timestamp"]).isNotNull())
    return lines.agg(F.count(F.lit(1)).alias("n_lines"), F.count_if(blank).alias("n_blank"),
                     F.count_if(~blank & ~valid).alias("n_malformed"), F.count_if(valid).alias("n_valid"))


def read_log(spark: SparkSession, log_dir: str, features, since=None) -> DataFrame:
    """Entries strictly after ``since`` (all when None)."""
    lines = spark.read.text(log_dir)
    df = parse_log(lines, features)
    if since is not None:
        df = df.where(F.col("ts") > F.lit(since).cast("timestamp"))  # strict: an entry at the cutoff is old
    return df


def unnest_features(df: DataFrame) -> DataFrame:
    """Spread the ``features`` struct into columns."""
    return df.select("*", "features.*").drop("features")
