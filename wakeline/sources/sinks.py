"""Tables we write: daily pings, feature dataset, baselines, run metadata.

Writes are Parquet, partitioned where a later read filters (``event_date``),
and idempotent: a day already written is skipped unless forced, and appending
features never duplicates an (imo, week_start) key.
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import utc_instant
from ..operators.drift import broadcast_if_small
from ..session import default_partitions, materialize


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a stored table (any format Spark can list) exists at ``path``."""
    from pyspark.errors import AnalysisException
    try:
        spark.read.format("text").load(path).limit(0).collect()  # lists files only
        return True
    except AnalysisException:
        return False


def write_daily(pings: DataFrame, root: str, force: bool = False, n_partitions: int | None = None) -> DataFrame:
    """A3/A4: per-day ping table partitioned by ``event_date``.

    Days already present are skipped unless ``force`` (then only those days are
    overwritten: dynamic partition overwrite).  Rows are range-partitioned on
    (event_date, imo): a big day is split over many tasks, and each task holds a
    contiguous slice, so the file count stays near the task count (hash
    partitioning would write one file per day per task).  Files are sorted by
    (imo, ts), so a vessel's pings are contiguous.
    Returns the rows that were written (lazy).
    """
    spark = pings.sparkSession
    todo = pings
    if not force and path_exists(spark, root):
        done = spark.read.parquet(root).select("event_date").distinct()
        todo = pings.join(broadcast_if_small(done), "event_date", "left_anti")  # one row per stored day
    n = n_partitions or default_partitions(spark)
    (todo.repartitionByRange(n, "event_date", "imo").sortWithinPartitions("event_date", "imo", "ts")
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .option("compression", "snappy").partitionBy("event_date").parquet(root))
    return todo


def write_partitions(df: DataFrame, path: str, by: str, values=()) -> None:
    """Replace the partitions of ``by`` that ``df`` has rows of, and leave the
    others.  A partition of ``values`` without rows in ``df`` becomes empty."""
    spark = df.sparkSession
    if values:
        df = df.transform(materialize)
    (df.repartitionByRange(default_partitions(spark), by, "imo")
       .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path))
    if values:
        filled = {r[0] for r in df.select(by).distinct().collect()}  # one row per partition written
        none = spark.createDataFrame([], T.StructType([f for f in df.schema.fields if f.name != by]))
        for v in set(values) - filled:
            none.write.mode("overwrite").parquet(f"{path}/{by}={v}")


def compact(spark: SparkSession, root: str, out: str, n_files: int) -> None:
    """A5: rewrite the daily table into about ``n_files`` files in total, each a
    contiguous (day, vessel) range."""
    (spark.read.parquet(root).repartitionByRange(n_files, "event_date", "imo")
         .sortWithinPartitions("event_date", "imo", "ts")
         .write.mode("overwrite").partitionBy("event_date").parquet(out))


def compaction_plan(spark: SparkSession, root: str, target_bytes: int) -> DataFrame:
    """A5: the days worth rewriting - (event_date, n_files, bytes, n_after).

    A day is one if its files would fit into fewer files of ``target_bytes``.
    Files are listed, not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path", "length")
    day = F.to_date(F.regexp_extract("path", "event_date=([^/]+)/", 1))
    return (files.where(F.col("path").contains("/event_date=")).groupBy(day.alias("event_date"))
            .agg(F.count(F.lit(1)).alias("n_files"), F.sum("length").alias("bytes"))
            .withColumn("n_after", F.ceil(F.col("bytes") / target_bytes))
            .where(F.col("n_after") < F.col("n_files")))


def compact_days(spark: SparkSession, root: str, target_bytes: int = 128 << 20) -> DataFrame:
    """A5: merge the small files of the days that have too many, in place.

    Only those days are read, staged and swapped in (dynamic partition
    overwrite); the files of all others stay as they are.  Returns the plan."""
    plan = compaction_plan(spark, root, target_bytes).transform(materialize)
    days = [r[0] for r in plan.select("event_date").collect()]      # one row per day to be rewritten
    if days:
        total = int(plan.agg(F.sum("n_after")).first()[0])
        staged = spark.read.parquet(root).where(F.col("event_date").isin(days)).transform(materialize)
        # a day's vessels are dealt into as many parts as it shall have files
        dealt = (staged.join(broadcast_if_small(plan.select("event_date", "n_after"), known_rows=len(days)), "event_date")
                 .withColumn("_part", F.pmod(F.xxhash64("imo"), F.col("n_after"))))
        (dealt.repartition(total, "event_date", "_part").sortWithinPartitions("event_date", "imo", "ts").drop("_part", "n_after")
              .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("event_date").parquet(root))
    return plan


def existing_keys(spark: SparkSession, path: str, keys=("imo", "week_start")) -> DataFrame | None:
    """Only the key columns of a stored table (column pruning at the scan)."""
    if not path_exists(spark, path):
        return None
    return spark.read.parquet(path).select(*keys)


def new_rows(df: DataFrame, existing: DataFrame | None, keys=("imo", "week_start")) -> DataFrame:
    """Rows whose typed key is not stored yet."""
    return df if existing is None else df.join(existing, list(keys), "left_anti")


def write_dataset(df: DataFrame, path: str, mode: str = "overwrite", keys=("imo", "week_start"),
                  csv_export: str | None = None) -> DataFrame:
    """Overwrite, or append only unseen keys (appending twice = once)."""
    spark = df.sparkSession
    if mode not in ("overwrite", "append"):
        raise ValueError(f"mode must be overwrite or append, not {mode!r}")
    out = new_rows(df, existing_keys(spark, path, keys), keys) if mode == "append" else df
    if mode == "append":
        out = out.transform(materialize)  # fix the rows before the target path changes under the reader
    out.write.mode(mode).parquet(path)
    if csv_export:
        spark.read.parquet(path).write.mode("overwrite").option("header", True).csv(csv_export)
    return out


def read_dataset(spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | None = None) -> DataFrame:
    """A10: the feature table (CSV exports are read with an explicit schema)."""
    if fmt == "csv":
        r = spark.read.option("header", True)
        return (r.schema(schema) if schema is not None else r.option("inferSchema", True)).csv(path)
    return spark.read.parquet(path)


# ---------------------------------------------------------------- feature schema file

_DTYPE_NAMES = {T.DoubleType: "float64", T.FloatType: "float32", T.LongType: "int64", T.IntegerType: "int32",
                T.BooleanType: "bool", T.StringType: "object", T.DateType: "date", T.TimestampType: "datetime",
                T.TimestampNTZType: "datetime"}
_NAME_TYPES = {"float64": T.DoubleType(), "float32": T.FloatType(), "int64": T.LongType(), "int32": T.IntegerType(),
               "bool": T.BooleanType(), "object": T.StringType(), "string": T.StringType(), "date": T.DateType(),
               "datetime": T.TimestampNTZType()}


def schema_spec(df: DataFrame, columns) -> dict:
    fields = {f.name: f.dataType for f in df.schema.fields}
    return {"columns": list(columns), "dtypes": {c: _DTYPE_NAMES[type(fields[c])] for c in columns}}


def write_schema(spark: SparkSession, path: str, spec: dict) -> None:
    spark.createDataFrame([(json.dumps(spec, indent=2),)], "v string").coalesce(1) \
         .write.mode("overwrite").text(path)


def load_schema(spark: SparkSession, path: str) -> dict:
    if not path_exists(spark, path):
        raise FileNotFoundError(f"{path} holds no schema; a training run writes one.")
    return json.loads("\n".join(r[0] for r in spark.read.text(path, wholetext=True).collect()))


def spec_to_struct(spec: dict) -> T.StructType:
    """JSON spec -> StructType; unknown dtype names raise."""
    fields = []
    for c in spec["columns"]:
        name = spec["dtypes"][c]
        if name not in _NAME_TYPES:
            raise ValueError(f"unsupported dtype {name!r} for column {c!r}")
        fields.append(T.StructField(c, _NAME_TYPES[name], True))
    return T.StructType(fields)


def validate_schema(df: DataFrame, spec: dict) -> None:
    missing = [c for c in spec["columns"] if c not in df.columns]
    if missing:
        raise ValueError(f"columns missing from the data: {missing}")


# ---------------------------------------------------------------- baselines and run metadata

def save_baselines(bins: DataFrame, classes: DataFrame | None, path: str) -> None:
    bins.write.mode("overwrite").parquet(f"{path}/bins")
    if classes is not None:
        classes.select("class", "ref_prop").write.mode("overwrite").parquet(f"{path}/classes")


def load_baselines(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame | None]:
    bins = spark.read.parquet(f"{path}/bins")
    classes = spark.read.parquet(f"{path}/classes") if path_exists(spark, f"{path}/classes") else None
    return bins, classes


def save_training_metadata(spark: SparkSession, path: str, start, end, run_id: str) -> None:
    """Append one row per training run."""
    row = (dt.datetime.now(dt.timezone.utc).replace(tzinfo=None), dt.date.fromisoformat(str(start)),
           dt.date.fromisoformat(str(end)), run_id)
    spark.createDataFrame([row], "trained_at timestamp_ntz, data_start date, data_end date, run_id string") \
         .write.mode("append").parquet(path)


def save_last_checked(spark: SparkSession, path: str, up_to) -> None:
    """Append the newest checked entry time (an instant: TIMESTAMP, not NTZ)."""
    now = dt.datetime.now(dt.timezone.utc)
    spark.createDataFrame([(now, up_to)], "checked_at timestamp, checked_up_to timestamp") \
         .write.mode("append").parquet(path)


def last_checked(spark: SparkSession, monitor_path: str, training_path: str):
    """greatest(last checked time, end of the training data); None if never checked."""
    if not path_exists(spark, monitor_path):
        return None
    checked = spark.read.parquet(monitor_path).select(F.max("checked_up_to").alias("t"))
    if path_exists(spark, training_path):
        end = spark.read.parquet(training_path).select(F.max(utc_instant(F.col("data_end").cast("timestamp_ntz"))).alias("e"))
        return spark.range(1).select(F.greatest(checked.scalar(), end.scalar())).first()[0]
    return checked.first()[0]


def write_sample(df: DataFrame, path: str) -> None:
    """Write a stratified sample (see splits.sample_stratified)."""
    df.write.mode("overwrite").parquet(path)
