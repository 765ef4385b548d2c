"""Streaming jobs.

K1  weekly roll-up on a ping stream: event-time watermark, 7-day tumbling
    windows aligned on Monday (``window(ts, '7 days', '7 days', '4 days')``:
    the epoch is a Thursday), append mode, so a week is emitted once it is
    closed by the watermark.
K2  drift check on the prediction log as files arrive: ``foreachBatch`` runs
    the batch PSI check against stored baselines; the stream checkpoint
    replaces a "last checked" file.
K3  late and duplicate pings: ``dropDuplicatesWithinWatermark(imo, ts)``;
    rows behind the watermark are dropped by the aggregation.

Sinks are idempotent: overwrites of the closed weeks' partitions (K1) and of
what a batch itself wrote (K2).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import MIN_PINGS_PER_WEEK, PSI_MODERATE
from ..functions import utc_date, utc_instant
from ..operators import drift as D
from ..operators.weekly import GROUPS, MERGE, ORDER, VALUE_COLUMNS, features_of, merge_partials, partial_columns, value_counts
from ..sources import logs as L
from ..session import materialize

WEEK = ("7 days", "7 days", "4 days")

# State lives in RocksDB (off-heap, spills to local disk; only changed keys are
# checkpointed) unless the cluster already chose a provider.  The provider is
# recorded in a query's checkpoint when it first starts.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def _start(spark: SparkSession, writer, overrides: dict):
    """Start ``writer`` with ``overrides`` plus the state-store defaults that the
    session leaves unset; the session's own values are restored afterwards."""
    conf = {k: v for k, v in STATE_CONF.items() if spark.conf.get(k, None) in (None, "")}
    conf.update(overrides)
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        return writer.start()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def weekly_state(pings: DataFrame, watermark: str = "1 day", dedupe: bool = True, key: str = "imo") -> DataFrame:
    """K1/K3 on a streaming ping DataFrame: the mergeable partials of each
    vessel-week, emitted when the watermark closes the week.

    The state has one row of partials per vessel-week and combination of the
    values whose distributions are needed; no list of readings.  One aggregation
    serves both, so that pings are read and told from repeats once."""
    s = pings.withColumn("ts", utc_instant("ts")).withWatermark("ts", watermark)
    if dedupe:
        s = s.dropDuplicatesWithinWatermark([key, "ts"])
    s = s.where(F.col("ts").isNotNull())
    week = F.window("ts", *WEEK).alias("w")
    parts = [MERGE[how](c).alias(k) for k, (how, c) in partial_columns(GROUPS).items()]
    return s.groupBy(key, week, *VALUE_COLUMNS).agg(*parts).withColumn("week_start", utc_date("w.start")).drop("w")


def run_weekly_stream(spark: SparkSession, source_dir: str, schema, sink: str, checkpoint: str,
                      adapt=None, available_now: bool = True, file_glob: str | None = None,
                      state_partitions: int | None = None, min_pings: int = MIN_PINGS_PER_WEEK,
                      key: str = "imo", **kw):
    """Start K1 over parquet files landing in ``source_dir`` (optionally only the
    files matching ``file_glob``); returns the query.

    A closed week comes out whole, in one batch: its features are read off there
    and replace the week's partition of the sink, so a batch that runs again
    writes the same.  ``state_partitions`` sets the number of state-store
    partitions.  It is read from ``spark.sql.shuffle.partitions`` when a query
    first starts and then kept in its checkpoint, so it is set only for the
    start and restored after."""
    reader = spark.readStream.schema(schema)
    if file_glob:
        reader = reader.option("pathGlobFilter", file_glob)
    src = reader.parquet(source_dir)
    if adapt is not None:
        src = adapt(src)
    keys = [key, "week_start"]

    def closed_weeks(batch: DataFrame, _: int) -> None:
        rows = materialize(batch, "closed_weeks")    # read twice
        out = features_of(merge_partials(rows, keys), value_counts(rows, keys, n=F.col("n_pings")), keys, GROUPS, min_pings)
        (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("week_start").parquet(sink))

    q = (weekly_state(src, key=key, **kw).writeStream.foreachBatch(closed_weeks).outputMode("append")
         .option("checkpointLocation", checkpoint))
    q = q.trigger(availableNow=True) if available_now else q.trigger(processingTime="1 minute")
    return _start(spark, q, {} if state_partitions is None
                  else {"spark.sql.shuffle.partitions": str(state_partitions)})


def read_weeks(spark: SparkSession, sink: str, key: str = "imo") -> DataFrame:
    """What K1 has written, in the columns' usual order."""
    weeks = spark.read.parquet(sink)
    return weeks.select(key, "week_start", *[c for c in ORDER if c in weeks.columns])


def drift_batches(bins: DataFrame, features, results_path: str, counts_path: str,
                  threshold: float = PSI_MODERATE, period: Column | None = None):
    """What K2 does with a batch of log lines: ``check(batch, batch_id)``.

    The batch's bin counts go to a store, under its id.  The PSI of each period
    that the batch touches is read off all counts stored for that period, so a
    day that arrives in ten batches is one day.  A batch that runs again
    replaces its own counts and its own results."""
    bins = bins.transform(materialize)
    period = utc_date(F.current_timestamp()) if period is None else period

    def write(df: DataFrame, batch_id: int, path: str) -> None:
        (df.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(path))

    def check(batch: DataFrame, batch_id: int) -> None:
        df = L.unnest_features(L.parse_log(batch, features)).withColumn("period", period)
        counts = D.cell_counts(df, bins, features, "period")    # stored: one row per feature, period and bin
        write(counts, batch_id, counts_path)
        touched = counts.select("period").distinct()
        total = (batch.sparkSession.read.parquet(counts_path).join(touched, "period", "left_semi")
                 .groupBy("feature", "class", "period", "bin").agg(F.sum("n").alias("n")).transform(materialize))
        res = D.score_counts(total, bins, bins_rows=D.bins_info(bins)[0])
        flagged = D.check_drift(res, threshold).select("period", "feature", "class", "alarm")
        write(res.join(flagged, ["period", "feature", "class"], "left"), batch_id, results_path)

    return check


def latest_drift(results: DataFrame) -> DataFrame:
    """Of each period the rows of the last batch that touched it."""
    last = results.groupBy("period").agg(F.max("batch_id").alias("batch_id"))
    return results.join(last, ["period", "batch_id"], "left_semi")


def run_drift_stream(spark: SparkSession, log_dir: str, bins: DataFrame, features, results_path: str,
                     checkpoint: str, threshold: float = PSI_MODERATE, available_now: bool = True,
                     counts_path: str | None = None, period: Column | None = None):
    """K2: every new batch of log files is added to the counts of its periods and
    these are checked against the baseline.

    All PSI rows of the touched periods are written with the batch id, the
    period (by default the UTC date of the check) and an ``alarm`` text (NULL
    when under the threshold); ``latest_drift`` has the newest of each period.
    The counts are kept at ``counts_path``, beside the results if not given."""
    check = drift_batches(bins, features, results_path, counts_path or f"{results_path}-counts", threshold, period)
    q = (spark.readStream.text(log_dir).writeStream.foreachBatch(check)
         .option("checkpointLocation", checkpoint))
    q = q.trigger(availableNow=True) if available_now else q.trigger(processingTime="1 minute")
    return q.start()
