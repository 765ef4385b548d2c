"""Registered queries that go through stored tables: daily table, dataset,
training state, raw text and a stream with repeated and late pings.

They write what the driver's tables give to the shared checkpoint folder, read
it back by the library's own readers and are compared like the rest.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import MODEL_FEATURES, RAW_TIMESTAMP_FORMAT
from ..functions import utc_instant
from ..operators import drift as D
from ..operators import model as M
from ..operators import sketches as SK
from ..operators import stats as ST
from ..operators.pings import keep_ship_types, numeric_columns
from ..session import materialize, scratch_path
from ..sources import logs as LG
from ..sources import raw as R
from ..sources import sinks as K
from ..sources.adapters import pings_from_events
from ..sources.tables import table
from ..streaming.jobs import read_weeks, run_weekly_stream
from . import jobs as J
from . import oracle_weekly as OW
from . import oracle_drift as OD
from .catalog import (_LI, _LIBASE, _VP, _W, ADAPTER_MIN_PINGS, LI_FEATURES, ORACLE, lineitem_monthly, log_lines, register, vessel_pings,
                      weekly)
from .sqltext import rounded, with_ctes

FROM_DAY, TO_DAY = 5, 18      # days of the daily table that are read back
STORED_DAYS = 14              # what the first run stores


def _scratch(spark, name: str) -> str:
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")


def _daily_pings(spark, sf_dir):
    return vessel_pings(spark, sf_dir).withColumn("event_date", F.to_date("ts"))


_DAILY = """SELECT event_date, imo, count(*) AS n_pings, min(ts) AS first_ts, max(ts) AS last_ts
FROM (SELECT *, CAST(ts AS DATE) AS event_date FROM vpings) t"""


def _per_day(df):
    return df.groupBy("event_date", "imo").agg(F.count(F.lit(1)).alias("n_pings"), F.min("ts").alias("first_ts"),
                                               F.max("ts").alias("last_ts"))


@register("daily_range", with_ctes(_VP, f"""{_DAILY}
WHERE event_date BETWEEN (SELECT min(CAST(ts AS DATE)) FROM vpings) + {FROM_DAY}
  AND (SELECT min(CAST(ts AS DATE)) FROM vpings) + {TO_DAY} GROUP BY event_date, imo"""))
def q_daily_range(spark, sf_dir):
    """A2/A4: daily table written, then only the days of a range read back."""
    p, root = _daily_pings(spark, sf_dir), _scratch(spark, "daily")
    d0 = p.agg(F.min("event_date")).first()[0]  # one scalar
    K.write_daily(p, root)
    return _per_day(R.read_daily(spark, root, d0 + dt.timedelta(days=FROM_DAY), d0 + dt.timedelta(days=TO_DAY)))


@register("daily_resumed", with_ctes(_VP, f"{_DAILY} GROUP BY event_date, imo"))
def q_daily_resumed(spark, sf_dir):
    """A first run stores some days, a second run adds only the others
    (stored days would double if it did not skip them); all days read back."""
    p, root = _daily_pings(spark, sf_dir), _scratch(spark, "daily")
    d0 = p.agg(F.min("event_date")).first()[0]  # one scalar
    K.write_daily(p.where(F.col("event_date") < F.lit(d0 + dt.timedelta(days=STORED_DAYS))), root)
    K.write_daily(p, root)
    return _per_day(R.read_daily(spark, root))


DAMAGED_DAY = 3      # the archive of this day, counted from the first, breaks off


def _write_archives(days, root: str, damaged: dt.date) -> None:
    """One zipped CSV per day, written where the day's rows are; of one the last bytes are missing."""
    def write(batches):
        import io
        import zipfile

        import pandas as pd
        import pyarrow.fs as pafs
        open_files = {}
        fs, base = pafs.FileSystem.from_uri(root) if "://" in root else (pafs.LocalFileSystem(), root)
        fs.create_dir(base)
        for pdf in batches:
            for day, rows in pdf.groupby("event_date"):
                text = rows.drop(columns="event_date").to_csv(index=False, header=day not in open_files)
                open_files.setdefault(day, []).append(text)
        for day, texts in open_files.items():
            with fs.open_output_stream(f"{base}/aisdk-{day}.zip") as out:

                data = io.BytesIO()
                with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as z:
                    z.writestr(f"aisdk-{day}.csv", "".join(texts))
                raw = bytearray(data.getvalue())
                if day == damaged:
                    raw[len(raw) // 2] ^= 0xFF
                out.write(bytes(raw))
            yield pd.DataFrame({"day": [str(day)]})

    days.repartition("event_date").mapInPandas(write, "day string").collect()      # one short row per day


@register("archive_days", f"""SELECT event_date, CASE WHEN event_date = (SELECT min(CAST(ts AS DATE)) FROM events) + {DAMAGED_DAY}
  THEN 'open' ELSE 'stored' END AS state, CASE WHEN event_date <> (SELECT min(CAST(ts AS DATE)) FROM events) + {DAMAGED_DAY} THEN n ELSE 0 END AS n
FROM (SELECT CAST(ts AS DATE) AS event_date, count(*) AS n FROM events GROUP BY 1) t""")
def q_archive_days(spark, sf_dir):
    """A1/A3: archives written from the events, one of them damaged, read in one
    pass each: all rows of the whole ones, none of the other, whose day stays open."""
    ev, root = table(spark, sf_dir, "events"), _scratch(spark, "archives")
    d0 = ev.agg(F.min(F.to_date("ts"))).first()[0]  # one scalar
    rows = ev.select(F.to_date("ts").alias("event_date"), F.date_format("ts", RAW_TIMESTAMP_FORMAT).alias("# Timestamp"),
                     F.col("user_id").cast("string").alias("IMO"), F.col("value").cast("string").alias("SOG"))
    _write_archives(rows, root.removeprefix("file:"), d0 + dt.timedelta(days=DAMAGED_DAY))
    raw = R.read_raw(spark, root.removeprefix("file:"))
    return raw.groupBy("event_date").agg(F.max(F.when(F.col("error").isNotNull(), "open").otherwise("stored")).alias("state"),
                                         F.count_if(F.col("error").isNull()).alias("n"))


@register("daily_compacted", with_ctes(_VP, f"{_DAILY} GROUP BY event_date, imo"))
def q_daily_compacted(spark, sf_dir):
    """A5: the daily table written in many small files, then compacted in place."""
    p, root = _daily_pings(spark, sf_dir), _scratch(spark, "daily")
    for k in range(3):
        p.where(F.pmod(F.xxhash64("imo"), F.lit(3)) == k).write.mode("append").partitionBy("event_date").parquet(root)
    K.compact_days(spark, root)
    return _per_day(R.read_daily(spark, root))


@register("track_order", with_ctes(_VP, """SELECT imo, ts, n,
  CAST(coalesce(sum(n) OVER (PARTITION BY imo ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
    AS BIGINT) AS n_before
FROM (SELECT imo, ts, count(*) AS n FROM vpings GROUP BY imo, ts) t"""))
def q_track_order(spark, sf_dir):
    return ST.track_order(vessel_pings(spark, sf_dir), "imo")


# ---------------------------------------------------------------- weeks merged from days

LANDINGS = 3


@register("weekly_merged", rounded(with_ctes(_W, "SELECT * FROM weekly"), OW.WEEKLY_DOUBLES))
def q_weekly_merged(spark, sf_dir):
    """Days land in three batches out of order; the first of them landed
    before with half of its vessels.  The stored weeks equal one roll-up of all."""
    p, base = _daily_pings(spark, sf_dir), _scratch(spark, "weeks")
    d0 = p.select(F.min("event_date")).scalar()
    third = F.pmod(F.datediff("event_date", d0), F.lit(LANDINGS))
    for days in (p.where((third == 2) & (F.col("imo") % 2 == 0)), p.where(third == 1), p.where(third == 2), p.where(third == 0)):
        J.update_weeks(spark, days.drop("event_date"), f"{base}/state", f"{base}/weekly", ADAPTER_MIN_PINGS)
    return K.read_dataset(spark, f"{base}/weekly")


# ---------------------------------------------------------------- feature dataset

DATASET = ["imo", "week_start", "ship_type", "n_pings", "sog_median", "length"]


def _appended(spark, sf_dir, csv_export=None):
    """The first weeks stored, then all weeks appended twice."""
    w = weekly(spark, sf_dir, stored=True).select(*DATASET)
    cutoff = F.date_add(w.select(F.min("week_start")).scalar(), STORED_DAYS)
    path = _scratch(spark, "dataset")
    K.write_dataset(w.where(F.col("week_start") < cutoff), path)
    K.write_dataset(w, path, mode="append")
    K.write_dataset(w, path, mode="append", csv_export=csv_export)
    return path, w.schema


_DATASET_SQL = rounded(with_ctes(_W, f"SELECT {', '.join(DATASET)} FROM weekly"), ["sog_median", "length"])


@register("dataset_appended", _DATASET_SQL)
def q_dataset_appended(spark, sf_dir):
    return K.read_dataset(spark, _appended(spark, sf_dir)[0])


@register("dataset_csv", _DATASET_SQL)
def q_dataset_csv(spark, sf_dir):
    """The CSV export read back with its schema."""
    export = _scratch(spark, "dataset-csv")
    _, schema = _appended(spark, sf_dir, export)
    return K.read_dataset(spark, export, "csv", T.StructType([T.StructField(f.name, f.dataType) for f in schema]))


@register("stored_keys", with_ctes(_W, "SELECT imo, week_start FROM weekly"))
def q_stored_keys(spark, sf_dir):
    return K.existing_keys(spark, _appended(spark, sf_dir)[0])


@register("features_and_target", rounded(with_ctes(_W, f"SELECT {', '.join(MODEL_FEATURES)}, ship_type FROM weekly"),
                                         [c for c in OW.WEEKLY_DOUBLES if c in MODEL_FEATURES]))
def q_features_and_target(spark, sf_dir):
    return M.features_and_target(weekly(spark, sf_dir), MODEL_FEATURES, "ship_type")


TRAIN_FROM_DAY, TRAIN_TO_DAY = 7, 20


@register("training_rows", with_ctes(_W, f"""SELECT imo, week_start, n_pings FROM weekly
WHERE week_start BETWEEN (SELECT min(week_start) FROM weekly) + {TRAIN_FROM_DAY}
  AND (SELECT min(week_start) FROM weekly) + {TRAIN_TO_DAY}"""))
def q_training_rows(spark, sf_dir):
    w = weekly(spark, sf_dir, groups=["temporal"], stored=True)
    first = w.agg(F.min("week_start")).first()[0]  # one scalar
    return J.training_rows(w, first + dt.timedelta(days=TRAIN_FROM_DAY), first + dt.timedelta(days=TRAIN_TO_DAY)).select(
        "imo", "week_start", "n_pings")


# ---------------------------------------------------------------- monitoring state

_US = "epoch_us({})"


@register("last_checked", f"""SELECT 'check is later' AS state, {_US.format('max(ts)')} AS cutoff_us FROM events
UNION ALL SELECT 'training is later', {_US.format('CAST(CAST(max(ts) AS DATE) AS TIMESTAMP)')} FROM events""")
def q_last_checked(spark, sf_dir):
    """The greater of the last check and the end of the training data, for
    a check after the training data and for one before their end."""
    span = table(spark, sf_dir, "events").select(
        F.min(utc_instant("ts")).alias("t0"), F.max(utc_instant("ts")).alias("t1"),
        F.to_date(F.min("ts")).alias("d0"), F.to_date(F.max("ts")).alias("d1")).first()  # four scalars
    parts = []
    for state, checks, end in [("check is later", [span["t0"], span["t1"]], span["d0"]),
                               ("training is later", [span["t0"]], span["d1"])]:
        path = _scratch(spark, "state")
        for t in checks:
            K.save_last_checked(spark, f"{path}/checks", t)
        K.save_training_metadata(spark, f"{path}/runs", span["d0"], end, "run")
        cutoff = K.last_checked(spark, f"{path}/checks", f"{path}/runs")
        parts.append(spark.range(1).select(F.lit(state).alias("state"),
                                           F.unix_micros(F.lit(cutoff).cast("timestamp")).alias("cutoff_us")))
    return parts[0].unionByName(parts[1])


# ---------------------------------------------------------------- prediction log: ledger, scorings

LATE_LOG_DAYS = 14      # entries that old are written last
_LOG_ENTRY = """strftime(CAST(week_start AS TIMESTAMP) + to_minutes(imo), '%Y-%m-%dT%H:%M:%S.%f') || 'Z' AS timestamp, sog_median"""
_ENTRY = ["timestamp", "features.sog_median"]


@register("log_since_ledger", rounded(with_ctes(_W, f"""SELECT 'late' AS read_as, {_LOG_ENTRY} FROM weekly
WHERE week_start < (SELECT min(week_start) FROM weekly) + {LATE_LOG_DAYS}
UNION ALL SELECT 'first' AS read_as, {_LOG_ENTRY} FROM weekly
WHERE week_start >= (SELECT min(week_start) FROM weekly) + {LATE_LOG_DAYS}"""), ["sog_median"]))
def q_log_since_ledger(spark, sf_dir):
    """Newer entries are read and marked; then a file with old time stamps
    arrives and is read alone; a third look finds nothing."""
    base = _scratch(spark, "ledger")
    lines = log_lines(spark, sf_dir).transform(materialize)
    stamp = F.to_timestamp(F.get_json_object("value", "$.timestamp"))
    old = stamp < lines.select(F.min(stamp)).scalar() + F.make_dt_interval(days=F.lit(LATE_LOG_DAYS))
    out = None
    for read_as, part in (("first", lines.where(~F.coalesce(old, F.lit(False)))), ("late", lines.where(old)), ("none", None)):
        if part is not None:
            part.write.mode("append").text(f"{base}/log")
        files = LG.unread_files(spark, f"{base}/log", f"{base}/ledger")
        rows = LG.read_files(spark, files, MODEL_FEATURES).select(F.lit(read_as).alias("read_as"), *_ENTRY).transform(materialize)
        LG.mark_read(files, f"{base}/ledger")
        out = rows if out is None else out.unionByName(rows)
    return out


@register("log_scored_once", rounded(with_ctes(_W, f"SELECT {_LOG_ENTRY} FROM weekly"), ["sog_median"]))
def q_log_scored_once(spark, sf_dir):
    """Every week is scored under an id of its own half, the first half
    twice; the log has each entry once."""
    base = _scratch(spark, "scored")
    rows = LG.parse_log(log_lines(spark, sf_dir), MODEL_FEATURES).transform(materialize)
    half = rows.select("*", "features.*").withColumn("half", F.pmod(F.xxhash64("timestamp"), F.lit(2)))
    for k in (0, 1, 0):
        scored = half.where(F.col("half") == k)
        LG.append_log_once(scored, base, MODEL_FEATURES, f"half-{k}", "vessel_type", ts=F.col("timestamp"))
    return LG.read_scorings(spark, base, MODEL_FEATURES).select(*_ENTRY)


@register("current_version", """SELECT max(event_type) AS run_id, count(DISTINCT event_type) AS promoted FROM events""")
def q_current_version(spark, sf_dir):
    """A run per kind of event is promoted, in order; the last is current."""
    root = _scratch(spark, "runs")
    kinds = [r[0] for r in table(spark, sf_dir, "events").select("event_type").distinct().orderBy("event_type").collect()]
    for kind in kinds:
        J.promote(spark, root, kind)
    current = F.lit(J.current_run(spark, root)).alias("run_id")
    return J.versions(spark, root).agg(F.count(F.lit(1)).alias("promoted")).select(current, "promoted")


# ---------------------------------------------------------------- schema file, stored baselines, runs, a stump

_DTYPE = "CASE data_type WHEN 'DOUBLE' THEN 'float64' WHEN 'BIGINT' THEN 'int64' WHEN 'INTEGER' THEN 'int32' WHEN 'VARCHAR' THEN 'object' ELSE 'datetime' END"


@register("schema_file", f"""SELECT DISTINCT column_name AS name, {_DTYPE} AS dtype,
  data_type IN ('DOUBLE', 'BIGINT', 'INTEGER') AS is_numeric
FROM information_schema.columns WHERE table_name = 'lineitem'""")
def q_schema_file(spark, sf_dir):
    """The schema file written and read back, and the numeric columns."""
    li, path = table(spark, sf_dir, "lineitem"), _scratch(spark, "schema")
    K.write_schema(spark, path, K.schema_spec(li, li.columns))
    spec, numeric = K.load_schema(spark, path), set(numeric_columns(li))
    K.validate_schema(li, spec)
    return spark.createDataFrame([(c, spec["dtypes"][c], c in numeric) for c in spec["columns"]], "name string, dtype string, is_numeric boolean")


@register("baselines_stored", rounded(with_ctes([_LI, _LIBASE] + OD.baseline_ctes("lbase", LI_FEATURES) + OD.predicted_ctes("lbase", "lsrc"),
    """SELECT feature, class, bin, CASE WHEN bin > 0 THEN lo END AS lo, ref_prop FROM bins
UNION ALL SELECT 'classes', class, NULL, NULL, ref FROM pref"""), ["lo", "ref_prop"]))
def q_baselines_stored(spark, sf_dir):
    """Bins and class shares of the baseline, saved and loaded."""
    _, base = lineitem_monthly(spark, sf_dir)
    path = _scratch(spark, "baselines")
    K.save_baselines(*D.build_baselines(base, LI_FEATURES, "l_returnflag", "l_linestatus"), path)
    bins, classes = K.load_baselines(spark, path)
    none = F.lit(None)
    return bins.select("feature", "class", "bin", F.when(F.col("bin") > 0, F.col("lo")).alias("lo"), "ref_prop").unionByName(
        classes.select(F.lit("classes").alias("feature"), "class", none.cast("long").alias("bin"), none.cast("double").alias("lo"), "ref_prop"))


@register("training_recorded", """SELECT event_type AS run_id, min(CAST(ts AS DATE)) AS data_start, max(CAST(ts AS DATE)) AS data_end
FROM events GROUP BY event_type""")
def q_training_recorded(spark, sf_dir):
    """A training run per kind of event, recorded with the days of its data."""
    path = _scratch(spark, "runs")
    spans = table(spark, sf_dir, "events").groupBy("event_type").agg(F.to_date(F.min("ts")).alias("a"), F.to_date(F.max("ts")).alias("b"))
    for r in spans.collect():       # one row per kind of event
        K.save_training_metadata(spark, path, r["a"], r["b"], r["event_type"])
    return spark.read.parquet(path).select("run_id", "data_start", "data_end")


_STUMP = [("t", "SELECT CASE WHEN l_quantity > 20 THEN 1e0 ELSE 0e0 END AS x, CASE WHEN l_quantity <= 10 THEN 'small' WHEN l_quantity <= 30 THEN 'middle' "
               "ELSE 'large' END AS class, count(*) AS n FROM lineitem GROUP BY ALL"),
          ("w", "SELECT class, (SELECT sum(n) FROM t) / ((SELECT count(DISTINCT class) FROM t) * sum(n)) AS w FROM t GROUP BY class"),
          ("leaf", "SELECT g.x, w.class, coalesce(t.n, 0) * w.w AS m FROM (SELECT DISTINCT x FROM t) g CROSS JOIN w LEFT JOIN t ON t.x = g.x AND t.class = w.class"),
          ("scored", "SELECT x, class, m / sum(m) OVER (PARTITION BY x) AS probability, row_number() OVER (PARTITION BY x ORDER BY m DESC) AS r FROM leaf")]


def _stump(spark, sf_dir):
    """A tree of one split (balanced weights): the one column that tells anything apart is known."""
    size = F.when(F.col("l_quantity") <= 10, "small").when(F.col("l_quantity") <= 30, "middle").otherwise("large")
    rows = table(spark, sf_dir, "lineitem").select((F.col("l_quantity") > 20).cast("double").alias("x"), F.lit(1.0).alias("flat"), size.alias("size"))
    return M.train_forest(rows, ["x", "flat"], "size", num_trees=1, max_depth=1, bootstrap=False), rows


@register("stump_scores", rounded(with_ctes(_STUMP, """SELECT s.x, s.class, s.probability, p.class AS prediction
FROM scored s JOIN scored p ON p.x = s.x AND p.r = 1"""), ["x", "probability"]))
def q_stump_scores(spark, sf_dir):
    """Class probabilities and prediction of both leaves."""
    model, rows = _stump(spark, sf_dir)
    leaves = rows.select("x", "flat").distinct()
    return M.predict_proba(model, leaves, ["x", "flat"]).select("x", "prediction", F.explode("probabilities").alias("class", "probability"))


@register("stump_importance", """SELECT f AS feature, CASE WHEN f = 'x__imp' AND count(DISTINCT l_quantity > 20) > 1 THEN 1e0 ELSE 0e0 END AS importance
FROM lineitem, (VALUES ('x__imp'), ('flat__imp'), ('x__missing'), ('flat__missing')) v(f) GROUP BY f""")
def q_stump_importance(spark, sf_dir):
    """I10 of that tree."""
    return M.impurity_importance(_stump(spark, sf_dir)[0])


# ---------------------------------------------------------------- raw text, periods, stacked results

BAD_TIME, BAD_ID, BAD_SPEED, NO_SPEED = 17, 19, 23, 29


def _raw_text(spark, sf_dir):
    """Text under the raw headers, with times in another format, ids that are no
    digits, speeds that are no numbers and null tokens."""
    def unless(n: int, bad: str, text):
        return F.when(F.col("event_id") % n == 0, F.lit(bad)).otherwise(text)
    text = {"ts_text": F.when(F.col("event_id") % BAD_TIME == 0, F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
            .otherwise(F.date_format("ts", RAW_TIMESTAMP_FORMAT)),
            "imo_text": unless(BAD_ID, "Unknown", F.col("user_id").cast("string")),
            "sog": unless(NO_SPEED, "NA", unless(BAD_SPEED, "fast", F.col("value").cast("string"))),
            "nav_status": F.col("event_type")}
    raw = table(spark, sf_dir, "events").select(
        F.lit(None).cast("string").alias("error"), F.to_date("ts").alias("event_date"),
        *[text.get(c, F.lit(None).cast("string")).alias(header) for header, c in R.RAW_COLUMNS.items()])
    return R.rename_raw(raw)


@register("raw_parsed", f"""SELECT CASE WHEN event_id % {BAD_ID} <> 0 THEN user_id END AS imo,
  CASE WHEN event_id % {BAD_TIME} <> 0 THEN date_trunc('second', ts) END AS ts,
  CASE WHEN event_id % {BAD_SPEED} <> 0 AND event_id % {NO_SPEED} <> 0 THEN value END AS sog,
  event_type AS nav_status, CAST(ts AS DATE) AS event_date FROM events""")
def q_raw_parsed(spark, sf_dir):
    """The raw text parsed."""
    return R.parse_raw(_raw_text(spark, sf_dir)).select("imo", "ts", "sog", "nav_status", "event_date")


_BAD = {"timestamp": f"event_id % {BAD_TIME} = 0", "imo": f"event_id % {BAD_ID} = 0",
        "sog": f"event_id % {BAD_SPEED} = 0 AND event_id % {NO_SPEED} <> 0"}


@register("raw_rejects", "SELECT 'rows' AS reason, count(*) AS n FROM events" + "".join(
    f"\nUNION ALL SELECT '{k}', count(*) FILTER (WHERE {_BAD.get(k, 'false')}) FROM events" for k in ["archive", "timestamp", "imo", *R.NUMERIC]))
def q_raw_rejects(spark, sf_dir):
    """What could not be parsed, by reason, counted in the pass that stores the rows."""
    rejects = Observation("rejects")
    materialize(R.parse_raw(R.observe_rejects(_raw_text(spark, sf_dir), rejects)), "parsed")
    return R.reject_counts(spark, rejects)


@register("period_dates", """SELECT CAST(ts AS DATE) AS as_date, CAST(ts AS DATE) AS as_time,
  CASE WHEN event_id % 4 < 3 THEN CAST(ts AS DATE) END AS as_text, CAST(ts AS DATE) AS as_own_format, count(*) AS n
FROM events GROUP BY ALL""")
def q_period_dates(spark, sf_dir):
    """dates, times, text in three formats (and none), text in a given format."""
    kind = F.col("event_id") % 4
    ev = table(spark, sf_dir, "events").select(
        F.to_date("ts").alias("d"), F.col("ts").alias("t"), F.date_format("ts", "dd.MM.yyyy").alias("own"),
        F.when(kind == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
        .when(kind == 1, F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
        .when(kind == 2, F.date_format("ts", "yyyy-MM-dd")).otherwise("no date").alias("x"))
    return ev.groupBy(D.period_as_date(ev, "d").alias("as_date"), D.period_as_date(ev, "t").alias("as_time"),
                      D.period_as_date(ev, "x").alias("as_text"),
                      D.period_as_date(ev, "own", "dd.MM.yyyy").alias("as_own_format")).agg(F.count(F.lit(1)).alias("n"))


SKETCHED = {"q10": 0.1, "q50": 0.5, "q90": 0.9}


@register("sketch_quantiles", """SELECT event_type, q, n, true AS within
FROM (SELECT event_type, count(value) AS n FROM events GROUP BY event_type) t, (VALUES ('q10'), ('q50'), ('q90')) v(q)""")
def q_sketch_quantiles(spark, sf_dir):
    """Quantiles read off merged daily sketches lie within the sketch's
    rank error (taken twice, for certainty) of the exact rank."""
    ev = table(spark, sf_dir, "events").select("event_type", F.to_date("ts").alias("day"), "value")
    daily = SK.value_sketches(ev, ["event_type", "day"], "value").transform(materialize)
    found = SK.sketch_quantiles(SK.merge_sketches(daily, ["event_type"]), ["event_type"], SKETCHED)
    long = found.unpivot(["event_type", "n"], list(SKETCHED), "q", "estimate").transform(materialize)
    ranks = ev.join(long.select("event_type", "q", "estimate"), "event_type").groupBy("event_type", "q").agg(
        (F.count_if(F.col("value") < F.col("estimate")) / F.count("value")).alias("below"),
        (F.count_if(F.col("value") <= F.col("estimate")) / F.count("value")).alias("upto"))
    want = F.element_at(F.create_map(*[F.lit(x) for kv in SKETCHED.items() for x in kv]), F.col("q"))
    slack = 2 * SK.rank_error()
    return long.join(ranks, ["event_type", "q"]).select(
        "event_type", "q", "n", ((F.col("below") <= want + slack) & (F.col("upto") >= want - slack)).alias("within"))


@register("stacked_results", rounded("""SELECT l_returnflag AS class, count(*) AS n, max(l_quantity) AS max_quantity
FROM lineitem GROUP BY l_returnflag
UNION ALL BY NAME SELECT o_orderstatus AS class, max(o_totalprice) AS max_price, count(*) AS n
FROM orders GROUP BY o_orderstatus""", ["max_quantity", "max_price"]))
def q_stacked_results(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").groupBy(F.col("l_returnflag").alias("class")).agg(
        F.count(F.lit(1)).alias("n"), F.max("l_quantity").alias("max_quantity"))
    od = table(spark, sf_dir, "orders").groupBy(F.col("o_orderstatus").alias("class")).agg(
        F.max("o_totalprice").alias("max_price"), F.count(F.lit(1)).alias("n"))
    return D.stack_results(li, od)


# ---------------------------------------------------------------- stream with repeated and late pings

LATE_DAYS = 10  # pings that old arrive again, a second later, when their week is closed


@register("stream_late", ORACLE["stream_weekly"])
def q_stream_late(spark, sf_dir):
    """K3: every ping arrives twice; then pings of closed weeks arrive at new
    times.  The closed weeks come out as if neither had happened."""
    base, ev = _scratch(spark, "stream-late"), table(spark, sf_dir, "events")

    def run():
        run_weekly_stream(spark, f"{base}/in", ev.schema, sink=f"{base}/out", checkpoint=f"{base}/ckpt",
                          min_pings=ADAPTER_MIN_PINGS, state_partitions=spark.sparkContext.defaultParallelism,
                          adapt=lambda s: keep_ship_types(pings_from_events(s))).awaitTermination()
    ev.unionByName(ev).write.parquet(f"{base}/in")
    run()
    old = F.col("ts") < ev.select(F.max("ts")).scalar() - F.make_dt_interval(days=F.lit(LATE_DAYS))
    ev.where(old).withColumn("ts", F.col("ts") + F.make_dt_interval(secs=F.lit(1))).write.mode("append").parquet(f"{base}/in")
    run()
    return read_weeks(spark, f"{base}/out")
