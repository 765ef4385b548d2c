"""State that is merged, corrected or promoted: moments, weeks, drift counts, log, runs."""

import datetime as dt
import json
import math
import random
import statistics
import uuid
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from wakeline.config import RAW_TIMESTAMP_FORMAT
from wakeline.operators import drift as D
from wakeline.operators.moments import deviation, mean, power_sums
from wakeline.functions import week_start
from wakeline.operators.weekly import (GROUPS, features_of, merge_partials, merge_value_counts, numeric_features, numeric_partials,
                                       value_counts, weekly_features)
from wakeline.plans import jobs as J
from wakeline.session import scratch_path
from wakeline.sources import logs as L
from wakeline.sources import raw as R
from wakeline.streaming.jobs import drift_batches, latest_drift, run_weekly_stream

from tests.test_weekly import COLS, T0, ping


def scratch(spark, name):
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:10]}")


# ------------------------------------------------------------------ moments
def moments_of(spark, values, parts=3):
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(parts)
    return df.agg(*[F.sum(c).alias(k) for k, c in power_sums("x", F.col("x")).items()]).select(mean("x").alias("m"), deviation("x").alias("s")).first()


@pytest.mark.parametrize("values", [[0.1, 0.2, 0.7], [-720.0, 719.9, 0.0, 1e-9], [55.123456, 55.123457] * 50, [360.0] * 7, [-0.5, None, 2.25]])
def test_moments_equal_the_textbook(spark, values):
    given = [v for v in values if v is not None]
    r = moments_of(spark, values)
    assert r.m == pytest.approx(statistics.fmean(given), abs=1e-9) and r.s == pytest.approx(statistics.stdev(given), abs=1e-9)


def test_moments_of_few_and_odd_values(spark):
    assert tuple(moments_of(spark, [None, None])) == (None, None)
    assert tuple(moments_of(spark, [3.5])) == (3.5, None)
    for odd in (float("nan"), float("inf"), 1e300, -4096.0):
        assert all(math.isnan(v) for v in moments_of(spark, [1.0, odd, 2.0]))
    assert tuple(moments_of(spark, [4095.999] * 3)) == (pytest.approx(4095.999), 0.0)


def random_pings(n=600, seed=3):
    r = random.Random(seed)
    return [(1 + r.randrange(3), T0 + dt.timedelta(minutes=r.randrange(60 * 24 * 12)), r.choice(["Cargo", "Tug", None]), r.choice([99.5, 100.0]), 20.0,
             r.choice([4.1, 5.3, None]), r.choice([None, round(r.random() * 20, 1)]), round(r.random() * 360, 1), round(r.random() * 40 - 20, 2),
             float(round(r.random() * 360)), r.choice(["Moored", "At anchor", None]), 55 + r.random(), 10 + r.random(), r.choice(["Category X", None])) for _ in range(n)]


def test_features_do_not_depend_on_partitioning_or_merging(spark):
    """Bit-identical rows over 50 ways to deal the pings and merge their partials."""
    df = spark.createDataFrame(random_pings(), COLS).cache()
    keys = ["imo", "week_start"]
    base = df.withColumn("week_start", week_start("ts"))
    whole = list(map(tuple, weekly_features(df.repartition(1), min_pings=1).collect()))
    groups = ["speed", "course", "spatial"]
    moments = numeric_features(numeric_partials(base, keys, groups), keys, groups).columns
    expected = sorted(map(tuple, numeric_features(numeric_partials(base, keys, groups), keys, groups).collect()))
    for k in range(50):
        dealt = base.withColumn("piece", F.pmod(F.xxhash64("ts", "sog", F.lit(k)), F.lit(1 + k % 7))).repartition(1 + k % 5, F.xxhash64("latitude", F.lit(k)))
        got = numeric_features(merge_partials(numeric_partials(dealt, [*keys, "piece"], groups), keys, groups), keys, groups)
        assert got.columns == moments and sorted(map(tuple, got.collect())) == expected
        if k % 25 == 0:
            parts = merge_partials(numeric_partials(dealt, [*keys, "piece"]), keys)
            counts = merge_value_counts(value_counts(dealt, [*keys, "piece"]), keys)
            assert sorted(map(tuple, features_of(parts, counts, keys, GROUPS, 1).collect()), key=str) == sorted(whole, key=str)
    df.unpersist()


# ------------------------------------------------------- weeks merged from days
def test_late_repeated_and_corrected_days(spark):
    rows = random_pings(400, 5)
    df = spark.createDataFrame(rows, COLS)
    state, out = scratch(spark, "state"), scratch(spark, "weekly")
    day = F.to_date("ts")
    first = dt.date(2024, 1, 2)

    def land(*days, of=df):
        return J.update_weeks(spark, of.where(day.isin([first + dt.timedelta(days=k) for k in days])), state, out, 1)

    assert land(9, 0) == [dt.date(2024, 1, 1), dt.date(2024, 1, 8)]
    land(3, 4, of=df.where("imo = 1"))                  # incomplete, landed again below
    land(12, 11, 10, 2)
    assert land(1) == [dt.date(2024, 1, 1)]
    land(3, 4, 5, 6, 7, 8)
    land(0)                                             # once more: counts once
    got = spark.read.parquet(out).select(*weekly_features(df, min_pings=1).columns)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, weekly_features(df, min_pings=1).collect()), key=str)
    assert J.update_weeks(spark, df.where("false"), state, out, 1) == []


def test_a_week_that_loses_its_pings_becomes_empty_and_others_keep_their_files(spark):
    df = spark.createDataFrame([ping(i) for i in range(5)] + [ping(0, ts=T0 + dt.timedelta(days=7), imo=2)], COLS)
    state, out = scratch(spark, "state"), scratch(spark, "weekly")
    J.update_weeks(spark, df, state, out, 1)
    files = {f for f in spark.read.parquet(out).inputFiles() if "2024-01-08" in f}
    J.update_weeks(spark, df.where("imo = 1").limit(2), state, out, 3)      # the day corrected to two pings
    after = spark.read.parquet(out)
    assert [(r["imo"], r["week_start"]) for r in after.collect()] == [(2, dt.date(2024, 1, 8))]
    assert files == {f for f in after.inputFiles() if "2024-01-08" in f}


# ------------------------------------------------------------------ streaming
def test_stream_state_is_bounded_by_distinct_values(spark):
    """2 vessels x 500 pings of 4 speeds: the roll-up keeps a row per value, not per ping."""
    rows = [(imo, T0 + dt.timedelta(seconds=30 * i), "Cargo", 100.0, 20.0, 5.0, float(i % 4), 10.0, 1.0, 20.0, "Moored", 55.0, 10.0, "Category X")
            for imo in (1, 2) for i in range(500)]
    rows.append(ping(0, ts=T0 + dt.timedelta(days=3), imo=3))
    src, base = scratch(spark, "in"), scratch(spark, "out")
    df = spark.createDataFrame(rows, COLS)
    df.write.parquet(src)
    q = run_weekly_stream(spark, src, df.schema, f"{base}/out", f"{base}/ckpt", min_pings=1, state_partitions=2, dedupe=False)
    q.awaitTermination()
    ops = q.lastProgress["stateOperators"]
    assert sum(op["numRowsTotal"] for op in ops) <= 3 * (1 + 4 + 4)    # numeric, one per single-valued column, speeds


def test_stream_tells_repeats_once(spark):
    """One state of seen pings and one of partials; late and repeated pings change nothing."""
    r = random.Random(5)
    rows = [ping(i, ts=T0 + dt.timedelta(minutes=37 * i), imo=1 + i % 3, sog=r.choice([None, 0.2, 1.5, 11.0]), status=r.choice([None, "Moored", "At anchor"]),
                 length=r.choice([100.0, 101.0, None])) for i in range(200)]
    late = [ping(0, ts=T0 + dt.timedelta(days=30), imo=9)]
    df, base, src = spark.createDataFrame(rows, COLS), scratch(spark, "out"), scratch(spark, "in")
    df.unionByName(df).unionByName(spark.createDataFrame(late, COLS)).write.parquet(src)
    q = run_weekly_stream(spark, src, df.schema, f"{base}/out", f"{base}/ckpt", min_pings=1, state_partitions=2)
    q.awaitTermination()
    assert sorted(op["operatorName"] for op in q.lastProgress["stateOperators"]) == ["dedupeWithinWatermark", "stateStoreSave"]
    assert q.recentProgress[0]["numInputRows"] == 401            # read once
    rounded = lambda d: sorted((tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in d.collect()), key=str)
    expected = weekly_features(df, min_pings=1)
    assert rounded(spark.read.parquet(f"{base}/out").select(*expected.columns)) == rounded(expected)


def log_line(ts, x):
    return json.dumps({"timestamp": ts, "features": {"x": x}, "vessel_type": "Cargo", "probabilities": {"Cargo": 1.0}})


def test_drift_counts_add_up_and_replays_replace(spark):
    r = random.Random(2)
    base = spark.createDataFrame([(r.gauss(0, 1),) for _ in range(400)], "x double")
    bins, _ = D.build_baselines(base, ["x"])
    values = [r.gauss(0.6, 1) for _ in range(300)]
    lines = lambda vs: spark.createDataFrame([(log_line("2024-02-05T00:00:00Z", v),) for v in vs] + [("broken",)], "value string")
    period = F.lit("2024-02-05").cast("date")
    results, counts = scratch(spark, "results"), scratch(spark, "counts")
    check = drift_batches(bins, ["x"], results, counts, period=period)
    for k in range(3):
        check(lines(values[k * 100:(k + 1) * 100]), k)
    check(lines(values[100:200]), 1)
    whole = D.monitor_numeric(spark.createDataFrame([(v,) for v in values], "x double").withColumn("period", period), bins, ["x"], "period").first()
    got = latest_drift(spark.read.parquet(results)).collect()
    assert len(got) == 1 and got[0]["psi"] == pytest.approx(whole["psi"], abs=1e-12) and got[0]["batch_id"] == 2
    assert spark.read.parquet(counts).agg(F.sum("n")).first()[0] == 300


def test_unseen_share(spark):
    base = spark.createDataFrame([("A",)] * 6 + [("B",)] * 4, "c string")
    rows = spark.createDataFrame([(1, "A"), (1, "Z"), (1, None), (1, "B"), (2, "Z"), (3, "A")], "period int, c string")
    out = {r["period"]: r for r in D.monitor_predicted_class(rows, D.class_shares(base, "c"), "c", "period").collect()}
    assert [round(out[k]["unseen_share"], 6) for k in (1, 2, 3)] == [0.5, 1.0, 0.0]
    assert out[1]["psi"] == pytest.approx(0.1 * math.log(0.6 / 0.5) + 0.1 * math.log(0.5 / 0.4))


# ----------------------------------------------------------- log and its ledger
def test_ledger_finds_late_files_and_reads_none_twice(spark):
    log, ledger = scratch(spark, "log"), scratch(spark, "ledger")

    def write(*entries):
        spark.createDataFrame([(log_line(*e),) for e in entries], "value string").coalesce(1).write.mode("append").text(log)

    def read():
        files = L.unread_files(spark, log, ledger)
        rows = sorted(r["features"]["x"] for r in L.read_files(spark, files, ["x"]).collect())
        return rows, files

    write(("2024-02-05T00:00:00Z", 1.0))
    rows, files = read()
    assert rows == [1.0] and read()[0] == [1.0]         # not marked: read again
    L.mark_read(files, ledger)
    write(("2024-01-01T00:00:00Z", 2.0), ("2024-02-05T00:00:00Z", 3.0))
    rows, files = read()
    assert rows == [2.0, 3.0]
    L.mark_read(files, ledger)
    assert read()[0] == []


def test_a_scoring_enters_the_log_once(spark):
    log = scratch(spark, "log")
    scored = spark.createDataFrame([(1.0, "Cargo"), (2.0, "Tug")], "x double, prediction string").withColumn(
        "probabilities", F.create_map("prediction", F.lit(1.0)))
    broken = scored.withColumn("x", F.raise_error(F.lit("scoring died")).cast("double"))
    with pytest.raises(Exception, match="scoring died"):
        L.append_log_once(broken, log, ["x"], "a")
    assert L.append_log_once(scored, log, ["x"], "a") and not L.append_log_once(scored, log, ["x"], "a")
    L.to_log_rows(scored, ["x"]).write.json(f"{log}/scorings/b")          # written, not promoted
    assert sorted(r["features"]["x"] for r in L.read_scorings(spark, log, ["x"]).collect()) == [1.0, 2.0]
    assert L.append_log_once(scored, log, ["x"], "b")
    assert L.read_scorings(spark, log, ["x"]).count() == 4


# -------------------------------------------------------------- rejects, versions
def test_rejects_are_counted_while_the_rows_pass(spark):
    cols = ", ".join(f"{c} string" for c in R.RAW_COLUMNS.values())
    blank = dict.fromkeys(R.RAW_COLUMNS.values())
    good = blank | {"ts_text": "05/01/2024 00:00:00", "imo_text": "123", "sog": "1.5"}
    rows = [good, good | {"ts_text": "2024-01-05"}, good | {"ts_text": "NA"}, good | {"imo_text": "Unknown"}, good | {"imo_text": "9" * 30}, good | {"sog": "fast", "rot": "x"}]
    df = spark.createDataFrame([(None, None, *[r[c] for c in R.RAW_COLUMNS.values()]) for r in rows] + [("bad zip", None, *[None] * len(blank))],
                               f"error string, event_date date, {cols}")
    seen = Observation("seen")
    assert R.parse_raw(R.observe_rejects(df, seen)).collect()[0]["ts"] == dt.datetime.strptime("05/01/2024", "%d/%m/%Y")
    counts = {r["reason"]: r["n"] for r in R.reject_counts(spark, seen).collect()}
    assert {k: v for k, v in counts.items() if v} == {"rows": 7, "archive": 1, "timestamp": 1, "imo": 2, "sog": 1, "rot": 1}
    assert RAW_TIMESTAMP_FORMAT.startswith("dd")


def test_versions_survive_failed_and_concurrent_writers(spark):
    root = scratch(spark, "runs")
    J.promote(spark, root, "one")
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda k: J.promote(spark, root, f"run-{k}"), range(4)))
    assert J.versions(spark, root).count() == 5
    assert J.current_run(spark, root).startswith("run-")
    with pytest.raises(ValueError):
        J.train(spark, scratch(spark, "nothing"), "2024-02-01", "2024-01-01", root)      # fails before its promotion
    assert J.current_run(spark, root).startswith("run-")
