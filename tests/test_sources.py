"""Raw zip source, parsing, partitioned and append-once sinks, prediction log."""

import datetime as dt
import json
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from wakeline.sources import logs as L
from wakeline.sources import raw as R
from wakeline.sources import sinks as K

HEADER = ["# Timestamp", "Type of mobile", "MMSI", "Latitude", "Longitude", "Navigational status", "ROT",
          "SOG", "COG", "Heading", "IMO", "Callsign", "Name", "Ship type", "Cargo type", "Width", "Length",
          "Draught"]


def _line(ts, imo, ship, sog, status="Moored", draught="5.5"):
    vals = {"# Timestamp": ts, "Type of mobile": "Class A", "MMSI": "1", "Latitude": "55.5",
            "Longitude": "10.1", "Navigational status": status, "ROT": "0", "SOG": sog, "COG": "90",
            "Heading": "91", "IMO": imo, "Callsign": "X", "Name": "N", "Ship type": ship,
            "Cargo type": "", "Width": "20", "Length": "100", "Draught": draught}
    return ",".join(vals[h] for h in HEADER)


@pytest.fixture()
def raw_dir(tmp_path):
    d = tmp_path / "raw"
    d.mkdir()
    days = {"2025-06-01": [_line("01/06/2025 10:00:00", "9000001", "Cargo", "12.5"),
                           _line("01/06/2025 10:05:00", "9000001", "Cargo", "NA", draught="null"),
                           _line("01/06/2025 11:00:00", "Unknown", "Tanker", "3.0"),
                           _line("01/06/2025 12:00:00", "9000002", "Pleasure", "1.0")],
            "2025-06-02": [_line("02/06/2025 09:00:00", "9000002", "Tug", "bad")],
            "2025-07-01": [_line("01/07/2025 09:00:00", "9000003", "Tug", "4")]}
    for day, lines in days.items():
        with zipfile.ZipFile(d / f"aisdk-{day}.zip", "w") as z:
            z.writestr(f"aisdk-{day}.csv", "\n".join([",".join(HEADER)] + lines) + "\n")
    (d / "aisdk-2025-06-03.zip").write_bytes(b"this is not a zip archive")
    return str(d)


def test_zip_source_range_parse_and_bad_files(spark, raw_dir):
    raw = R.read_raw(spark, raw_dir, "2025-06-01", "2025-06-30")
    bad = R.bad_files(raw).collect()
    assert len(bad) == 1 and bad[0].error.startswith("corrupt_zip")
    inv = R.inventory(spark, raw_dir, "2025-06-01", "2025-06-30").collect()
    assert sorted(r.error is None for r in inv) == [False, True, True]
    p = R.parse_raw(raw).orderBy("ts").collect()
    assert len(p) == 5  # the July archive is outside the range
    assert p[0].imo == 9000001 and p[0].ts == dt.datetime(2025, 6, 1, 10, 0) and p[0].sog == 12.5
    assert p[1].sog is None and p[1].draught is None      # NA / null tokens
    assert p[2].imo is None                                # non-digit IMO
    assert p[4].sog is None                                # unparseable number
    assert p[0].event_date == dt.date(2025, 6, 1)


def test_daily_sink_skips_written_days_and_append_once(spark, raw_dir, tmp_path):
    from wakeline.operators.pings import keep_ship_types
    from wakeline.operators.weekly import weekly_features
    pings = keep_ship_types(R.parse_raw(R.read_raw(spark, raw_dir)))
    root = str(tmp_path / "daily")
    K.write_daily(pings, root)
    n1 = spark.read.parquet(root).count()
    K.write_daily(pings, root)                 # nothing new: every day is already there
    assert spark.read.parquet(root).count() == n1 == 5
    assert R.read_daily(spark, root, "2025-06-02", "2025-06-02").count() == 1
    feats = weekly_features(R.read_daily(spark, root).where(F.col("imo").isNotNull()), min_pings=1)
    out = str(tmp_path / "dataset")
    K.write_dataset(feats, out, "append")
    K.write_dataset(feats, out, "append")      # appending twice = once
    assert spark.read.parquet(out).count() == feats.count()


def test_schema_file_roundtrip(spark, tmp_path):
    df = spark.createDataFrame([(1.0, 2)], "f1 double, n long")
    spec = K.schema_spec(df, ["f1", "n"])
    K.write_schema(spark, str(tmp_path / "schema"), spec)
    assert K.load_schema(spark, str(tmp_path / "schema")) == spec == {
        "columns": ["f1", "n"], "dtypes": {"f1": "float64", "n": "int64"}}
    assert [f.name for f in K.spec_to_struct(spec).fields] == ["f1", "n"]
    with pytest.raises(FileNotFoundError):
        K.load_schema(spark, str(tmp_path / "missing"))


def _scored(spark):
    return spark.createDataFrame([(1.0, 2.0, "A", {"A": 0.75, "B": 0.25}), (3.0, 4.0, "B", {"A": 0.1, "B": 0.9})],
                                 "f1 double, f2 double, prediction string, probabilities map<string,double>")


def test_log_writes_valid_json_lines(spark, tmp_path):
    log_dir = str(tmp_path / "log")
    L.append_log(_scored(spark), log_dir, ["f1", "f2"])
    lines = [ln for f in os.listdir(log_dir) if f.endswith(".json")
             for ln in open(os.path.join(log_dir, f)).read().splitlines()]
    assert len(lines) == 2
    for ln in lines:
        e = json.loads(ln)
        assert {"timestamp", "features", "vessel_type", "probabilities"} <= set(e)


def test_log_write_failure_keeps_predictions(spark, tmp_path):
    blocker = tmp_path / "not_a_directory"
    blocker.write_text("blocking file")
    out = L.append_log(_scored(spark), str(blocker / "log"), ["f1", "f2"])
    assert out.count() == 2


def test_log_read_skips_bad_lines_and_cutoff_is_strict(spark, tmp_path):
    good = ['{"timestamp": "2026-01-01T00:00:00+00:00", "features": {"f1": 1.0}, "vessel_type": "A", '
            '"probabilities": {"A": 1.0}}',
            '{"timestamp": "2026-01-02T00:00:00+00:00", "features": {"f1": 2.0}, "vessel_type": "B", '
            '"probabilities": {"B": 1.0}}']
    (tmp_path / "log").mkdir()
    (tmp_path / "log" / "part.json").write_text("\n".join([good[0], "", "{not json", "   ", good[1]]) + "\n")
    all_rows = L.read_log(spark, str(tmp_path / "log"), ["f1"]).collect()
    assert len(all_rows) == 2
    after = L.read_log(spark, str(tmp_path / "log"), ["f1"], since=dt.datetime(2026, 1, 1)).collect()
    assert [r.vessel_type for r in after] == ["B"]
    assert L.unnest_features(L.read_log(spark, str(tmp_path / "log"), ["f1"])).columns[-1] == "f1"
    q = L.log_quality(spark.read.text(str(tmp_path / "log")), ["f1"]).first()
    assert (q.n_lines, q.n_blank, q.n_malformed, q.n_valid) == (5, 2, 1, 2)


def test_compact_and_csv_export(spark, raw_dir, tmp_path):
    from wakeline.operators.weekly import weekly_features
    pings = R.parse_raw(R.read_raw(spark, raw_dir))
    root, out = str(tmp_path / "daily"), str(tmp_path / "compact")
    K.write_daily(pings, root)
    K.compact(spark, root, out, 1)
    assert spark.read.parquet(out).count() == spark.read.parquet(root).count()
    feats = weekly_features(pings.where(F.col("imo").isNotNull()), min_pings=1)
    K.write_dataset(feats, str(tmp_path / "ds"), csv_export=str(tmp_path / "csv"))
    back = K.read_dataset(spark, str(tmp_path / "csv"), fmt="csv", schema=feats.schema)
    assert back.count() == feats.count()
    assert [(f.name, f.dataType) for f in back.schema] == [(f.name, f.dataType) for f in feats.schema]


def test_force_rewrites_only_given_days_and_numeric_columns(spark, raw_dir, tmp_path):
    from wakeline.operators.pings import numeric_columns
    pings = R.parse_raw(R.read_raw(spark, raw_dir))
    root = str(tmp_path / "daily")
    K.write_daily(pings, root)
    K.write_daily(pings.where(F.col("event_date") == F.lit("2025-06-01").cast("date")).limit(1), root, force=True)
    days = {r.event_date.isoformat(): r["count"] for r in spark.read.parquet(root).groupBy("event_date").count().collect()}
    assert days == {"2025-06-01": 1, "2025-06-02": 1, "2025-07-01": 1}
    assert numeric_columns(pings, exclude=["imo"]) == ["length", "width", "draught", "sog", "cog", "rot", "heading",
                                                       "latitude", "longitude"]


def test_a_damaged_archive_gives_no_row_and_its_day_stays_open(spark, tmp_path):
    from wakeline.plans import jobs
    raw, daily, out = (str(tmp_path / n) for n in ("raw", "daily", "out"))
    os.mkdir(raw)
    path = f"{raw}/aisdk-2025-06-02.zip"
    lines = [_line(f"02/06/2025 {h:02d}:{m:02d}:{s:02d}", "9000001", "Cargo", f"{(h * m + s) % 30}.5")
             for h in range(24) for m in range(60) for s in (5, 25, 45)]
    with zipfile.ZipFile(path, "w", zipfile.ZIP_STORED) as z:
        z.writestr("aisdk-2025-06-02.csv", "\n".join([",".join(HEADER)] + lines) + "\n")
    with zipfile.ZipFile(f"{raw}/aisdk-2025-06-01.zip", "w") as z:
        z.writestr("aisdk-2025-06-01.csv", "\n".join([",".join(HEADER), _line("01/06/2025 10:00:00", "9000001", "Cargo", "12.5")]) + "\n")
    good = open(path, "rb").read()
    at = good.rindex(b"23:59:45")
    with open(path, "wb") as f:
        f.write(good[:at] + b"23:59:46" + good[at + 8:])  # the checksum no longer holds
    bad = jobs.generate_dataset(spark, raw, daily, out, "2025-06-01", "2025-06-30")
    assert [r.error for r in bad.collect()] == ["corrupt_zip: BadZipFile"]
    assert spark.read.parquet(daily).count() == 1
    with open(path, "wb") as f:
        f.write(good)
    assert jobs.generate_dataset(spark, raw, daily, out, "2025-06-01", "2025-06-30").count() == 0
    assert spark.read.parquet(daily).count() == 1 + len(lines)


def test_last_check_is_compared_with_the_utc_end_of_training(spark, tmp_path):
    checks, runs = str(tmp_path / "checks"), str(tmp_path / "runs")
    zone = spark.conf.get("spark.sql.session.timeZone")
    assert K.last_checked(spark, checks, runs) is None
    K.save_last_checked(spark, checks, dt.datetime(2025, 1, 1, tzinfo=dt.timezone.utc))
    K.save_training_metadata(spark, runs, "2024-01-01", "2025-03-01", "r")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        t = K.last_checked(spark, checks, runs)
        us = spark.range(1).select(F.unix_micros(F.lit(t).cast("timestamp"))).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert us == int(dt.datetime(2025, 3, 1, tzinfo=dt.timezone.utc).timestamp()) * 1_000_000
