"""End to end: archives -> daily table -> weekly dataset -> training run -> log -> monitor."""

import datetime as dt
import zipfile

import pytest
from pyspark.sql import functions as F

from wakeline.operators import model as M
from wakeline.plans import jobs as J
from wakeline.sources import logs as L

HEADER = "# Timestamp,IMO,Ship type,Length,Width,Draught,SOG,COG,ROT,Heading,Navigational status,Latitude,Longitude,Cargo type"
FEATURES = ["length", "width", "max_draught", "mean_moving_speed", "sog_median", "n_pings", "lat_mean"]


def _write_days(d, days=14, vessels=12):
    types = ["Cargo", "Tanker", "Fishing", "Tug", "Passenger", "Pleasure"]
    for k in range(days):
        day = dt.date(2025, 6, 2) + dt.timedelta(days=k)
        lines = [HEADER]
        for v in range(vessels):
            for m in range(0, 24 * 60, 90):  # 16 pings per vessel-day
                ts = dt.datetime.combine(day, dt.time()) + dt.timedelta(minutes=m + v)
                sog = (v % 5) * 3.0 + (m % 7) / 10
                lines.append(",".join([ts.strftime("%d/%m/%Y %H:%M:%S"), str(9100000 + v), types[v % 6],
                                       str(80 + 10 * (v % 5)), str(15 + v % 5), "6.5" if v % 4 else "NA",
                                       f"{sog:.1f}", str((m * 7) % 360), "0", str((m * 7 + 5) % 360),
                                       "Under way using engine" if v % 3 else "Moored",
                                       f"{55 + v / 10 + m / 10000:.4f}", f"{10 + v / 20:.4f}", "Category X"]))
        with zipfile.ZipFile(d / f"aisdk-{day.isoformat()}.zip", "w") as z:
            z.writestr(f"aisdk-{day.isoformat()}.csv", "\n".join(lines) + "\n")


def test_generate_train_monitor(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    _write_days(raw)
    (raw / "aisdk-2025-06-20.zip").write_bytes(b"corrupt")
    ds = str(tmp_path / "dataset")
    bad = J.generate_dataset(spark, str(raw), str(tmp_path / "daily"), ds, "2025-06-02", "2025-06-20",
                             min_pings=20)
    assert bad.count() == 1
    data = spark.read.parquet(ds)
    assert data.count() == 10 * 2  # 10 vessels of the five kept types x 2 weeks
    again = J.generate_dataset(spark, str(raw), str(tmp_path / "daily"), ds, "2025-06-02", "2025-06-20",
                               mode="append", min_pings=20)
    assert again.count() == 1 and spark.read.parquet(ds).count() == 20  # append is idempotent

    runs = str(tmp_path / "runs")
    run_id, report = J.train(spark, ds, "2025-06-01", "2025-06-30", runs, features=FEATURES,
                             num_trees=5, max_depth=5, min_leaf=1)
    assert J.current_run(spark, runs) == run_id
    assert report.where(F.col("class") == "accuracy").count() == 1
    model = M.load_model(f"{runs}/runs/{run_id}", FEATURES)

    log_dir = str(tmp_path / "log")
    scored = M.predict_proba(model, data, FEATURES)
    L.append_log(scored, log_dir, FEATURES)
    state = str(tmp_path / "state")
    with pytest.raises(ValueError, match="other features"):
        J.monitor(spark, log_dir, runs, state, features=FEATURES[::-1])
    drifted, flagged = J.monitor(spark, log_dir, runs, state, period="2025-07-01")
    assert flagged is not None and isinstance(drifted, bool)
    # nothing new since the last check -> nothing to do
    drifted2, flagged2 = J.monitor(spark, log_dir, runs, state)
    assert drifted2 is False and flagged2 is None


def test_drift_stream_checks_new_log_files(spark, tmp_path):
    from wakeline.operators import drift as D
    from wakeline.streaming.jobs import run_drift_stream
    base = spark.createDataFrame([(float(v),) for v in range(100)], "x double")
    bins, _ = D.build_baselines(base, ["x"])
    log_dir = tmp_path / "log"
    log_dir.mkdir()
    line = '{{"timestamp": "2026-01-0{d}T00:00:00+00:00", "features": {{"x": {x}}}, "vessel_type": "A"}}'
    (log_dir / "a.json").write_text("\n".join(line.format(d=1, x=v) for v in range(100)) + "\n")
    alarms = str(tmp_path / "alarms")
    q = run_drift_stream(spark, str(log_dir), bins, ["x"], alarms, str(tmp_path / "ckpt"))
    q.awaitTermination()
    first = spark.read.parquet(alarms).collect()
    assert len(first) == 1 and first[0].alarm is None and first[0].psi < 1e-9   # same distribution
    (log_dir / "b.json").write_text("\n".join(line.format(d=2, x=500 + v) for v in range(50)) + "\n")
    q = run_drift_stream(spark, str(log_dir), bins, ["x"], alarms, str(tmp_path / "ckpt"))
    q.awaitTermination()
    got = spark.read.parquet(alarms).where("batch_id = 1").collect()   # only the new file was read
    assert len(got) == 1 and got[0].feature == "x" and got[0].psi > 0.25 and got[0].alarm is not None


def test_training_rows_keep_both_ends_and_refuse_an_empty_range(spark):
    weeks = spark.sql("SELECT DATE'2025-06-02' + CAST(7 * id AS INT) AS week_start, id FROM range(5)")
    kept = J.training_rows(weeks, dt.date(2025, 6, 9), "2025-06-23")
    assert sorted(r["id"] for r in kept.collect()) == [1, 2, 3]
    with pytest.raises(ValueError, match="no row between"):
        J.training_rows(weeks, "2026-01-01", "2026-02-01")
