"""Raw daily ping files: zipped CSV, one archive per day.

``aiszip`` is a Python ``DataSource``: one input partition per archive, so days
are read in parallel by the executors; each archive's CSV member is streamed
through pyarrow's CSV reader and emitted as Arrow batches (no per-row Python).
Files are listed and opened through ``pyarrow.fs``, so local paths, HDFS and
object stores work alike.  A corrupt archive yields one row with ``error`` set
instead of failing the job; :func:`bad_files` lists them.
"""

from __future__ import annotations

import datetime as dt
import re
import threading
import zipfile
import zlib

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..config import NULL_TOKENS, RAW_TIMESTAMP_FORMAT
from ..operators.drift import broadcast_if_small
from ..operators.pings import parse_timestamp
from ..session import materialize

# raw header name -> column name used by the operators (fixed values)
RAW_COLUMNS = {
    "# Timestamp": "ts_text",
    "IMO": "imo_text",
    "Ship type": "ship_type",
    "Length": "length",
    "Width": "width",
    "Draught": "draught",
    "SOG": "sog",
    "COG": "cog",
    "ROT": "rot",
    "Heading": "heading",
    "Navigational status": "nav_status",
    "Latitude": "latitude",
    "Longitude": "longitude",
    "Cargo type": "cargo_type",
}
NUMERIC = ["length", "width", "draught", "sog", "cog", "rot", "heading", "latitude", "longitude"]
DAY_FILE = re.compile(r"aisdk-(\d{4}-\d{2}-\d{2})\.zip$")

RAW_SCHEMA = ("source_file string, event_date date, error string, "
              + ", ".join(f"{c} string" for c in RAW_COLUMNS.values()))


def day_of(name: str) -> dt.date | None:
    m = DAY_FILE.search(name)
    return dt.date.fromisoformat(m.group(1)) if m else None


class _Archive(InputPartition):
    def __init__(self, path: str, day: str | None):
        super().__init__(path)
        self.path, self.day = path, day


class _Member:
    """A zip member that keeps the first fault of its bytes.  The CSV reader
    reads ahead in a thread of its own and may meet the fault there, after which
    the member just looks finished."""

    closed = False

    def __init__(self, member):
        self.member, self.lock, self.fault = member, threading.Lock(), None

    def read(self, size=-1):
        with self.lock:
            if self.fault is None:
                try:
                    return self.member.read(size)
                except (zipfile.BadZipFile, EOFError, zlib.error) as e:
                    self.fault = e
            raise self.fault

    def drain(self) -> None:
        """Read to the end, where the checksum is compared."""
        while self.read(1 << 20):
            pass


class ZipCsvReader(DataSourceReader):
    def __init__(self, options):
        self.root = options.get("path")
        self.start = options.get("start")
        self.end = options.get("end")
        self.inventory = options.get("inventory", "false").lower() == "true"

    def partitions(self):
        """One partition per archive whose file-name date is in [start, end] (A2)."""
        import pyarrow.fs as pafs
        fs, base = pafs.FileSystem.from_uri(self.root) if "://" in self.root else (pafs.LocalFileSystem(), self.root)
        infos = fs.get_file_info(pafs.FileSelector(base, recursive=False, allow_not_found=True))
        out = []
        for info in sorted(infos, key=lambda i: i.path):
            if info.type != pafs.FileType.File or not info.path.endswith(".zip"):
                continue
            day = day_of(info.base_name)
            if day is not None:
                if self.start and day < dt.date.fromisoformat(self.start):
                    continue
                if self.end and day > dt.date.fromisoformat(self.end):
                    continue
            uri = info.path if "://" not in self.root else self.root.split("://")[0] + "://" + info.path
            out.append(_Archive(uri, day.isoformat() if day else None))
        return out or [_Archive("", None)]

    def read(self, partition):
        import pyarrow as pa
        import pyarrow.csv as pacsv
        import pyarrow.fs as pafs

        if not partition.path:
            return
        names = list(RAW_COLUMNS.values())
        day = dt.date.fromisoformat(partition.day) if partition.day else None

        def batch(cols: dict, n: int, error: str | None):
            arrays = [pa.array([partition.path] * n, pa.string()), pa.array([day] * n, pa.date32()),
                      pa.array([error] * n, pa.string())]
            arrays += [cols.get(c, pa.nulls(n, pa.string())) for c in names]
            return pa.RecordBatch.from_arrays(arrays, names=["source_file", "event_date", "error"] + names)

        fs, p = pafs.FileSystem.from_uri(partition.path) if "://" in partition.path else (
            pafs.LocalFileSystem(), partition.path)
        try:
            with fs.open_input_file(p) as fh:
                try:
                    zf = zipfile.ZipFile(fh)  # random-access file, members streamed
                except pa.ArrowInvalid as e:  # shorter than a zip's closing record
                    raise zipfile.BadZipFile(str(e)) from e
                members = [m for m in zf.namelist() if m.endswith(".csv")]
                if not members:
                    yield batch({}, 1, "no_csv_member")
                    return
                if self.inventory:  # central directory only, no member is decompressed
                    yield batch({}, 1, None)
                    return
                with zf.open(members[0]) as opened:     # inflated once; its checksum is compared at the end
                    member = _Member(opened)
                    opts = pacsv.ConvertOptions(
                        null_values=NULL_TOKENS, strings_can_be_null=True, quoted_strings_can_be_null=True,
                        include_columns=list(RAW_COLUMNS), include_missing_columns=True,
                        column_types={c: pa.string() for c in RAW_COLUMNS})
                    try:
                        reader = pacsv.open_csv(member, convert_options=opts)
                        for rb in reader:
                            cols = {RAW_COLUMNS[n]: rb.column(i) for i, n in enumerate(rb.schema.names)}
                            yield batch(cols, rb.num_rows, None)
                    except pa.ArrowInvalid:
                        member.drain()                  # damaged bytes need not be CSV: if so, the checksum tells
                        raise
                    member.drain()
        except (zipfile.BadZipFile, EOFError, zlib.error) as e:
            # a damaged archive is recorded; a fault of the store or of the CSV fails the task, which Spark runs again
            yield batch({}, 1, f"corrupt_zip: {type(e).__name__}")


class ZipCsvSource(DataSource):
    """``spark.read.format("aiszip").option("start", ..).option("end", ..).load(dir)``"""

    @classmethod
    def name(cls):
        return "aiszip"

    def schema(self):
        return RAW_SCHEMA

    def reader(self, schema):
        return ZipCsvReader(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(ZipCsvSource)


def staged_raw(spark: SparkSession, path: str, start=None, end=None) -> DataFrame:
    """What the archives dated in [start, end] give, row by row as they are
    inflated; the rows of a damaged archive end with one that has an ``error``."""
    register(spark)
    r = spark.read.format("aiszip")
    if start is not None:
        r = r.option("start", str(start))
    if end is not None:
        r = r.option("end", str(end))
    return r.load(path)


def read_raw(spark: SparkSession, path: str, start=None, end=None, rejects: Observation | None = None) -> DataFrame:
    """A1/A2: raw rows (all strings) of the archives dated in [start, end].

    Each archive is inflated once: its rows are staged (written to the shared
    checkpoint folder) before its checksum is known, and come out only if it
    matched.  Of a damaged archive one row with its ``error`` comes out.
    ``rejects`` receives the counts of what cannot be parsed, in the same pass."""
    staged = staged_raw(spark, path, start, end)
    staged = (staged if rejects is None else observe_rejects(staged, rejects)).transform(materialize)
    bad = staged.where(F.col("error").isNotNull()).select("source_file").distinct()
    whole = staged.where(F.col("error").isNull()).join(broadcast_if_small(bad), "source_file", "left_anti")
    return whole.unionByName(staged.where(F.col("error").isNotNull()))


def inventory(spark: SparkSession, path: str, start=None, end=None) -> DataFrame:
    """One row per archive in range with ``error`` NULL when it opens: reads only
    each zip's central directory, so corrupt days are found without a data pass."""
    register(spark)
    r = spark.read.format("aiszip").option("inventory", "true")
    if start is not None:
        r = r.option("start", str(start))
    if end is not None:
        r = r.option("end", str(end))
    return r.load(path).select("source_file", "event_date", "error")


def bad_files(raw: DataFrame) -> DataFrame:
    """Archives that could not be read, with the reason."""
    return raw.where(F.col("error").isNotNull()).select("source_file", "event_date", "error").distinct()


def rename_raw(df: DataFrame) -> DataFrame:
    """B2: raw header names -> column names, where present."""
    return df.withColumnsRenamed(RAW_COLUMNS)


def parse_raw(raw: DataFrame, strict: bool = False) -> DataFrame:
    """B2/B3 plus typing: the four null tokens become NULL, numbers are
    ``try_cast`` (bad text -> NULL), the day-first timestamp is parsed, and the
    IMO keeps only digit strings (others -> NULL)."""
    df = raw.where(F.col("error").isNull())
    cols = [F.col("event_date")]
    for c in RAW_COLUMNS.values():
        v = F.when(F.col(c).isin(*NULL_TOKENS), F.lit(None)).otherwise(F.col(c))
        if c in NUMERIC:
            v = v.try_cast("double")
        cols.append(v.alias(c))
    typed = df.select(*cols)
    return typed.select(
        F.when(F.col("imo_text").rlike("^[0-9]+$"), F.col("imo_text").try_cast("long")).alias("imo"),
        parse_timestamp("ts_text", RAW_TIMESTAMP_FORMAT, strict=strict).cast("timestamp_ntz").alias("ts"),
        "ship_type", *NUMERIC, "nav_status", "cargo_type", "event_date")


def observe_rejects(raw: DataFrame, observation: Observation) -> DataFrame:
    """Count, while the rows pass, what ``parse_raw`` makes NULL of, by reason.

    No further scan: the counts are there after the first action on what comes
    of the result (``reject_counts``).  A null token is a missing value, not a
    reject; a damaged archive counts under ``archive``."""
    def given(c: str):
        return F.col("error").isNull() & F.col(c).isNotNull() & ~F.col(c).isin(*NULL_TOKENS)

    reasons = {"archive": F.col("error").isNotNull(),
               "timestamp": given("ts_text") & parse_timestamp("ts_text", RAW_TIMESTAMP_FORMAT, strict=False).isNull(),
               "imo": given("imo_text") & ~F.coalesce(F.col("imo_text").rlike("^[0-9]+$") & F.col("imo_text").try_cast("long").isNotNull(), F.lit(False))}
    reasons |= {c: given(c) & F.col(c).try_cast("double").isNull() for c in NUMERIC}
    return raw.observe(observation, F.count(F.lit(1)).alias("rows"), *[F.count_if(cond).alias(k) for k, cond in reasons.items()])


def reject_counts(spark: SparkSession, observation: Observation) -> DataFrame:
    """(reason, n) of an observation whose rows have passed; ``rows`` is all that were read."""
    counts = observation.get
    return spark.createDataFrame(sorted(counts.items()), "reason string, n long")


def read_daily(spark: SparkSession, root: str, start=None, end=None) -> DataFrame:
    """The per-day ping table for all vessels; the date range is a
    partition filter on ``event_date`` (pruned at planning time)."""
    df = spark.read.parquet(root)
    if start is not None:
        df = df.where(F.col("event_date") >= F.lit(str(start)).cast("date"))
    if end is not None:
        df = df.where(F.col("event_date") <= F.lit(str(end)).cast("date"))
    return df


def vessel_ids(pings: DataFrame, start=None, end=None, date_col: str = "event_date",
               key: str = "imo") -> DataFrame:
    """Distinct vessels with rows dated in [start, end] and a digit-only id."""
    df = pings
    as_date = lambda d: d if hasattr(d, "_jc") else F.lit(str(d)).cast("date")
    if start is not None:
        df = df.where(F.col(date_col) >= as_date(start))
    if end is not None:
        df = df.where(F.col(date_col) <= as_date(end))
    return df.where(F.col(key).cast("string").rlike("^[0-9]+$")).select(key).distinct()
