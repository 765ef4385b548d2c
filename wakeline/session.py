"""SparkSession helpers.

The cluster owns ``spark.checkpoint.dir`` (a shared, fault-tolerant folder);
we only set one ourselves when it is unset, as in local tests.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "wakeline", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def tune_for_input(spark: SparkSession, input_bytes: int, target_partition_bytes: int = 256 << 20,
                   cores: int | None = None) -> int:
    """Size shuffles for an input of ``input_bytes`` (compressed Parquet).

    Sets the shuffle partition count so a partition holds about
    ``target_partition_bytes`` before AQE coalescing (at least 2x the cores),
    the scan split size, the AQE advisory size and the skew-join thresholds.
    Returns the partition count.  Example: 100 TB -> ~400k partitions of 256 MB.
    """
    cores = cores or spark.sparkContext.defaultParallelism
    n = max(2 * cores, -(-int(input_bytes) // target_partition_bytes))
    for k, v in {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    }.items():
        spark.conf.set(k, v)
    return n


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The checkpoint folder the cluster names, if any."""
    d = spark.sparkContext.getCheckpointDir()
    if d:
        return d
    return spark.conf.get("spark.checkpoint.dir", None)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the session's checkpoint folder; create a scratch one only when unset (tests)."""
    d = checkpoint_dir(spark)
    if d is None:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        d = tempfile.mkdtemp(prefix="wakeline-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A folder under the shared checkpoint dir for intermediate tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


def default_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def env_master() -> str:
    return f"local[{os.environ.get('BENCH_CPUS', '8')}]"


#: Shuffle files go when the job that wrote them has ended, not at the driver's next full collection.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df, name: str = "tmp", keep_shuffles: bool = True):
    """Cut lineage: write ``df`` as Parquet under the shared checkpoint folder
    and read it back.

    One job (an eager ``checkpoint()`` runs its plan twice unless persisted),
    the files survive executor loss, and the optimizer gets real size
    statistics for the reread table (join and broadcast decisions).
    ``keep_shuffles=False`` frees the disk of the shuffles behind it at once.
    """
    import uuid
    spark = df.sparkSession
    path = scratch_path(spark, f"mat/{name}-{uuid.uuid4().hex[:12]}")
    before = spark.conf.get(DROP_SHUFFLES, None)
    if not keep_shuffles:
        spark.conf.set(DROP_SHUFFLES, "true")
    try:
        df.write.mode("overwrite").parquet(path)
    finally:
        if not keep_shuffles:
            spark.conf.unset(DROP_SHUFFLES) if before is None else spark.conf.set(DROP_SHUFFLES, before)
    return spark.read.parquet(path)


def ship_package(spark) -> str:
    """Make ``wakeline`` importable on executors (Pandas UDFs, the zip data
    source): zip the package and hand it to ``addPyFile`` - the programmatic
    form of ``--py-files``; Spark serves the file to every executor."""
    import pathlib
    import zipfile
    pkg = pathlib.Path(__file__).resolve().parent
    local = pathlib.Path(tempfile.mkdtemp(prefix="wakeline-zip-")) / "wakeline.zip"
    with zipfile.ZipFile(local, "w", zipfile.ZIP_DEFLATED) as z:
        for f in pkg.rglob("*.py"):
            z.write(f, f.relative_to(pkg.parent))
    spark.sparkContext.addPyFile(str(local))
    return str(local)
