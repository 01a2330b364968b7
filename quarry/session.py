"""Session helpers: building a session, the shared checkpoint folder, size-checked broadcast.

Everything here is plain public PySpark. The cluster owns ``spark.checkpoint.dir``; we only
fill it in when it is unset *and* the master is local (tests, laptops). On a cluster without
it we refuse to invent a machine-local folder.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Session settings that matter at scale: AQE re-plans joins and partition counts at runtime,
# splits skewed join partitions and coalesces tiny shuffles. All timestamps are UTC.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, app: str = "quarry", shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    Set one under the system temp folder only when it is unset and the master is local.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not _is_local(spark):
            raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder (hdfs://, s3a://, ...)")
        configured = tempfile.mkdtemp(prefix="quarry-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path inside the shared checkpoint folder (for written intermediate tables)."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder: survives executor loss, truncates the plan."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def cut_lineage_by(df: DataFrame, partitions: int, *keys: str) -> DataFrame:
    """A reliable checkpoint of ``df`` dealt by ``keys`` that Spark still knows to be dealt so: joins, groupings and
    cogroups on the keys do not shuffle it again. (An adaptive plan does not pass its partitioning on to a
    checkpoint, so this one plan is not adaptive; the session's setting is put back.)"""
    spark = df.sparkSession
    key, before = "spark.sql.adaptive.enabled", spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set(key, "false")
    try:
        return cut_lineage(df.repartition(partitions, *keys))
    finally:
        spark.conf.set(key, before)


_SHIPPED: set[str] = set()
_ZIP: list[str] = []


def ship_package(spark: SparkSession) -> None:
    """Make this package importable by Python workers, once per context. Needed only by operators that
    run Python on executors (cogroup / mapInPandas kernels). On a cluster the package is deployed with the
    job (``spark-submit --py-files quarry.zip`` or an installed wheel), so only local masters ship it here."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED or not _is_local(spark):
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    if not _ZIP:
        import zipfile
        path = os.path.join(tempfile.mkdtemp(prefix="quarry-pkg-"), "quarry.zip")
        with zipfile.ZipFile(path, "w") as zf:
            for root, _, names in os.walk(pkg):
                for n in names:
                    if n.endswith(".py"):
                        full = os.path.join(root, n)
                        zf.write(full, os.path.relpath(full, os.path.dirname(pkg)))
        _ZIP.append(path)
    sc.addPyFile(_ZIP[0])
    _SHIPPED.add(sc.applicationId)


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin repartition *only* when a scan yields fewer partitions than the cluster can run at once
    (e.g. one large row group); CPU-heavy per-row work (text cleaning) then uses every core. A wide scan
    (the normal case at scale) is returned unchanged, so no shuffle is added there."""
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(target) if df.rdd.getNumPartitions() < target else df


def right_size(df: DataFrame, n_rows: int, rows_per_partition: int = 5_000) -> DataFrame:
    """Coalesce (no shuffle) a small training set to about one partition per ``rows_per_partition`` rows
    before an iterative fit: every optimiser iteration is a job over all partitions, so tiny partitions
    cost scheduling time per iteration. Large inputs keep their partitioning."""
    import math

    target = max(1, math.ceil(n_rows / rows_per_partition))
    return df.coalesce(target) if df.rdd.getNumPartitions() > target else df


def stored(df: DataFrame, name: str = "small") -> DataFrame:
    """``df`` written to the shared folder and read back. Spark then knows its size in bytes, and itself broadcasts
    it to a join when that is under ``spark.sql.autoBroadcastJoinThreshold``, or shuffles both sides when it is not."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
