"""Session construction and shared-folder helpers.

The library never creates its own SparkSession inside an operator; callers
pass one in. ``build_session`` is the convenience used by tests, the bench
and the driver entry point.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on. Local wall-clock timestamps are NTZ, but the
# streaming watermark needs a zoned timestamp, so the session zone is pinned
# to UTC (the wall clock is then carried unchanged).
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    # generated methods beyond the JVM's compile limit stay interpreted, which makes plans of many
    # columns several times slower; beyond this size expressions are compiled in smaller methods
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def small_methods(spark: SparkSession) -> None:
    """Sets the limit of generated methods in a session that was built elsewhere, whose default keeps wide
    plans interpreted."""
    name = "spark.sql.codegen.hugeMethodLimit"
    spark.conf.set(name, BASE_CONF[name])


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "isobar", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting points at shared storage and is only read; where
    it is missing there, the job stops, because a folder of one machine is not
    seen by the others. In local mode (unit tests, a laptop) a fresh local
    folder is chosen.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or \
        spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not path:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all machines share")
        path = tempfile.mkdtemp(prefix="isobar-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique location under the shared checkpoint folder."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/isobar-{name}-{uuid.uuid4().hex[:12]}"


def materialize(df, name: str):
    """Cut lineage: write ``df`` once as parquet under the shared checkpoint
    folder and return a DataFrame reading it back.

    Unlike ``Dataset.checkpoint(eager=True)`` the input is computed once, and
    the stored copy is columnar, so later scans prune columns. A lost
    executor only costs a task retry of the write.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)


def _file_system(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def delete_path(spark: SparkSession, path: str) -> None:
    p, fs = _file_system(spark, path)
    fs.delete(p, True)


def list_folder(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none where there is no such folder."""
    p, fs = _file_system(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


class Scratch:
    """Intermediate tables of one job; they are deleted when the block ends.

    Only for results that have been written on or counted by then.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def table(self, df, name: str, partition_by: list[str] | None = None):
        path = scratch_path(self.spark, name)
        self.paths.append(path)
        w = df.write.mode("errorifexists")
        (w.partitionBy(*partition_by) if partition_by else w).parquet(path)
        return self.spark.read.parquet(path)

    def __enter__(self):
        return self

    def __exit__(self, *exc):
        for path in self.paths:
            delete_path(self.spark, path)


def read_parquet_if_exists(spark: SparkSession, path: str):
    """The parquet table at ``path``, or None when nothing was written there yet."""
    try:
        return spark.read.parquet(path)
    except Exception as exc:  # AnalysisException: PATH_NOT_FOUND
        if "PATH_NOT_FOUND" in str(exc) or "does not exist" in str(exc):
            return None
        raise
