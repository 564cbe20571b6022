"""Spark session and shared-storage helpers."""

from __future__ import annotations

import contextlib
import contextvars
import os
import re
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on. The time zone is part of the data contract
# (dates are derived from UTC timestamps); AQE coalesces small shuffles and
# splits skewed join partitions at run time.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app: str = "thermolytics",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Return the active session or build one with DEFAULT_CONF.

    ``master`` is only applied when a new session is created; on a cluster
    the launcher supplies it.
    """
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
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and staged tables.

    Uses ``spark.checkpoint.dir`` as configured for the cluster. Where it is unset, a
    ``local`` master falls back to the system temp folder (tests); on any other master
    this raises, because each executor would write to its own disk.
    The caller's session settings are not changed.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) \
        or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if root:
        return root
    master = spark.sparkContext.master
    if not re.fullmatch(r"local(\[.*\])?", master):
        raise RuntimeError(f"spark.checkpoint.dir must name a shared folder when the master is {master!r}")
    return os.path.join(os.environ.get("TMPDIR", "/tmp"), "thermolytics-checkpoints")


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint root for a staged table."""
    path = f"{checkpoint_root(spark).rstrip('/')}/stage-{name}-{uuid.uuid4().hex[:12]}"
    own = _OWN.get()
    if own is not None:
        own.append(path)
    return path


_OWN: contextvars.ContextVar = contextvars.ContextVar("own_stages", default=None)


@contextlib.contextmanager
def scratch(spark: SparkSession):
    """Deletes the staged tables made inside the block when it ends. For jobs that have written their
    results elsewhere by then; a frame that still reads them must not leave the block."""
    mark = _OWN.set([])
    try:
        yield
    finally:
        paths = _OWN.get()
        _OWN.reset(mark)
        for path in paths:
            _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def materialize(df, name: str, count: bool = False):
    """Write ``df`` once as Parquet under the shared checkpoint folder and read it back.

    Cuts the lineage like ``checkpoint()`` but in one job (a reliable RDD
    checkpoint computes its input twice unless cached) and in a columnar
    format. With ``count=True`` the row count is taken from an observation
    on the same write and returned as ``(df, n)``. File sizes follow the
    writing partitions, which adaptive execution sizes by bytes. A write that fails leaves no folder.
    """
    from pyspark.sql import Observation
    from pyspark.sql import functions as F

    spark = df.sparkSession
    path = staging_path(spark, name)
    if count:
        obs = Observation(f"rows-{name}")
        df = df.observe(obs, F.count(F.lit(1)).alias("n"))
    try:
        df.write.mode("overwrite").parquet(path)
    except Exception:
        _delete(spark, path)
        raise
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_path = path
    return (out, int(obs.get["n"])) if count else out


def release(*frames) -> None:
    """Delete the staged tables that ``frames`` (returned by ``materialize``) read.

    For intermediate results whose every use has already been written elsewhere. Of a frame that is derived from
    one (a renamed column), the folders are found by its files. Only ``stage-*`` folders are touched.
    """
    for df in frames:
        path = df.__dict__.get("staged_path")
        for folder in [path] if path else {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            if folder.rsplit("/", 1)[-1].startswith("stage-"):
                _delete(df.sparkSession, folder)


def cleanup_staging(spark: SparkSession, older_than_hours: float = 24.0, root: str | None = None) -> int:
    """Delete staged tables (``stage-*`` folders) older than ``older_than_hours`` under
    the shared checkpoint folder (or ``root``). Staged tables back lazily evaluated
    results, so they are released by age, not when the creating call returns.
    Uses the Hadoop FileSystem API, so it works on any shared store Spark can write to.
    Returns the number of folders removed.
    """
    import time as _time

    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    base = jvm.org.apache.hadoop.fs.Path(root or checkpoint_root(spark))
    fs = base.getFileSystem(conf)
    if not fs.exists(base):
        return 0
    cutoff_ms = (_time.time() - older_than_hours * 3600) * 1000
    removed = 0
    for st in fs.listStatus(base):
        p = st.getPath()
        if st.isDirectory() and p.getName().startswith("stage-") and st.getModificationTime() < cutoff_ms:
            fs.delete(p, True)
            removed += 1
    return removed
