"""Session helpers: sane defaults for batch ETL and checkpoint location."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # let AQE size partitions of persisted plans too
    "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_spark(master: str | None = None, app: str = "surveylake",
              shuffle_partitions: int | None = None,
              extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with AQE, skew-join handling and UTC time."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    ``spark.checkpoint.dir`` is read from the session.  Only when it is unset
    *and* the master is local (tests) is a scratch folder created; on a
    cluster an unset value is an error, because a machine-local folder does
    not survive the loss of an executor.
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not path:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        path = tempfile.mkdtemp(prefix="surveylake-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str, keep: bool = False) -> str:
    """A fresh folder under the shared checkpoint location (never a
    machine-local temp folder) for intermediate files of one run.

    Unless ``keep``, the folder is registered with the Hadoop filesystem's
    delete-on-exit list, so it is removed when the session's JVM shuts down
    (results stay readable for the whole session; repeated runs do not
    accumulate on the shared disk)."""
    import uuid
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/surveylake-scratch/{name}-{uuid.uuid4().hex[:12]}"
    if not keep:
        try:
            jvm = spark.sparkContext._jvm
            hpath = jvm.org.apache.hadoop.fs.Path(path)
            fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
            fs.mkdirs(hpath)          # deleteOnExit only registers existing paths
            fs.deleteOnExit(hpath)
        except Exception:  # noqa: BLE001 - no JVM view (e.g. Spark Connect): keep the folder
            pass
    return path


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Give the room of a ``scratch_path`` back before the session ends."""
    try:
        hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hpath, True)
    except Exception:  # noqa: BLE001 - no JVM view (e.g. Spark Connect): it goes as the others do
        pass


def is_missing_path(error: Exception) -> bool:
    """True for "there is no such path", and for nothing else."""
    from pyspark.errors import AnalysisException
    return isinstance(error, AnalysisException) and error.getCondition() == "PATH_NOT_FOUND"
