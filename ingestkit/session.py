"""Session helpers: a local session for tests/bench and the shared work area.

Scratch tables, stream checkpoints and message replays live under the
folder the cluster names in ``spark.checkpoint.dir``.  Without it a local
master gets a temporary folder (everything runs on one machine); on a cluster,
where executors do not share local disks, that is an error.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cpus: int | str = 8, shuffle_partitions: int | None = None,
                  app: str = "ingestkit", checkpoint_dir: str | None = None) -> SparkSession:
    """A local[N] session configured the way the tests and bench expect."""
    checkpoint_dir = checkpoint_dir or tempfile.mkdtemp(prefix="ingestkit-")
    parts = shuffle_partitions or (int(cpus) if str(cpus).isdigit() else 8)
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
        .config("spark.checkpoint.dir", checkpoint_dir)
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_root(spark: SparkSession) -> str:
    """Shared folder for scratch data: the session's checkpoint dir.

    Read from the running context first, then from ``spark.checkpoint.dir``.
    If neither is set, only a local master gets a temporary folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not conf_dir:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf_dir = tempfile.mkdtemp(prefix="ingestkit-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir().rstrip("/")


def durable_root(spark: SparkSession) -> str:
    """The configured ``spark.checkpoint.dir`` itself (the same in every
    application), for state that must survive a restart, e.g. stream
    checkpoints.  ``work_root`` is an application-specific subfolder."""
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir") or \
        spark.conf.get("spark.checkpoint.dir", None)
    return configured.rstrip("/") if configured else work_root(spark)


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new, unique folder name under the work root (nothing is created)."""
    return f"{work_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def scratch_database(spark: SparkSession, name: str = "ingestkit_work") -> str:
    """A session-catalog database whose tables live under the work root."""
    location = f"{work_root(spark)}/{name}.db"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}` LOCATION '{location}'")
    return name


def unique_table(spark: SparkSession, stem: str, database: str | None = None) -> str:
    db = database or scratch_database(spark)
    return f"{db}.{stem}_{uuid.uuid4().hex[:10]}"


class scoped_conf:
    """Set SQL confs for the duration of a ``with`` block, then restore."""

    def __init__(self, spark: SparkSession, settings: dict[str, str]):
        self.spark, self.settings, self.saved = spark, settings, {}

    def __enter__(self):
        for k, v in self.settings.items():
            self.saved[k] = self.spark.conf.get(k, None)
            self.spark.conf.set(k, str(v))
        return self

    def __exit__(self, *exc):
        for k, v in self.saved.items():
            if v is None:
                self.spark.conf.unset(k)
            else:
                self.spark.conf.set(k, v)
        return False


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a staged folder that this library wrote under the work root."""
    if not path.startswith(work_root(spark) + "/"):
        raise ValueError(f"{path} is not below the work root")
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
