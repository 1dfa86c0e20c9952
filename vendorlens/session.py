"""Session helpers: building a session for tests/bench and locating the
shared folder used to cut lineage (``spark.checkpoint.dir``)."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job in this library relies on. AQE re-plans joins at run
# time (broadcast conversion when a side turns out small, skew splitting,
# partition coalescing), so shuffle partition counts can be sized for the
# largest stage without hurting the small ones.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(
    master: str | None = None,
    app: str = "vendorlens",
    shuffle_partitions: int | None = None,
    driver_memory: str | None = None,
    extra: dict | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the library's defaults. The number of
    shuffle partitions and the driver's memory are the site's unless given."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if driver_memory is not None:
        conf["spark.driver.memory"] = driver_memory
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
    """Return the shared checkpoint folder of the session.

    The cluster names it in ``spark.checkpoint.dir``. Only a local-mode
    session without one (tests) gets a fresh folder of its own; on a cluster
    a machine-local folder would not survive the loss of an executor, so a
    missing setting is an error there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not _is_local(spark):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a shared folder"
            )
        configured = tempfile.mkdtemp(prefix="vendorlens-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A fresh path under the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    leaf = "/".join(parts) if parts else "t"
    return f"{base}/vendorlens/{uuid.uuid4().hex}/{leaf}"


