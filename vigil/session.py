"""Session settings and shared-folder helpers.

Library code never invents a storage location on a cluster: scratch output
(checkpoints, streaming sinks) goes below the folder named by
``spark.checkpoint.dir``. Only tests and local runs set it, and only when it
is unset.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 4 << 20

# Settings a job of this library expects; all are Spark's own knobs.
RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # checkpoint files of collected DataFrames are removed from the shared folder
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "vigil") -> SparkSession:
    """Local session for tests and the bench; a cluster passes its own session."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in RECOMMENDED_CONF.items():
        builder = builder.config(k, v)
    builder = (builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "8g").config("spark.ui.showConsoleProgress", "false"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    Only a local-mode session (tests, a laptop) without the setting gets a
    temporary folder; on a cluster a machine-local folder would be wrong, so
    the setting is required there."""
    path = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder shared by the cluster (e.g. on HDFS or S3)")
        path = tempfile.mkdtemp(prefix="vigil-ckpt-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    if base.startswith("file:") and spark.sparkContext.master.startswith("local["):
        base = base[len("file:"):]  # a plain path, for tests that open it
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")


def bounded_batches(spark: SparkSession, size: int = BATCH_BYTES) -> None:
    """Arrow batches of at most about ``size`` bytes in this session. Spark's
    usual batch of 10,000 rows is 20 MB and more of texts, which the executor
    and its Python workers hold several times over and keep allocated."""
    jvm = spark.sparkContext._jvm
    if not 0 < jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(BATCH_CONF)) <= size:
        spark.conf.set(BATCH_CONF, f"{size}b")


def run_concurrently(jobs: dict, max_workers: int = 8) -> dict:
    """Run independent Spark actions from threads (Spark schedules concurrent
    jobs); returns name -> result, re-raising the first failure."""
    from concurrent.futures import ThreadPoolExecutor

    if not jobs:
        return {}
    with ThreadPoolExecutor(max_workers=min(max_workers, len(jobs))) as pool:
        futures = {name: pool.submit(fn) for name, fn in jobs.items()}
        return {name: f.result() for name, f in futures.items()}
