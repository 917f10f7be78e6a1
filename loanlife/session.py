"""Session helpers: configuration used by tests / bench, and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings that matter for the plans this library produces.  On a cluster these
# come from spark-defaults; `local_session` applies them for tests and bench.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # HotSpot never compiles a method beyond 8,000 bytes of bytecode: a stage fused into a larger one would be interpreted.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "loanlife", extra: dict | None = None) -> SparkSession:
    builder = (SparkSession.builder.master(f"local[{cpus}]").appName(app)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions)))
    for k, v in {"spark.driver.memory": "8g", **RECOMMENDED_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def compiled_methods(spark: SparkSession) -> None:
    """Generated methods that HotSpot would interpret are not used, unless the session says otherwise itself."""
    name = "spark.sql.codegen.hugeMethodLimit"
    if spark.conf.get(name) == "65535":
        spark.conf.set(name, RECOMMENDED_CONF[name])


@contextmanager
def freed_shuffles(spark: SparkSession):
    """Within it, a write's shuffle files go when the write has ended, not when the driver collects its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the folder is configured (a shared file system); it is read
    from the session and never replaced.  Only when it is unset in local mode
    (tests) is a private folder created and registered; on a cluster an unset
    folder is an error, since a machine-local folder is not visible to executors.
    """
    sc = spark.sparkContext
    configured = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set: point it at a shared folder "
                           "(HDFS / object store) visible to every executor")
    local = tempfile.mkdtemp(prefix="loanlife-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex}")
