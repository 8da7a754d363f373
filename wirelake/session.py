"""Session construction and the shared working folder.

Everything that must survive an executor loss (streaming checkpoints, staged
capture frames, lineage cuts) is written below the folder the cluster names
in ``spark.checkpoint.dir``. Only when that setting is absent (a laptop or a
test run in local mode) is a private temporary folder created and installed.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Defaults for a local run; cluster deployments override them in their own conf.
LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.driver.memory": "12g",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Fall back to per-operator code generation when a fused stage would
    # exceed the JIT's 8000-byte method limit (header decoding does): an
    # un-JITted giant method runs interpreted and several times slower.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def get_session(master: str | None = None, app: str = "wirelake", **conf: str) -> SparkSession:
    """Build (or reuse) a session. ``master`` defaults to ``local[$BENCH_CPUS or 8]``."""
    if master is None:
        master = f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    builder = SparkSession.builder.master(master).appName(app)
    merged = dict(LOCAL_CONF)
    merged.setdefault("spark.sql.shuffle.partitions", "8")
    merged.update({k.replace("__", "."): v for k, v in conf.items()})
    for key, value in merged.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"  # shuffle files go when their job ends


@contextmanager
def setting(spark: SparkSession, name: str, value: str):
    """``name`` set to ``value`` for the jobs that run inside."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def small_methods(spark: SparkSession):
    """``spark.sql.codegen.hugeMethodLimit`` as in ``LOCAL_CONF`` for the jobs that run inside, in any session."""
    name = "spark.sql.codegen.hugeMethodLimit"
    return setting(spark, name, LOCAL_CONF[name])


def drop_dir(spark: SparkSession, path: str) -> None:
    """Delete a folder that nothing reads any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def _configured_dir(spark: SparkSession) -> str | None:
    value = spark.conf.get("spark.checkpoint.dir", None)
    if value:
        return value
    jdir = spark.sparkContext._jsc.sc().getCheckpointDir()
    return jdir.get() if jdir.isDefined() else None


def reliable_checkpoint(df):
    """``df.checkpoint()`` into the shared folder (installed first when only the conf names it)."""
    sc = df.sparkSession.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(shared_dir(df.sparkSession, "rdd-checkpoints"))
    return df.checkpoint(eager=True)


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder for ``purpose`` below the cluster's shared checkpoint folder.

    Raises on a non-local master without ``spark.checkpoint.dir``: a folder on
    the driver's own disk would not be visible to executors.
    """
    base = _configured_dir(spark)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="wirelake-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/wirelake/{purpose}-{uuid.uuid4().hex[:12]}"
