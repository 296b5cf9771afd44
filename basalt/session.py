"""Session helpers: a local session for tests/bench and the shared scratch folder.

Library functions never create sessions; they take DataFrames and use
``df.sparkSession``. Only tests, ``bench.py`` and examples call ``local_session``.
"""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = 8, partitions: int = 8, app: str = "basalt") -> SparkSession:
    """A local[N] session configured the way the tests and the bench expect."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.default.parallelism", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BASALT_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.optimizer.runtime.bloomFilter.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder of the session.

    On a cluster ``spark.checkpoint.dir`` (or ``SparkContext.setCheckpointDir``) names a
    shared file system; we only read it, and raise if neither is set. On a local master
    (tests, bench) a temp folder is registered instead and removed when the process ends.
    """
    jsc = spark.sparkContext._jsc.sc()
    current = jsc.getCheckpointDir()
    if current.isDefined():
        return current.get()
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that all executors of {master} share")
        conf_dir = tempfile.mkdtemp(prefix="basalt-ckpt-")
        atexit.register(shutil.rmtree, conf_dir, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(conf_dir)
    return jsc.getCheckpointDir().get()


_scratch_roots: set[str] = set()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path for an intermediate table, in this application's scratch folder
    under the shared checkpoint folder; the scratch folder goes when the driver ends."""
    context = spark.sparkContext
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/scratch-{context.applicationId}"
    if root not in _scratch_roots:
        path = context._jvm.org.apache.hadoop.fs.Path(root)
        fs = path.getFileSystem(context._jsc.hadoopConfiguration())
        fs.mkdirs(path)
        fs.deleteOnExit(path)
        _scratch_roots.add(root)
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"
