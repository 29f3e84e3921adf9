"""Session setup shared by jobs, tests and the bench.

On a cluster the session already exists and carries the cluster's settings;
``configure`` then only fills in what nobody has set. Locally (tests, bench)
``get_session`` builds a ``local[N]`` session with the settings the jobs assume.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the jobs rely on. Time zone pinned so hour/date extraction is
# reproducible; AQE re-plans joins from runtime sizes (a size-checked
# broadcast) and splits skewed shuffle partitions.
JOB_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
}

LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.driver.memory": "8g",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "olapkit") -> SparkSession:
    """Return the active session, or build a local one for tests and bench."""
    active = SparkSession.getActiveSession()
    if active is not None:
        spark = active
    else:
        builder = SparkSession.builder.appName(app_name)
        if master is None:
            master = os.environ.get("OLAPKIT_MASTER", "local[8]")
        builder = builder.master(master)
        for k, v in {**LOCAL_CONF, **JOB_CONF}.items():
            builder = builder.config(k, v)
        if shuffle_partitions is not None:
            builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        spark = builder.getOrCreate()
        spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> None:
    """Fill in the job settings that neither the cluster nor the user has set (runtime SQL confs only)."""
    have = spark.conf.getAll
    for k, v in JOB_CONF.items():
        if k not in have:
            spark.conf.set(k, v)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables: the one named by ``spark.checkpoint.dir``.

    Where it is unset, a local session gets a fresh scratch folder; a cluster
    is refused, since a folder of the driver's machine is not the executors'.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="olapkit-ckpt-", dir=os.environ.get("OLAPKIT_SCRATCH", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", d)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A unique path under the shared folder for a written table. The application's tables are removed when its
    session ends."""
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/olapkit-{spark.sparkContext.applicationId}"
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.mkdirs(path):
        fs.deleteOnExit(path)
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"
