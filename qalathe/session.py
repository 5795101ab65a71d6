"""Session helpers: a local session for tests and the shared folder for work tables."""

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cpus: str = "8", app: str = "qalathe") -> SparkSession:
    """A single-machine session; a cluster brings its own session and settings."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        # Call sites of every column expression are looked up otherwise, which on small tables
        # takes longer than the work itself.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the session names it in ``spark.checkpoint.dir``.

    Where nothing is set, a temporary folder takes its place on a local master, until the process
    ends. Anywhere else that is an error: executors would each write to a disk of their own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    made = spark.sparkContext.getCheckpointDir()
    if made is None:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="qalathe-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(folder)
        made = spark.sparkContext.getCheckpointDir()
    return made


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing has written to yet."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
