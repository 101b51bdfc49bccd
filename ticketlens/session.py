"""Session helpers: a local session for tests, and where lineage may be cut."""

from __future__ import annotations

import atexit
import tempfile
import uuid
import warnings
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "8", app: str = "ticketlens") -> SparkSession:
    """A session for tests and benches; a cluster job brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


#: Folders that go when the application ends.
_passing: set[str] = set()


def _remove_at_end(spark: SparkSession, path: str) -> str:
    if path not in _passing:
        _passing.add(path)
        atexit.register(remove_folder, spark, path)
    return path


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Checkpoint folder of the session, Spark's own one below the one that is set; removed when the application ends.

    A local one is made only on a local master.
    """
    context = spark.sparkContext
    folder = context.getCheckpointDir()
    if folder:
        return _remove_at_end(spark, folder)
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="ticketlens-checkpoint-")
    context.setCheckpointDir(folder)
    return _remove_at_end(spark, context.getCheckpointDir())


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder in whatever file system holds it; one that is gone is no error. What stays is told in a warning."""
    try:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    except Exception as error:  # a refusal of the file system, or a session that is gone
        warnings.warn(f"{path} stays: {type(error).__name__}: {error}", stacklevel=2)


def together(*tasks: Callable[[], object], most: int = 4) -> list:
    """Results of independent steps, whose jobs run side by side; a small job leaves most of a cluster idle."""
    inherit = inheritable_thread_target(SparkSession.active())
    with ThreadPoolExecutor(max_workers=max(1, min(most, len(tasks)))) as pool:
        return [f.result() for f in [pool.submit(inherit(t)) for t in tasks]]


def materialize(df: DataFrame) -> DataFrame:
    """Write the rows once to the shared checkpoint folder; survives lost executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_folder(spark: SparkSession) -> str:
    """A fresh path below the folder that all executors share, removed when the application ends."""
    return f"{ensure_checkpoint_dir(spark)}/scratch-{uuid.uuid4().hex}"
