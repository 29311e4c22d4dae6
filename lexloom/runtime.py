"""Session helpers: where intermediate tables go, and how lineage is cut."""

from __future__ import annotations

import atexit
import contextlib
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def session(app: str = "lexloom", cores: int | str = "*", **conf: str) -> SparkSession:
    """A local session with the settings the engine is tuned for; a cluster supplies its own."""
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    ship(s)
    return s


def ship(spark: SparkSession) -> None:
    """Send the package to the executors, which need it for the functions that run in Python (once per application).

    Not needed where the package is installed on all machines.
    """
    sc = spark.sparkContext
    if getattr(sc, "_lexloom_shipped", False):
        return
    here = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="lexloom-ship-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    sc.addPyFile(shutil.make_archive(f"{folder}/lexloom", "zip", os.path.dirname(here), os.path.basename(here)))
    sc._lexloom_shipped = True


def shared_dir(spark: SparkSession) -> str:
    """Folder for intermediate tables that every executor can read.

    It is the one the cluster names in ``spark.checkpoint.dir``. Only a plain local session
    (``local[..]``, one machine, one process) that names none gets a folder of its own.
    """
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir", None)
    if named:
        return named
    option = sc._jsc.sc().getCheckpointDir()
    if option.isDefined():
        return option.get()
    master = sc.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    own = tempfile.mkdtemp(prefix="lexloom-")
    atexit.register(shutil.rmtree, own, ignore_errors=True)
    sc.setCheckpointDir(f"file://{own}")
    return sc._jsc.sc().getCheckpointDir().get()


def _delete(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared file system; a session that has ended leaves it."""
    try:
        sc = spark.sparkContext
        p = sc._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # the JVM is gone
        pass


@contextlib.contextmanager
def _shuffles_go(spark: SparkSession):
    """Delete the shuffle files of what runs inside as soon as it has run (where Spark can)."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    if before is None:
        yield
        return
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


class Workspace:
    """Intermediate tables of one query run, written once to the shared folder.

    A table written here survives the loss of any executor and ends the lineage, so a
    later failure re-reads files instead of recomputing the loop so far. What is left of the
    folder goes when the program ends, as results may still be read from it until then.
    """

    def __init__(self, spark: SparkSession, label: str) -> None:
        self.spark = spark
        self.root = f"{shared_dir(spark)}/lexloom-{label}-{uuid.uuid4().hex}"
        self._n = 0
        atexit.register(_delete, spark, self.root)

    def keep(self, df: DataFrame, name: str = "t") -> DataFrame:
        """Write ``df`` and return a DataFrame that reads it back."""
        self._n += 1
        path = f"{self.root}/{self._n:03d}-{name}"
        with _shuffles_go(self.spark):
            df.write.mode("overwrite").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._lexloom_path = path
        return out

    def path(self, name: str) -> str:
        """A path of this workspace for files that are no tables."""
        return f"{self.root}/{name}"

    def drop(self, *tables: DataFrame | None) -> None:
        """Delete tables of this workspace that nothing will read again."""
        for t in tables:
            path = getattr(t, "_lexloom_path", None)
            if path:
                _delete(self.spark, path)


def input_partitions(df: DataFrame) -> int:
    """Number of partitions the scan of ``df`` will have (no job is run)."""
    return max(1, df.rdd.getNumPartitions())


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def spread(df: DataFrame) -> DataFrame:
    """``df`` over all cores, for heavy work on each row.

    A scan with fewer splits than the session has cores (few or small files) is dealt out
    anew; a scan with enough splits stays as it is, so large inputs are never shuffled here.
    Select the columns that are needed before. What comes out of a shuffle stays too: its
    partitions are chosen while it runs.
    """
    if df._jdf.queryExecution().executedPlan().getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if input_partitions(df) >= cores else df.repartition(cores)
