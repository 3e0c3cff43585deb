"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


#: Settings that help every query here and can be changed while a session runs.
#: The wide feature projections compile to methods above 8,000 bytecodes, which the JVM refuses to
#: compile to machine code; with the limit Spark generates them in smaller pieces (3x faster).
RUNTIME_SETTINGS = {"spark.sql.codegen.hugeMethodLimit": "8000"}


def tuned(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session and return it."""
    for name, value in RUNTIME_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def local_session(cores: int | str = "*", name: str = "riskweave", memory: str = "12g") -> SparkSession:
    """Session for tests and benchmarks on one machine; a cluster brings its own."""
    return tuned(
        SparkSession.builder.master(f"local[{cores}]").appName(name)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        # recording the call site of every column expression more than doubles plan building
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


_folders: dict[str, str] = {}  # by application


def on_storage(spark: SparkSession, path: str):
    """The path and its file system, as Hadoop objects."""
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def scratch_root(spark: SparkSession) -> str:
    """This application's folder for intermediate tables, below ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder of this machine. The folder is
    deleted when the application ends in good order.
    """
    application = spark.sparkContext.applicationId
    if application not in _folders:
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root and not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        shared = bool(root)
        root = root.rstrip("/") if shared else f"file:{tempfile.mkdtemp(prefix='riskweave-')}"
        folder = f"{root}/riskweave-{application}"
        path, system = on_storage(spark, folder)
        system.mkdirs(path)
        system.deleteOnExit(path if shared else path.getParent())
        _folders[application] = folder
    return _folders[application]


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def discard(spark: SparkSession, path: str) -> None:
    """Delete an intermediate table that nothing reads any more."""
    found, system = on_storage(spark, path)
    system.delete(found, True)


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write the frame once to the shared folder and read it back as a columnar table.

    For jobs that scan the same rows several times: later scans read only the columns they need,
    and a lost executor costs a re-read, not a recomputation of the joins behind the frame.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
