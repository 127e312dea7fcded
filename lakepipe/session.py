"""Session helpers: a local session for tests/bench and the shared scratch folder.

On a cluster the session is created by the platform; library code only reads
settings from it. ``shared_dir`` resolves a folder under the cluster-wide
``spark.checkpoint.dir`` so that written intermediate tables survive executor
loss and are visible to every node; a local default is set only when the
session has none (tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | None = None, shuffle_partitions: int | None = None,
                  app: str = "lakepipe") -> SparkSession:
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    parts = shuffle_partitions or cpus
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", os.environ.get("LAKEPIPE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="lakepipe-warehouse-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint root; set a local one only if unset, in a local session.

    On a cluster a machine-local folder would be a different one on every node, so a session
    without the setting is refused there.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError(f"spark.checkpoint.dir is not set (master {master}): "
                               "name a folder that all nodes share")
        root = tempfile.mkdtemp(prefix="lakepipe-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


def shared_dir(spark: SparkSession, *parts: str, unique: bool = True) -> str:
    """A folder under the shared checkpoint root (``<root>/lakepipe/<parts>/<uuid>``)."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    path = "/".join([root, "lakepipe", *parts])
    if unique:
        path = f"{path}/{uuid.uuid4().hex}"
    return path


#: Row groups of staged tables: small ones are dealt to several tasks when they are read again.
STAGED_ROW_GROUP = 4 << 20


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, and safe from lost executors."""
    path = shared_dir(df.sparkSession, name)
    df.write.option("parquet.block.size", STAGED_ROW_GROUP).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared file system (staging data of a finished run)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(hpath):
        fs.delete(hpath, True)


def move_path(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder of the shared file system."""
    jvm = spark.sparkContext._jvm
    src, dst = jvm.org.apache.hadoop.fs.Path(source), jvm.org.apache.hadoop.fs.Path(target)
    fs = src.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(dst.getParent())
    if not fs.rename(src, dst):
        raise OSError(f"{source} was not moved to {target}")


def rename_parts(spark: SparkSession, folder: str, extension: str) -> None:
    """Give the part files of a folder another extension (``part-….txt`` → ``part-….json``)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(folder)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for status in fs.listStatus(hpath):
        name = status.getPath().getName()
        if name.startswith("part-"):
            target = jvm.org.apache.hadoop.fs.Path(hpath, f"{name.rsplit('.', 1)[0]}.{extension}")
            if not fs.rename(status.getPath(), target):
                raise OSError(f"{status.getPath()} was not moved to {target}")


def path_has_data(spark: SparkSession, path: str) -> bool:
    """Whether a folder of the shared file system exists and holds any file."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(hpath):
        return False
    return any(not st.getPath().getName().startswith(("_", ".")) for st in fs.listStatus(hpath))
