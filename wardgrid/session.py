"""Session factory and cluster settings shared by tests, bench and entry points."""

from __future__ import annotations

import atexit
import io
import os
import shutil
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession


def get_spark(app: str = "wardgrid", cpus: int | None = None, **conf: str) -> SparkSession:
    """A local session for tests and benches; on a cluster the active session is used."""
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder of spark.checkpoint.dir. Only a session whose executors run on this machine may
    do without: it gets a folder of its own."""
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="wardgrid-checkpoint-")
        atexit.register(shutil.rmtree, shared, ignore_errors=True)
    sc.setCheckpointDir(shared)


def cut(df: DataFrame) -> DataFrame:
    """Materialise df in the shared checkpoint folder and forget its lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """df written once as a table in the shared checkpoint folder and read from there: compressed, read by
    column, and of a size that the planner knows."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/wardgrid-{uuid.uuid4().hex}"
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._wardgrid_path = path
    return table


def discard(table: DataFrame) -> None:
    """Deletes what `stored` wrote, once nothing reads it any more."""
    spark = table.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(table._wardgrid_path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def ship_package(spark: SparkSession) -> None:
    """Gives this package to the executors' Python, once a session: as a zip in the shared checkpoint
    folder, so that queries run wherever the driver was started."""
    sc = spark.sparkContext
    if getattr(sc, "_wardgrid_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, files in os.walk(root):
            for name in sorted(files):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(root)))
    ensure_checkpoint_dir(spark)
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(sc.getCheckpointDir(), f"wardgrid-{uuid.uuid4().hex}.zip")
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True)
    try:
        out.write(bytearray(packed.getvalue()))
    finally:
        out.close()
    sc.addPyFile(target.toString())
    sc._wardgrid_shipped = True
