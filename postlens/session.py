"""Session helpers: settings the operators rely on, small tables, checkpoints."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# Settings that change results (zone) or plans; they can be set on a live session.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


_shipped: set[str] = set()


def configure(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to a session made elsewhere and send it the package."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="postlens-package-"), "postlens")
    sc.addPyFile(shutil.make_archive(archive, "zip", root, "postlens"))
    _shipped.add(sc.applicationId)


def local_session(cores: str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and benches; on a cluster use the session you are given."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("postlens")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
    )
    spark = configure(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's checkpoint folder; make one only for a local session.

    ``spark.checkpoint.dir`` names the shared folder. A local master may use a
    temporary folder; a cluster without the setting is an error, since a folder
    on one machine would be lost with that machine.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if sc.getCheckpointDir():
        return
    if configured:
        sc.setCheckpointDir(configured)
    elif sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="postlens-checkpoint-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder for written tables, in the shared checkpoint folder."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a frame that several results read, and return the written table.

    The table is columnar, so each result reads only its columns, and it
    outlives the executors that wrote it.
    """
    path = work_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cleanup(spark: SparkSession) -> None:
    """Delete what this application wrote to the shared folder: stored frames, checkpoints, stream state.

    Spark gives each application a folder of its own in there, so nothing of
    another one is touched. Frames that still read those files end with it.
    """
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        return
    folder = sc._jvm.org.apache.hadoop.fs.Path(sc.getCheckpointDir())
    files = folder.getFileSystem(sc._jsc.hadoopConfiguration())
    if files.exists(folder):
        for entry in files.listStatus(folder):
            files.delete(entry.getPath(), True)


def small_table(spark: SparkSession, rows: list[tuple], schema: str | T.StructType) -> DataFrame:
    """A driver-side list as a local relation.

    Its size is known exactly to the optimizer, which then broadcasts it by its
    own threshold; no hint is needed and none is given.
    """
    struct = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(struct)
    columns = [pa.array([r[i] for r in rows], type=arrow.field(i).type) for i in range(len(struct.fields))]
    return spark.createDataFrame(pa.Table.from_arrays(columns, schema=arrow), schema=struct)
