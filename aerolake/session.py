"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import atexit
import io
import os
import shutil
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_SCRATCH: dict[str, str] = {}
_FOLDERS: dict[str, str] = {}
_SHIPPED: set[str] = set()


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session with the settings the library assumes (UTC, AQE, Arrow)."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("aerolake")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session.

    Only where neither the setting nor a checkpoint folder is set and the master is local (as in tests) a local temporary
    folder is used; on a cluster that is an error, since each machine would write into a folder of its own.
    """
    set_dir = spark.conf.get("spark.checkpoint.dir", None)
    if set_dir:
        return set_dir.rstrip("/")
    jsc_dir = spark.sparkContext._jsc.sc().getCheckpointDir()
    if jsc_dir.isDefined():
        return str(jsc_dir.get()).rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _SCRATCH:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        _SCRATCH[app] = tempfile.mkdtemp(prefix="aerolake-")
        atexit.register(shutil.rmtree, _SCRATCH[app], ignore_errors=True)
        spark.sparkContext.setCheckpointDir("file://" + _SCRATCH[app])
    return "file://" + _SCRATCH[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; what is written there is deleted when the application ends."""
    app = spark.sparkContext.applicationId
    if app not in _FOLDERS:
        _FOLDERS[app] = f"{shared_dir(spark)}/aerolake/{app}-{uuid.uuid4().hex}"
        fs, folder = filesystem(spark, _FOLDERS[app])
        fs.mkdirs(folder)
        fs.deleteOnExit(folder)
    return f"{_FOLDERS[app]}/{name}-{uuid.uuid4().hex}"


def discard(spark: SparkSession, *paths: str) -> None:
    """Delete scratch tables that nothing reads any more."""
    for p in paths:
        fs, hpath = filesystem(spark, p)
        fs.delete(hpath, True)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write ``df`` as a parquet table into the shared folder and read it back.

    The table survives the loss of an executor, unlike a local checkpoint, and later stages read only the columns they need.
    """
    return write_scratch(df, name)[0]


def write_scratch(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """As :func:`materialize`, with the path, for callers that :func:`discard` it when they are done."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def ship_package(spark: SparkSession) -> None:
    """Give executors this package: a zip of its sources in the shared folder, added to their path once per application.

    So functions that run in Python workers can be imported there wherever the driver was started.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, files in os.walk(root):
            for f in sorted(files):
                if f.endswith(".py"):
                    path = os.path.join(folder, f)
                    z.write(path, os.path.relpath(path, os.path.dirname(root)))
    target = f"{shared_dir(spark)}/aerolake-code/{uuid.uuid4().hex}/aerolake.zip"
    fs, path = filesystem(spark, target)
    out = fs.create(path)
    out.write(data.getvalue())
    out.close()
    sc.addPyFile(target)
    _SHIPPED.add(sc.applicationId)


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """One of the driver's tables. Times are UTC: zone-less timestamps are taken so, and the session's zone is set to it."""
    ship_package(spark)
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    df = spark.read.parquet(os.path.join(directory, f"{name}.parquet"))
    naive = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampNTZType)]
    return df.withColumns({c: df[c].cast("timestamp") for c in naive}) if naive else df


def filesystem(spark: SparkSession, path: str):
    """The Hadoop file system and path object of ``path``."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath
