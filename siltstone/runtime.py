"""Session helpers: where intermediate tables go, and how they get there."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_folders: dict[str, str] = {}


def _at(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    """The file system of a path, and the path."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _at(spark, path)
    return fs.exists(p)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and directories in a directory."""
    fs, p = _at(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)]


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _at(spark, path)
    fs.delete(p, True)


def move(spark: SparkSession, path: str, to: str) -> None:
    """Renames a directory; an error if there is one of that name."""
    fs, p = _at(spark, path)
    q = _at(spark, to)[1]
    fs.mkdirs(q.getParent())
    if fs.exists(q) or not fs.rename(p, q):
        raise OSError(f"{path} can't become {to}")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the session names it.

    Only where the session names none and runs on this machine alone (tests, a
    laptop) is a folder of our own made and remembered in the session. On a cluster
    without the setting it is an error: a folder of one machine would hold a part of
    each table.
    """
    at = spark.conf.get(_SETTING, None)
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"{_SETTING} must name a folder that all executors share")
        path = tempfile.mkdtemp(prefix="siltstone-")
        atexit.register(shutil.rmtree, path, True)
        at = "file://" + path
        spark.conf.set(_SETTING, at)
    return at.rstrip("/")


def _tables(spark: SparkSession) -> str:
    """This application's folder of intermediate tables, which goes when it ends."""
    app = spark.sparkContext.applicationId
    if app not in _folders:
        _folders[app] = f"{shared_dir(spark)}/tables/{app}"
        fs, p = _at(spark, _folders[app])
        fs.mkdirs(p)
        fs.deleteOnExit(p)
    return _folders[app]


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back: a cut in the lineage that
    outlives any executor, columnar and compressed. The table is deleted when the
    application ends."""
    spark = df.sparkSession
    path = f"{_tables(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
