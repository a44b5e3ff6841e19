"""Shared folders: working space, staged tables and file moves."""

from __future__ import annotations

import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


def working_folder(spark: SparkSession, label: str) -> str:
    """A new folder under ``spark.checkpoint.dir``, which every executor sees.

    A local session that names none, as in tests, uses a temporary folder;
    elsewhere that is an error, since executors would not see it. The folder
    is removed when the application ends, or earlier by :func:`remove`.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.gettempdir()
    folder = f"{base.rstrip('/')}/tallyroll-{label}-{uuid.uuid4().hex}"
    path = _path(spark, folder)
    filesystem = _filesystem(spark, path)
    filesystem.mkdirs(path)
    filesystem.deleteOnExit(path)
    return folder


def stage(df: DataFrame, folder: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` once and read it back: later steps neither recompute it
    nor depend on executors that computed it."""
    df.write.mode("overwrite").partitionBy(*(partition_by or [])).parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def list_names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, sorted; empty when it does not exist."""
    path = _path(spark, folder)
    filesystem = _filesystem(spark, path)
    if not filesystem.exists(path):
        return []
    return sorted(status.getPath().getName() for status in filesystem.listStatus(path))


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a file or folder, if it is there."""
    path = _path(spark, folder)
    _filesystem(spark, path).delete(path, True)


def replace_path(spark: SparkSession, source: str, target: str) -> None:
    """Move a file or folder over ``target``, replacing what is there. Both lie
    on one filesystem; what was there stays until the new one is in place."""
    source_path, target_path = _path(spark, source), _path(spark, target)
    filesystem = _filesystem(spark, target_path)
    if not filesystem.exists(target_path.getParent()):
        filesystem.mkdirs(target_path.getParent())
    former = _path(spark, f"{source}-former")
    replaced = filesystem.exists(target_path)
    if replaced and not filesystem.rename(target_path, former):
        raise OSError(f"cannot replace {target}")
    if not filesystem.rename(source_path, target_path):
        if replaced:
            filesystem.rename(former, target_path)
        raise OSError(f"cannot move {source} to {target}")
    if replaced:
        filesystem.delete(former, True)


def write_text(spark: SparkSession, target: str, text: str) -> None:
    """Write a small file, replacing what is there."""
    path = _path(spark, target)
    filesystem = _filesystem(spark, path)
    if filesystem.exists(path):
        filesystem.delete(path, True)
    stream = filesystem.create(path, True)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()


def read_text(spark: SparkSession, source: str) -> str:
    """The text of a small file."""
    path = _path(spark, source)
    stream = _filesystem(spark, path).open(path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def publish_text(spark: SparkSession, target: str, text: str) -> bool:
    """Make a small file appear whole under a name that is free; False if the name is taken."""
    path = _path(spark, target)
    beside = f"{path.getParent()}/.{path.getName()}-{uuid.uuid4().hex}"
    write_text(spark, beside, text)
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(path.toUri(), spark._jsc.hadoopConfiguration())
    plain = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(_path(spark, beside), path, plain)
    except Py4JJavaError as error:
        remove(spark, beside)
        if "FileAlreadyExists" in error.java_exception.getClass().getName():
            return False
        raise
    return True


def _path(spark: SparkSession, name: str):
    return spark._jvm.org.apache.hadoop.fs.Path(name)


def _filesystem(spark: SparkSession, path):
    return path.getFileSystem(spark._jsc.hadoopConfiguration())
