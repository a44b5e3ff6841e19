"""Staging in the shared folder and small helpers of the operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a local one only where a local session has none."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        known = spark.sparkContext._jsc.sc().getCheckpointDir()
        folder = known.get() if known.isDefined() else None
    if folder is None:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="llm-stage-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A path in the shared folder, which goes when the application ends."""
    folder = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return folder


def staged(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df``, written to the shared folder once and read from there.

    Cuts the lineage: what follows neither repeats the work nor loses it with an executor.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def row_keyed(df: DataFrame, name: str) -> DataFrame:
    """``df`` with a column ``name`` that names each row the same way in every scan.

    It is the Parquet file and the place in it. A count of the rows of a task would follow
    how files are split, which changes with the cores alive when a scan is planned. Rows
    without a place are written first; those of a join or explode have one that several
    rows may share, and must be staged by the caller.
    """
    try:
        place = df.metadataColumn("_metadata")
        at = F.lpad(place["row_index"].cast("string"), 12, "0")
        return df.select("*", F.concat_ws("#", place["file_path"], at).alias(name))
    except AnalysisException:
        return row_keyed(staged(df, "keyed"), name)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
