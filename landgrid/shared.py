"""Materialised intermediates in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a scratch folder only for a local session without one."""
    folder = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="landgrid-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir()


_written: dict[str, list[str]] = {}


def saved(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    This cuts the lineage, survives the loss of executors, and computes the input once, where
    ``DataFrame.checkpoint`` would compute it twice. Reading it back also gives Spark its true size.
    """
    path = f"{shared_folder(df.sparkSession)}/saved-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _written.setdefault(df.sparkSession.sparkContext.applicationId, []).append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffled(df: DataFrame) -> DataFrame:
    """``df`` as a side of a join that goes through a shuffle, however small its files are.

    Spark broadcasts by the size of compressed files; the hash table made of them can be a hundred times that, and
    the driver holds it whole. For joins whose sides both grow with the input.
    """
    return df.hint("merge")


def discard(df: DataFrame) -> None:
    """Delete the one table that ``saved`` returned as ``df``; all that was made from it must be written by now."""
    spark = df.sparkSession
    context = spark.sparkContext
    paths = _written.get(context.applicationId, [])
    files = df.inputFiles()
    for path in [p for p in paths if files and p.rsplit("/", 1)[1] in files[0]]:
        _delete(context, path)
        paths.remove(path)


def _delete(context, path: str) -> None:
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)


def discard_saved(spark: SparkSession) -> int:
    """Delete the tables ``saved`` has written so far; frames made from them can't be read any more.

    For a caller that has stored its results. Returns the number of tables.
    """
    context = spark.sparkContext
    paths = _written.pop(context.applicationId, [])
    for path in paths:
        _delete(context, path)
    return len(paths)
