"""Tables written between the steps of a plan."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_local_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it.

    Only a local session without the setting gets a temporary folder of its own.
    """
    context = spark.sparkContext
    named = spark.conf.get(_SETTING, None) or context.getConf().get(_SETTING, None)
    if named:
        return named.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError(f"set {_SETTING} to a folder that all executors share")
    if context.applicationId not in _local_folders:
        _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="lotcraft-")
    return _local_folders[context.applicationId]


def new_folder(spark: SparkSession, name: str) -> str:
    """Path below the shared folder that nothing has used yet."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def folder_exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder made by `new_folder` that nothing reads any more."""
    if not path.startswith(shared_folder(spark) + "/"):
        raise ValueError(f"{path} is not below the shared folder")
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def cut_lineage(df: DataFrame, name: str = "step") -> DataFrame:
    """Write the frame once and read it back.

    Later steps start from columnar files with true sizes and column pruning, and a lost
    executor costs no more than the tasks it ran.
    """
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
