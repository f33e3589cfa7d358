"""Where intermediate tables live, and the few file-system calls the jobs need.

Intermediate results are written to the shared folder the cluster names in
``spark.checkpoint.dir``, so a lost executor never costs more than re-reading a file.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; only a local session may get one of its own."""
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="run-", dir="/tmp"))
    return context.getCheckpointDir().rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder (created by the first write)."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"


def write_table(df: DataFrame, path: str, partition_by: tuple[str, ...] = (), compression: str = "snappy") -> DataFrame:
    """Write once and continue from the files: cuts the lineage and fixes the rows.

    The files are read back with the written schema, so no inference job runs and string
    partition values such as ``02`` stay strings.
    """
    writer = df.write.mode("errorifexists").option("compression", compression)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def local_table(spark: SparkSession, rows: Sequence[Sequence], names: str) -> DataFrame:
    """A few rows held in the plan itself, of a size Spark therefore knows.

    ``names`` lists the columns; they are text unless marked ``name:bool``.
    """
    fields = []
    for item in names.split(","):
        name, _, kind = item.strip().partition(":")
        fields.append(pa.field(name, pa.bool_() if kind == "bool" else pa.string()))
    columns = list(zip(*rows)) if rows else [[] for _ in fields]
    arrays = [pa.array(c, f.type) for c, f in zip(columns, fields)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=pa.schema(fields)))


def _hadoop_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return hadoop_path, hadoop_path.getFileSystem(conf)


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its file system, as Spark lists files below it."""
    hadoop_path, fs = _hadoop_path(spark, path)
    return fs.makeQualified(hadoop_path).toString()


def exists(spark: SparkSession, path: str) -> bool:
    hadoop_path, fs = _hadoop_path(spark, path)
    return fs.exists(hadoop_path)


def remove(spark: SparkSession, path: str) -> bool:
    """Delete a folder; ``False`` when it was not there."""
    hadoop_path, fs = _hadoop_path(spark, path)
    return fs.delete(hadoop_path, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder; what lay at the target is replaced, folders above it are made."""
    from_path, fs = _hadoop_path(spark, source)
    to_path, _ = _hadoop_path(spark, target)
    fs.mkdirs(to_path.getParent())
    fs.delete(to_path, True)
    if not fs.rename(from_path, to_path):
        raise OSError(f"{source} could not be moved to {target}")


def plain_path(spark: SparkSession, uri: str) -> str:
    """The path of a file's address as Spark reports it (``%7D`` for ``}`` and the like)."""
    jvm = spark.sparkContext._jvm
    return jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(uri)).toString()


def children(spark: SparkSession, path: str) -> list[str]:
    """What lies directly in a folder; nothing if it is not there."""
    hadoop_path, fs = _hadoop_path(spark, path)
    if not fs.exists(hadoop_path):
        return []
    return [status.getPath().toString() for status in fs.listStatus(hadoop_path)]
