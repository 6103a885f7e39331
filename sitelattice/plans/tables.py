"""Durable intermediate tables in the folder all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL: dict[str, str] = {}
#: Paths of the tables written by ``persist_table`` in this process and not dropped since.
_WRITTEN: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``.

    Where it is unset, a local session (tests) gets a temporary folder and a cluster
    a folder in the warehouse, which its executors share.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if spark.conf.get("spark.master", "").startswith("local"):
        _LOCAL.setdefault("dir", tempfile.mkdtemp(prefix="sitelattice-"))
        return f"file://{_LOCAL['dir']}"
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_stages"


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def persist_table(df: DataFrame, name: str, path: str | None = None, by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: lineage ends here,
    and a lost executor costs a reread, not a recomputation. ``by``: a folder for each value
    of these columns, so that one value is read without the others."""
    path = path or new_path(df.sparkSession, name)
    df.write.partitionBy(*by).parquet(path)
    _WRITTEN.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a folder through Hadoop's file system, wherever it lies."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    if path in _WRITTEN:
        _WRITTEN.remove(path)


def written() -> list[str]:
    """The tables that stand now: what is in a later list and not in this one was made between."""
    return list(_WRITTEN)


def drop_written(spark: SparkSession, before: list[str] = (), keep: tuple[str, ...] = ()) -> None:
    """Delete the tables written since ``before`` was taken, once what read them is written
    itself. Results not yet written must not hang on them."""
    for path in set(_WRITTEN) - set(before) - set(keep):
        drop_path(spark, path)


def stamp(spark: SparkSession, path: str) -> tuple[int, int] | None:
    """When a file or folder was last changed, and its length; None if it is not there."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(where):
        return None
    status = fs.getFileStatus(where)
    return status.getModificationTime(), status.getLen()
