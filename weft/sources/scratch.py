"""Tables written between the steps of one query, in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


_made: dict[str, str] = {}
#: Paths that materialize() wrote, oldest first, for clear().
_written: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; only a local session without one gets a temporary folder."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _made:
        _made[app] = "file://" + tempfile.mkdtemp(prefix="weft-")
        spark.sparkContext.setCheckpointDir(_made[app])
    return _made[app]


def new_path(spark: SparkSession, name: str) -> str:
    """A path nobody else writes to."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df once as Parquet and read it again: lineage ends here and lost executors cost only their tasks."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    _written.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a path through Hadoop's file system, whatever store it is in."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def remove_table(df: DataFrame) -> None:
    """Delete the files below a table that materialize() returned."""
    files = df.inputFiles()
    if files:
        remove(df.sparkSession, files[0].rsplit("/", 1)[0])


def mark() -> int:
    """A place in the list of written tables, for clear()."""
    return len(_written)


def clear(spark: SparkSession, since: int) -> None:
    """Delete the tables that materialize() wrote since a mark, but for the last one."""
    for path in _written[since:-1]:
        remove(spark, path)
    del _written[since:-1]


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


#: Rows of policy tables and the like that are broadcast.
BROADCAST_ROWS = 10_000


def small(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """df, to be broadcast if its rows, counted here, are few; otherwise the join is left to Spark."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df
