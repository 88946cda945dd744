"""Tables written between steps, in the folder the cluster names."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

ROWS_PER_TASK = 100_000


def shared_folder(spark: SparkSession) -> str:
    """Shared folder from ``spark.checkpoint.dir``.

    A local session without the setting gets a temporary folder; a cluster
    must name one, because executors do not share a machine's own disk.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return _local_folder()


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="hearthmill-")


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def few(df: DataFrame, rows: int) -> DataFrame:
    """The same rows in fewer partitions, if there are about ``rows`` of them.

    Every partition is a task, a file and the shuffle files of the next step,
    which cost more than a few rows do. At least two partitions per core stay,
    and one per ``ROWS_PER_TASK`` rows, so large tables are left as they are.
    Meant for what an aggregate or a join on a unique key has dealt evenly:
    parts of one hot key would fall together again.
    """
    return df.coalesce(max(2 * df.sparkSession.sparkContext.defaultParallelism, rows // ROWS_PER_TASK))


def settle(df: DataFrame, label: str, rows: int | None = None) -> DataFrame:
    """Write a step's result and read it back.

    The written size is what the optimizer then sees, so a small table is
    broadcast because it is small and a large one is shuffled. The table also
    cuts the lineage: a lost executor does not repeat the steps before it.
    With ``rows``, about how many there are, it is written in ``few`` files.
    """
    path = fresh_path(df.sparkSession, label)
    (df if rows is None else few(df, rows)).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
