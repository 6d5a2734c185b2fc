"""Written tables that cut a plan where several jobs or joins read the same rows.

Parquet files in the cluster's shared checkpoint folder: they survive the loss of any
executor, keep later plans small, and give the planner the true size of a table.
"""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from threading import Lock

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; with one local process only, where it is not
    set, a temporary one that goes when the process ends."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    folder = tempfile.mkdtemp(prefix="pairsignal-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(folder)
    return folder


RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_turn, _inside = Lock(), []  # what the session said before the first of the jobs that run at once


@contextmanager
def released_shuffles(spark: SparkSession) -> Iterator[None]:
    """Jobs started here leave no shuffle files on the executors once they end.

    What they made is in a table by then.  Should a plan that ran here run once more, Spark makes
    the missing files again."""
    with _turn:
        _inside.append(_inside[0] if _inside else spark.conf.get(RELEASE, None))
        spark.conf.set(RELEASE, "true")
    try:
        yield
    finally:
        with _turn:
            before = _inside.pop()
            if not _inside and before is None:
                spark.conf.unset(RELEASE)
            elif not _inside:
                spark.conf.set(RELEASE, before)


def written(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back."""
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/pairsignal-{uuid.uuid4().hex}"
    with released_shuffles(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unwritten(df: DataFrame) -> DataFrame:
    return df


def store_all(store: Callable[[DataFrame], DataFrame], *tables: DataFrame) -> list[DataFrame]:
    """Store tables that do not need one another, as jobs that run at the same time."""
    with ThreadPoolExecutor(len(tables)) as jobs:
        return list(jobs.map(store, tables))
