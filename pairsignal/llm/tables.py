"""Reading the given tables and keeping intermediate ones in the shared checkpoint folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairsignal.sources.written import released_shuffles, shared_folder

NO_ID = -(2**63)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Brings this package to the Python workers, once for a context, wherever the driver started.

    The context serves the archive, a file of the driver's that goes with its process.
    """
    context = spark.sparkContext
    if getattr(context, "_pairsignal_shipped", False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    folder = tempfile.mkdtemp(prefix="pairsignal-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    path = os.path.join(folder, "pairsignal.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for top, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(top, name)
                    archive.write(full, os.path.relpath(full, os.path.dirname(package)))
    context.addPyFile(path)
    context._pairsignal_shipped = True


def by_place(docs: DataFrame) -> DataFrame:
    """``docs`` with its columns but doc_id and text named by their place, so that helper columns of
    a stage clash with none of them."""
    return docs.toDF(*[c if c in ("doc_id", "text") else f"_column{i}" for i, c in enumerate(docs.columns)])


def stored(df: DataFrame) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: cuts its lineage and outlives executors."""
    spark = df.sparkSession
    ship(spark)
    path = f"{shared_folder(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"
    with released_shuffles(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def deleted(df: DataFrame) -> None:
    """Deletes a table made by ``stored`` that nothing reads any more."""
    spark = df.sparkSession
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()[:1]}:
        if "/llm-" in path:
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def literal_rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A few rows of numbers or strings as an inline table, with no Python on the executors."""
    fields = [f.strip().split(" ") for f in schema.split(",")]

    def cell(value, kind: str) -> str:
        if value is None:
            return f"CAST(NULL AS {kind})"
        said = "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'" if isinstance(value, str) else f"'{value}'"
        return f"CAST({said} AS {kind})"

    if not rows:
        return spark.sql("SELECT " + ", ".join(f"CAST(NULL AS {k}) AS `{n}`" for n, k in fields)).limit(0)
    said = ", ".join("(" + ", ".join(cell(v, k) for v, (_, k) in zip(r, fields)) + ")" for r in rows)
    return spark.sql(f"SELECT * FROM VALUES {said} AS t({', '.join(f'`{n}`' for n, _ in fields)})")


def ascii_lower(column: Column) -> Column:
    """Lower-cases A to Z and no other letter."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
