"""Stage tables between jobs: Parquet by default, delimited text for exchange.

A re-read Parquet table brings its true size to the planner, which then broadcasts a
small side on that size and sorts a large one; it also cuts the lineage at a place that
survives the loss of an executor.
"""

from __future__ import annotations

import zlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairsignal.schema import Columns, DEFAULT_COLUMNS, STAGE_SEPARATORS, stage_columns
from pairsignal.sources.written import released_shuffles


# Text is zipped, and a zipped file is read by one task, so a file holds this many lines at most.
LINES = 2_000_000

# How text says what its separator would hide: a null, and the signs themselves.
NULL = "\\N"
ESCAPES = (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r"), ("$", "\\d"), (",", "\\c"), (";", "\\s"))


def _escaped(field: Column) -> Column:
    """A field as text: a null is NULL, and no separator or line end is left in it."""
    for sign, said in ESCAPES:
        field = F.replace(field, F.lit(sign), F.lit(said))
    return F.coalesce(field, F.lit(NULL))


def _unescaped(field: Column) -> Column:
    """The field as it was.  Between doubled escapes no escape begins or ends, so each stretch between
    them is decoded by itself, and no character serves as a mark of its own."""
    def decoded(part: Column) -> Column:
        for sign, said in reversed(ESCAPES[1:]):
            part = F.replace(part, F.lit(said), F.lit(sign))
        return part

    parts = F.transform(F.split(field, r"\\\\", -1), decoded)
    return F.when(field != NULL, F.array_join(parts, "\\"))


def stage_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def _said(field: Column, kind: str) -> Column:
    """A list as its escaped members, each with ";" after it; bytes in base 64; other values as text."""
    if kind == "BINARY":
        return _escaped(F.regexp_replace(F.base64(field), r"\s", ""))
    if kind != "ARRAY<STRING>":
        return _escaped(field.cast("string"))
    each = F.transform(field, lambda x: F.concat(_escaped(x), F.lit(";")))
    return F.coalesce(F.array_join(each, ""), F.lit(NULL))


def _meant(text: Column, kind: str) -> Column:
    if kind == "BINARY":
        return F.unbase64(_unescaped(text))
    if kind != "ARRAY<STRING>":
        return _unescaped(text).cast(kind)
    members = F.transform(F.split(F.regexp_replace(text, ";$", ""), ";"), _unescaped)
    return F.when(text == "", F.array().cast(kind)).when(text != NULL, members)


def write_stage_table(
    df: DataFrame,
    root: str,
    name: str,
    cols: Columns = DEFAULT_COLUMNS,
    fmt: str = "parquet",
) -> str:
    """Write ``df`` as stage table ``name`` under ``root``, replacing an earlier one.

    Text fields are escaped, so nulls, separators and line ends come back as they were.

    Row order is kept: the parts of a globally sorted frame follow one another.
    """
    columns = stage_columns(name, cols)
    path = stage_path(root, name)
    if fmt == "parquet":
        with released_shuffles(df.sparkSession):
            df.select(*[F.col(f"`{c}`") for c in columns]).write.mode("overwrite").parquet(path)
    elif fmt == "text":
        sep = STAGE_SEPARATORS.get(name, "$")
        fields = [_said(F.col(f"`{c}`"), kind) for c, kind in columns.items()]
        lines = df.select(F.concat_ws(sep, *fields).alias("value"))
        with released_shuffles(df.sparkSession):
            lines.write.mode("overwrite").option("maxRecordsPerFile", LINES).text(path, compression="gzip")
    else:
        raise ValueError(f"unknown stage format {fmt!r}")
    return path


def _bucketed(root: str, name: str, buckets: int) -> tuple[str, str]:
    """Catalog name and folder of the bucketed stage table ``name`` under ``root``."""
    path = stage_path(root, f"{name}_in_{buckets}")
    return f"pairsignal_{name}_{zlib.crc32(path.encode()):08x}", path


def write_bucketed(
    df: DataFrame, root: str, name: str, by: Sequence[str], buckets: int, cols: Columns = DEFAULT_COLUMNS
) -> str:
    """Write ``df`` as stage table ``name``, hashed by ``by`` into ``buckets`` sorted files.

    What groups or joins by these columns then reads the table in place: no shuffle, no sort.
    """
    table, path = _bucketed(root, name, buckets)
    df.sparkSession.sql(f"DROP TABLE IF EXISTS {table}")
    (
        df.select(*[F.col(f"`{c}`") for c in stage_columns(name, cols)])
        .repartition(buckets, *by).sortWithinPartitions(*by)
        .write.mode("overwrite").bucketBy(buckets, *by).sortBy(*by).option("path", path).saveAsTable(table)
    )
    return path


def read_bucketed(
    spark: SparkSession, root: str, name: str, by: Sequence[str], buckets: int, cols: Columns = DEFAULT_COLUMNS
) -> DataFrame:
    """The table of ``write_bucketed``; another session's catalog learns its layout here."""
    table, path = _bucketed(root, name, buckets)
    columns = ", ".join(f"`{c}` {t}" for c, t in stage_columns(name, cols).items())
    keys = ", ".join(f"`{c}`" for c in by)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet "
        f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    return spark.table(table)


def read_stage_table(
    spark: SparkSession,
    root: str,
    name: str,
    cols: Columns = DEFAULT_COLUMNS,
    fmt: str = "parquet",
) -> DataFrame:
    columns = stage_columns(name, cols)
    path = stage_path(root, name)
    if fmt == "parquet":
        return spark.read.schema(", ".join(f"`{c}` {t}" for c, t in columns.items())).parquet(path)
    if fmt != "text":
        raise ValueError(f"unknown stage format {fmt!r}")
    sep = STAGE_SEPARATORS.get(name, "$")
    parts = spark.read.text(path).select(F.split("value", f"[{sep}]", -1).alias("f"))
    return parts.select(
        *[
            _meant(F.get("f", F.lit(i)), kind).alias(name_)
            for i, (name_, kind) in enumerate(columns.items())
        ]
    )
