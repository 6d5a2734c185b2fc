"""The driver's order tables read as reports: an order is a report, its line items name the
drugs (part brands) and reactions (supplier nations).  The rules are those of FIXTURES.md."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairsignal.sources.lines import dedupe_cases, parse_demo, parse_drug, parse_react, with_year

DEMO_HEADER = "ISR$CASE$I_F_COD$FOLL_SEQ$IMAGE$EVENT_DT$MFR_DT$FDA_DT$REPT_COD$MFR_NUM$MFR_SNDR$AGE$AGE_COD$GNDR_COD"
DRUG_HEADER = "ISR$DRUG_SEQ$ROLE_COD$DRUGNAME"
REACT_HEADER = "ISR$PT"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _spread(table: DataFrame) -> bool:
    """Whether the tasks that read ``table`` have rows for all cores: none has twice its share.

    Row groups say how rows lie, and are counted without reading a column.
    """
    cores = table.sparkSession.sparkContext.defaultParallelism
    rows = table.groupBy(F.spark_partition_id().alias("task")).agg(F.count("*").alias("n"))
    found = rows.agg(F.max("n").alias("most"), F.sum("n").alias("all")).first()
    return found["all"] is not None and found["most"] * cores <= 2 * found["all"]


def _as_lines(lines: DataFrame, header: str, table: DataFrame | None = None) -> DataFrame:
    """Lines and a header line, spread over all cores as the splits of text files are.

    A small driver table is one row group and so would be read and parsed by one task; a large one
    has many, and the lines of such a ``table`` stay where they are.
    """
    spark = lines.sparkSession
    lines = lines.union(spark.range(1).select(F.lit(header).alias("value")))
    return lines if table is not None and _spread(table) else lines.repartition(spark.sparkContext.defaultParallelism)


def demo_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    sex = "CASE o_orderstatus WHEN 'F' THEN 'F' WHEN 'O' THEN 'M' ELSE 'U' END"
    age = "CAST(o_custkey % 110 AS STRING)"
    fields = {
        0: "CAST(o_orderkey AS STRING)",
        1: "CAST(o_orderkey DIV 2 AS STRING)",
        7: "concat(year(o_orderdate) + 11, date_format(o_orderdate, 'MMdd'))",
        11: f"CASE WHEN o_orderkey % 17 = 0 THEN 'abc' "
        f"WHEN o_orderkey % 29 = 0 THEN concat({age}, '.7') ELSE {age} END",
        12: "CASE WHEN o_orderkey % 19 = 0 THEN 'MON' ELSE 'YR' END",
        13: f"CASE WHEN o_orderkey % 23 = 0 THEN lower({sex}) ELSE {sex} END",
    }
    line = ", ".join(fields.get(i, "''") for i in range(14))
    # Dealt in any case: making and parsing a line of so many fields is too much code for one stage.
    orders = _table(spark, sf_dir, "orders")
    return _as_lines(orders.selectExpr(f"concat_ws('$', {line}) AS value"), DEMO_HEADER)


def drug_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = _table(spark, sf_dir, "part").withColumnRenamed("p_partkey", "l_partkey")
    lineitem = _table(spark, sf_dir, "lineitem")
    rows = lineitem.join(part, "l_partkey")
    line = "concat_ws('$', CAST(l_orderkey AS STRING), CAST(l_linenumber AS STRING), '', p_brand)"
    return _as_lines(rows.selectExpr(f"{line} AS value"), DRUG_HEADER, lineitem)


def react_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = _table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey AS l_suppkey", "s_nationkey AS n_nationkey"
    )
    nation = _table(spark, sf_dir, "nation")
    lineitem = _table(spark, sf_dir, "lineitem")
    rows = lineitem.join(supplier, "l_suppkey").join(nation, "n_nationkey")
    line = "concat_ws('$', CAST(l_orderkey AS STRING), n_name)"
    return _as_lines(rows.selectExpr(f"{line} AS value"), REACT_HEADER, lineitem)


def report_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Deduplicated demographics (with ``fda_year``), drugs and reactions, from lines."""
    demo = with_year(dedupe_cases(parse_demo(demo_lines(spark, sf_dir))))
    return demo, parse_drug(drug_lines(spark, sf_dir)), parse_react(react_lines(spark, sf_dir))
