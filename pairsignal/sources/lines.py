"""Delimited report lines: reading, parsing, validity rules and case deduplication.

A line is split on ``$`` after its trailing separators are dropped, so trailing empty
fields do not count.  Every cast is a ``try_cast``: a field that does not parse makes the
line invalid and never fails the job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pairsignal.schema import Columns, DEFAULT_COLUMNS

# Characters trimmed from a field (all up to the space), as a SQL literal.
TRIM_CHARS = "'" + "".join(f"\\u{i:04x}" for i in range(33)) + "'"

# Field positions and validity limits.
DEMO_FIELDS = {"isr": 0, "case_id": 1, "fda_dt": 7, "age": 11, "age_cod": 12, "gender": 13}
DRUG_FIELDS = {"isr": 0, "drug_seq": 1, "drug": 3}
REACT_FIELDS = {"isr": 0, "react": 1}
SOURCES = ("demos", "drugs", "reactions")
AGE_UNIT = "YR"
GENDERS = ("M", "F")
FIRST_YEAR = 2008
MAX_AGE = 100


def read_report_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Raw lines of files, directories or globs (compressed files too) as ``value``."""
    return spark.read.text(paths)


def trimmed(c: str) -> str:
    """SQL for ``c`` without leading and trailing characters up to the space.

    Most fields need no trimming; two comparisons with the first character after the space
    find those that do, at a fraction of the cost of a trim.
    """
    return f"CASE WHEN {c} < '!' OR right({c}, 1) < '!' THEN btrim({c}, {TRIM_CHARS}) ELSE {c} END"


def year_of(date: str) -> str:
    """SQL for the year in the first four characters of a trimmed date, else null."""
    text = trimmed(date)
    return f"CASE WHEN {text} RLIKE '^[0-9]{{4}}' THEN try_cast(left({text}, 4) AS INT) END"


def _field(i: int) -> str:
    return f"get(f, {i})"


def _id(i: int) -> str:
    return f"try_cast({trimmed(_field(i))} AS BIGINT)"


def _parse(lines: DataFrame, fields: dict[str, str], valid: list[str]) -> DataFrame:
    """Split each line once and emit its fields with a ``valid`` flag.

    The one-row ``inline`` keeps a later filter on the fields above the split; pushed
    below it, each condition would split the line again.
    """
    parts = lines.selectExpr(r"split(rtrim('$', value), '\\$', -1) AS f")
    columns = [f"{sql} AS {name}" for name, sql in fields.items()]
    flag = f"coalesce({' AND '.join(valid)}, false) AS valid"
    return parts.selectExpr(f"inline(array(struct({', '.join([*columns, flag])})))")


def demo_fields(lines: DataFrame) -> DataFrame:
    """Demographic fields of every line, with the validity filter as column ``valid``."""
    at = DEMO_FIELDS
    age = f"try_cast(try_cast({trimmed(_field(at['age']))} AS FLOAT) AS BIGINT)"
    fields = {
        "isr": _id(at["isr"]),
        "case_id": _id(at["case_id"]),
        "fda_dt": _field(at["fda_dt"]),
        "age": age,
        "age_cod": _field(at["age_cod"]),
        "gender": _field(at["gender"]),
    }
    valid = [
        f"size(f) > {at['gender']}",
        f"{fields['isr']} IS NOT NULL",
        f"{fields['case_id']} IS NOT NULL",
        f"upper({trimmed(fields['age_cod'])}) = '{AGE_UNIT}'",
        f"upper({trimmed(fields['gender'])}) IN {GENDERS}",
        f"{year_of(fields['fda_dt'])} >= {FIRST_YEAR}",
        f"{age} > 0",
        f"{age} <= {MAX_AGE}",
    ]
    return _parse(lines, fields, valid)


def drug_fields(lines: DataFrame) -> DataFrame:
    at = DRUG_FIELDS
    fields = {
        "isr": _id(at["isr"]),
        "drug_seq": trimmed(_field(at["drug_seq"])),
        "drug": trimmed(_field(at["drug"])),
    }
    return _parse(lines, fields, [f"size(f) > {at['drug']}", f"{fields['isr']} IS NOT NULL"])


def react_fields(lines: DataFrame) -> DataFrame:
    at = REACT_FIELDS
    fields = {"isr": _id(at["isr"]), "react": trimmed(_field(at["react"]))}
    return _parse(lines, fields, [f"size(f) > {at['react']}", f"{fields['isr']} IS NOT NULL"])


def _only_valid(fields: DataFrame, seen: Observation | None = None) -> DataFrame:
    if seen is not None:
        fields = fields.observe(seen, F.count("*").alias("raw_lines"), F.count_if("valid").alias("valid_lines"))
    return fields.where("valid").drop("valid")


def parse_demo(lines: DataFrame, normalize_strata: bool = False, seen: Observation | None = None) -> DataFrame:
    """Valid demographic rows.  Gender and date stay as written unless normalised.

    ``seen`` observes the raw and valid lines in the job that first uses the rows; see ``line_counts``.
    """
    demo = _only_valid(demo_fields(lines), seen)
    if normalize_strata:
        demo = demo.withColumns(
            {
                "gender": F.expr(f"upper({trimmed('gender')})"),
                "fda_dt": F.expr(trimmed("fda_dt")),
            }
        )
    return demo


def parse_drug(lines: DataFrame, seen: Observation | None = None) -> DataFrame:
    return _only_valid(drug_fields(lines), seen)


def parse_react(lines: DataFrame, seen: Observation | None = None) -> DataFrame:
    return _only_valid(react_fields(lines), seen)


def line_counts(spark: SparkSession, observed: dict[str, Observation]) -> DataFrame:
    """Raw, valid and rejected lines of each source, from observations of jobs that have run."""
    found = [(name, *(seen.get[k] for k in ("raw_lines", "valid_lines"))) for name, seen in observed.items()]
    rows = [(name, raw, valid, raw - valid) for name, raw, valid in found]
    return spark.createDataFrame(rows, "source string, raw_lines long, valid_lines long, rejected_lines long")


def with_year(demo: DataFrame, date: str = "fda_dt", out: str = "fda_year") -> DataFrame:
    return demo.withColumn(out, F.expr(year_of(date)))


def dedupe_cases(demo: DataFrame, cols: Columns = DEFAULT_COLUMNS) -> DataFrame:
    """The row with the lowest report id of each case; ties go to the lowest other fields.

    ``min`` over a struct is combined before the shuffle, so a case with very many
    versions sends one row per map task.
    """
    rest = [c for c in demo.columns if c not in (cols.case, cols.report)]
    first = F.min(F.struct(cols.report, *rest)).alias("first")
    return demo.groupBy(cols.case).agg(first).select(
        *[cols.case if c == cols.case else f"first.{c}" for c in demo.columns]
    )


def ingest_line_counts(
    demo_lines: DataFrame, drug_lines: DataFrame, react_lines: DataFrame
) -> DataFrame:
    """Raw, valid and rejected lines of each source."""

    def counted(source: str, fields: DataFrame) -> DataFrame:
        return fields.agg(
            F.count("*").alias("raw_lines"),
            F.count_if("valid").alias("valid_lines"),
            F.count_if(~F.col("valid")).alias("rejected_lines"),
        ).select(F.lit(source).alias("source"), "raw_lines", "valid_lines", "rejected_lines")

    return (
        counted("demos", demo_fields(demo_lines))
        .unionByName(counted("drugs", drug_fields(drug_lines)))
        .unionByName(counted("reactions", react_fields(react_lines)))
    )
