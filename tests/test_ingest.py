import gzip

from conftest import rows

from pairsignal.sources.lines import (
    dedupe_cases,
    demo_fields,
    ingest_line_counts,
    parse_demo,
    parse_drug,
    parse_react,
    read_report_lines,
    with_year,
)


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def demo_line(isr="1", case="10", date="20090101", age="40", unit="YR", sex="F", tail=""):
    return "$".join([isr, case, "", "", "", "", "", date, "", "", "", age, unit, sex]) + tail


def kept(spark, *values):
    return rows(parse_demo(lines(spark, *values)), "isr", "fda_dt", "age", "age_cod", "gender")


def test_demo_values_stay_raw(spark):
    assert kept(spark, demo_line(isr=" 7 ", date=" 20090101", unit="yr ", sex=" f", tail="$x$$")) == [
        (7, " 20090101", 40, "yr ", " f")
    ]


def test_demo_ages(spark):
    ages = {"100.9": 100, "0.5": None, "101": None, "-3": None, "abc": None, "NaN": None, "": None,
            "Infinity": None, "1e1": 10, "\t44 ": 44, "99999999999999999999": None}
    got = rows(parse_demo(lines(spark, *[demo_line(str(i), age=a) for i, a in enumerate(ages)])), "isr", "age")
    assert got == [(i, v) for i, v in enumerate(ages.values()) if v is not None]


def test_demo_rejects(spark):
    bad = [
        demo_line(date="20071231"), demo_line(date="200"), demo_line(date=""), demo_line(unit="MON"),
        demo_line(sex="U"), demo_line(sex=""), demo_line(isr="x"), demo_line(isr="9223372036854775808"),
        demo_line(case=""), demo_line(isr="5.7"), "ISR$CASE", "", "$$$", None,
    ]
    assert kept(spark, *bad) == []
    assert demo_fields(lines(spark, *bad)).where("valid").isEmpty()


def test_normalized_strata(spark):
    df = parse_demo(lines(spark, demo_line(sex=" f", date=" 20090101 ")), normalize_strata=True)
    assert rows(with_year(df), "gender", "fda_dt", "fda_year") == [("F", "20090101", 2009)]


def test_drugs(spark):
    got = rows(parse_drug(lines(
        spark, "1$s$PS$ ASPIRIN\t$1", "2$s$PS$$1", "3$s$PS$$$", "4$s$PS", "ISR$DRUG_SEQ$ROLE$DRUGNAME", "+5$$$b c$$",
    )))
    assert got == [(1, "s", "ASPIRIN"), (2, "s", ""), (5, "", "b c")]


def test_reactions(spark):
    got = rows(parse_react(lines(spark, "1$Rash ", "2$", "3", "ISR$PT", "4$$x", "5$é $")))
    assert got == [(1, "Rash"), (4, ""), (5, "é")]


def test_dedupe_keeps_lowest_report(spark):
    demo = parse_demo(lines(
        spark, demo_line("5"), demo_line("3", sex="M"), demo_line("1", sex="U"), demo_line("9", case="11"),
        demo_line("3", sex="F"),
    ))
    assert rows(dedupe_cases(demo), "case_id", "isr", "gender") == [(10, 3, "F"), (11, 9, "F")]


def test_one_split_per_line(spark):
    plan = parse_demo(lines(spark, demo_line()))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("split(") == 1


def test_line_counts(spark):
    got = rows(ingest_line_counts(
        lines(spark, "ISR", demo_line()), lines(spark, "1$s$$A", "x$s$$A"), lines(spark, "1$R")
    ))
    assert got == [("demos", 2, 1, 1), ("drugs", 2, 1, 1), ("reactions", 1, 1, 0)]


def test_read_lines_from_folder(spark, tmp_path):
    (tmp_path / "a.txt").write_text("1$R\n2$S\r\n")
    with gzip.open(tmp_path / "b.txt.gz", "wt") as f:
        f.write("3$T\n")
    assert rows(read_report_lines(spark, str(tmp_path))) == [("1$R",), ("2$S",), ("3$T",)]
