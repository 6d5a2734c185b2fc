import os
import shutil

import pytest
from conftest import rows

from pyspark.sql import Observation

from pairsignal import fixtures
from pairsignal.fixtures import demo_lines, drug_lines, react_lines, report_inputs
from pairsignal.operators.counts import drug_counts, pair_react_counts, react_counts, stratum_counts
from pairsignal.operators.expected import pair_marginals, report_actual_expected, report_marginals
from pairsignal.operators.fit import mixture_loglik, fit_input
from pairsignal.plans import stages
from pairsignal.plans.signals import SignalConfig, find_signals, find_triples, mixture_for, signals_of, squashed, triples_of
from pairsignal.schema import Columns, DEFAULT_PARAMS, YEAR_COLUMNS
from pairsignal.operators.reports import of_reports, report_tables
from pairsignal.sources import stage_tables
from pairsignal.sources.stage_tables import read_stage_table, write_bucketed, write_stage_table
from pairsignal.sources.lines import SOURCES, ingest_line_counts
from pairsignal.sources.written import written

SF = "/root/testdata/sf0.001"
CONFIG = SignalConfig(cols=YEAR_COLUMNS, posterior="rate", cap=None)


@pytest.mark.parametrize("fmt", ["parquet", "text"])
def test_round_trip(spark, tmp_path, fmt):
    data = [
        ("A", "", "X", 3, 0.1 + 0.2), ('"q"', "B C", "é", 10**12, 1e-17), ("A$B", "a,b;c", "\\d\\\\N", 1, 2.0),
        ("\\N", "line\nend\r", "\\", 2, 3.0), ("a\x00b", "\x00", "\\\x00\\n\n\\\\", 4, 5.0),
    ]
    df = spark.createDataFrame(data, "drug1 string, drug2 string, react string, actual long, expected double")
    for _ in range(2):  # a second run replaces the first
        write_stage_table(df, str(tmp_path), "drugs2_reacs_actual_expected", fmt=fmt)
    got = read_stage_table(spark, str(tmp_path), "drugs2_reacs_actual_expected", fmt=fmt)
    assert rows(got) == sorted(data) and got.dtypes == df.dtypes
    gaps = [("A", None, "X", 3, 1.0), (None, "$", None, None, None), (None, None, None, None, 2.0)]
    df = spark.createDataFrame(gaps, df.schema)
    write_stage_table(df, str(tmp_path), "drugs2_reacs_actual_expected", fmt=fmt)
    got = read_stage_table(spark, str(tmp_path), "drugs2_reacs_actual_expected", fmt=fmt)
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, gaps))
    edges = spark.createDataFrame(
        [(1, 2, 0.5, ["a;b", "$", "\\N"]), (1, 3, None, []), (2, 3, 1.0, [""])],
        "source long, target long, weight double, reactions array<string>",
    )
    write_stage_table(edges, str(tmp_path), "network_edges", fmt=fmt)
    assert sorted(read_stage_table(spark, str(tmp_path), "network_edges", fmt=fmt).collect()) == sorted(edges.collect())


def test_staged_run_with_other_columns(spark, tmp_path, example):
    """Any report x item x outcome data: the staged jobs equal the chain under other names."""
    cols = Columns(report="basket", case="customer", item="sku", outcome="event", strata=("gender",))
    demo, drug, react = example
    data = (
        demo.withColumnsRenamed({"isr": "basket", "case_id": "customer"}),
        drug.withColumnsRenamed({"isr": "basket", "drug": "sku"}),
        react.withColumnsRenamed({"isr": "basket", "react": "event"}),
    )
    config = SignalConfig(cols=cols, min_actual=1, min_ebci=0.0)
    for fmt in ("parquet", "text"):
        root = str(tmp_path / fmt)
        stages.run_counts(*data, root, config, fmt)
        stages.run_expected(spark, root, config, fmt)
        stages.run_score(spark, root, config, fmt)
        got = rows(read_stage_table(spark, root, "scored_drugs2_reacs", cols, fmt))
        want = rows(find_signals(*data, config))
        assert [g[:4] for g in got] == [w[:4] for w in want] and len(got) > 0


def test_squashed_text_is_comma_separated(spark, tmp_path):
    df = spark.createDataFrame([(3, 5, 3.5, 2)], "actual long, bin int, sum_expected double, weight long")
    path = write_stage_table(df, str(tmp_path), "drugs2_reacs_stats", fmt="text")
    assert rows(spark.read.text(path)) == [("3,5,3.5,2",)]


def test_text_is_zipped_in_files_of_bounded_length(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(stage_tables, "LINES", 100)
    df = spark.range(1000).repartition(1).selectExpr("id AS source", "id AS target", "0.5D AS weight", "array('a') AS reactions")
    path = write_stage_table(df, str(tmp_path), "network_edges", fmt="text")
    files = [f for f in os.listdir(path) if f.startswith("part-")]
    assert len(files) == 10 and all(f.endswith(".gz") for f in files)
    assert rows(read_stage_table(spark, str(tmp_path), "network_edges", fmt="text")) == rows(df)


def test_tables_that_are_there_give_the_same_signals(spark, example):
    demo, drug, react = example
    config = SignalConfig(cols=Columns(strata=("gender",)), min_actual=1, min_ebci=0.0)
    ids = demo.where("isr > 2")
    few = [of_reports(df, ids, config.cols) for df in (drug, react)]
    assert {r[0] for r in rows(few[0])} == {3, 4} and len(rows(few[0])) == 3 and len(rows(few[1])) == 2
    triples = written(triples_of(report_tables(ids, *few, config.cols, written), config))
    assert rows(triples) == rows(find_triples(ids, drug, react, config))
    assert rows(signals_of(triples, config)) == rows(find_signals(ids, drug, react, config))


def test_rows_that_lie_spread_are_not_shuffled(spark, tmp_path):
    for groups, spread in ((1, False), (8, True)):
        path = str(tmp_path / str(groups))
        spark.range(8000).repartition(groups).write.parquet(path)
        assert fixtures._spread(spark.read.parquet(path)) == spread


def test_staged_run_equals_the_chain(spark, tmp_path):
    sources = {}
    for name, make in (("demos", demo_lines), ("drugs", drug_lines), ("reactions", react_lines)):
        sources[name] = str(tmp_path / name)
        make(spark, SF).write.text(sources[name])
    root = str(tmp_path / "out")
    stages.run_all(spark, **sources, root=root, config=CONFIG, fmt="text")
    got = rows(read_stage_table(spark, root, "scored_drugs2_reacs", fmt="text"))
    want = rows(find_signals(*report_inputs(spark, SF), CONFIG))
    assert len(got) == 39
    for g, w in zip(got, want, strict=True):
        assert g[:4] == w[:4] and g[4:] == pytest.approx(w[4:], rel=1e-9)
    nodes, edges = stages.run_network(spark, root, CONFIG, "text")
    assert edges.count() <= 39 and nodes.count() <= 25


def test_fitted_parameters_are_likelier_than_shipped(spark):
    triples = written(find_triples(*report_inputs(spark, SF), CONFIG))
    cells = written(fit_input(squashed(triples)))
    params = mixture_for(triples, SignalConfig(cols=YEAR_COLUMNS, params="fit"))
    assert mixture_loglik(cells, params).first()[0] >= mixture_loglik(cells, DEFAULT_PARAMS).first()[0]


def bucketed(spark, tmp_path, example, buckets=4):
    demo, drug, react = example
    config = SignalConfig(cols=Columns(strata=("gender",)), min_actual=1)
    tables = report_tables(demo, drug, react, config.cols, written)
    write_bucketed(report_marginals(tables, config.cols, store=written), str(tmp_path), stages.MARGINALS, config.cols.triple,
                   buckets, config.cols)
    return config, tables, stages.bucketed_expected(spark, str(tmp_path), config, buckets)


def test_bucketed_pairs_are_summed_in_place(spark, tmp_path, example):
    """No exchange and no sort between the bucketed pair table and its sums."""
    config, tables, triples = bucketed(spark, tmp_path, example)
    plan = triples._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan and "Bucketed: true" in plan
    assert rows(triples) == rows(report_actual_expected(tables, config.cols))
    assert len(os.listdir(tmp_path)) == 1


def test_marginals_of_reports_are_those_of_the_joined_counts(example):
    cols = Columns(strata=("gender",))
    t = report_tables(*example, cols, written)
    want = pair_marginals(
        written(pair_react_counts(t.items, t.outcomes, cols)), stratum_counts(t.reports, cols), drug_counts(t.items, cols),
        react_counts(t.outcomes, cols), cols)
    assert rows(report_marginals(t, cols, store=written), *want.columns) == rows(want)


def test_another_session_reads_the_bucketed_table(spark, tmp_path, example):
    """The layout comes from the reader where the catalog does not know the table yet."""
    config, _, triples = bucketed(spark, tmp_path, example)
    want = rows(triples)
    name, _ = stage_tables._bucketed(str(tmp_path), stages.MARGINALS, 4)
    spark.sql(f"DROP TABLE {name}")
    again = stages.bucketed_expected(spark, str(tmp_path), config, 4)
    assert "Exchange" not in again._jdf.queryExecution().executedPlan().toString() and rows(again) == want


def test_lines_are_counted_by_the_jobs_that_parse_them(spark, tmp_path):
    """The observed counts are those of ``ingest_line_counts``, and each source is read once."""
    sources = {}
    for name, make in (("demos", demo_lines), ("drugs", drug_lines), ("reactions", react_lines)):
        sources[name] = str(tmp_path / name)
        make(spark, SF).write.text(sources[name])
    observed = {name: Observation() for name in SOURCES}
    read = stages.read_sources(spark, **sources, observed=observed)
    counted = stages.run_counts(*read, str(tmp_path / "out"), CONFIG, observed=observed)
    want = ingest_line_counts(*[spark.read.text(sources[name]) for name in SOURCES])
    assert rows(counted) == rows(want)


def test_sketches_of_an_earlier_root_are_not_read_from_triples(spark, tmp_path):
    """Squashing by merged sketches: weights are all triples of the new root, cuts those of both."""
    data = [("A", "B", f"r{i}", 3, float(i)) for i in range(200)]
    schema = "drug1 string, drug2 string, react string, actual long, expected double"
    roots = [str(tmp_path / name) for name in ("old", "new")]
    for fmt in ("parquet", "text"):
        for root, part in zip(roots, (data[:100], data[100:])):
            write_stage_table(spark.createDataFrame(part, schema), root, "drugs2_reacs_actual_expected", YEAR_COLUMNS, fmt)
        stages.run_sketches(spark, roots[0], CONFIG, fmt)
        shutil.rmtree(f"{roots[0]}/drugs2_reacs_actual_expected")
        stages.run_sketches(spark, roots[1], CONFIG, fmt, earlier=[roots[0]])
        stats = rows(read_stage_table(spark, roots[1], "drugs2_reacs_stats", YEAR_COLUMNS, fmt), "bin", "weight")
        assert sum(w for _, w in stats) == 100 and min(b for b, _ in stats) >= 5
