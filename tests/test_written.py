"""Intermediate tables."""

from pyspark.sql import functions as F

from pairsignal.sources import written as w


def summed(spark, n):
    return spark.range(n).groupBy((F.col("id") % 97).alias("k")).agg(F.count("*").alias("n"))


def test_tables_written_at_once_leave_the_session_as_it_was(spark):
    before = spark.conf.get(w.RELEASE, None)
    tables = w.store_all(w.written, *[summed(spark, 1000 * (i + 1)) for i in range(6)])
    assert [t.agg(F.sum("n")).first()[0] for t in tables] == [1000 * (i + 1) for i in range(6)]
    assert spark.conf.get(w.RELEASE, None) == before


def test_a_plan_whose_shuffle_files_went_runs_again(spark):
    df = summed(spark, 5000)
    with w.released_shuffles(spark):
        assert sum(r.n for r in df.collect()) == 5000
        assert sum(r.n for r in df.collect()) == 5000
    assert sum(r.n for r in df.collect()) == 5000
    assert w.written(df).count() == 97


def test_a_failed_job_leaves_the_session_as_it_was(spark):
    before = spark.conf.get(w.RELEASE, None)
    try:
        with w.released_shuffles(spark):
            raise ValueError
    except ValueError:
        pass
    assert spark.conf.get(w.RELEASE, None) == before
