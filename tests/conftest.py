import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pairsignal.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session(cores=4, memory="4g", app="tests")


@pytest.fixture(scope="session")
def example(spark):
    """Five reports worked out by hand: demographics, drugs and reactions."""
    from pairsignal.sources.lines import dedupe_cases

    demo = spark.createDataFrame(
        [
            (1, 10, "20090101", 40, "YR", "F"),
            (2, 11, "20090101", 40, "YR", "F"),
            (3, 12, "20090101", 40, "YR", "F"),
            (4, 13, "20090202", 50, "YR", "M"),
            (5, 10, "20090101", 40, "YR", "F"),
        ],
        "isr long, case_id long, fda_dt string, age long, age_cod string, gender string",
    )
    names = {1: "AB", 2: "ABA", 3: "A", 4: "AB", 5: "AC"}
    drug = spark.createDataFrame(
        [(isr, str(i), d) for isr, ds in names.items() for i, d in enumerate(ds)],
        "isr long, drug_seq string, drug string",
    )
    terms = {1: "X", 2: "XY", 3: "X", 4: "X", 5: "Y"}
    react = spark.createDataFrame(
        [(isr, r) for isr, rs in terms.items() for r in rs], "isr long, react string"
    )
    return dedupe_cases(demo), drug, react


def rows(df, *names):
    return sorted(tuple(r) for r in df.select(*(names or df.columns)).collect())
