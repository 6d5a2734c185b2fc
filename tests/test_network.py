from conftest import rows

from pairsignal.operators.network import combination_filter, dense_ids
from pairsignal.plans.signals import signal_network


def signals(spark):
    data = [
        ("A", "B", "X", 4, 1.0, 4.0, 3.0, 2.5), ("A", "B", "Y", 4, 1.0, 4.0, 5.0, 2.1),
        ("A", "B", "W", 4, 1.0, 4.0, 3.0, 2.2), ("B", "C", "X", 4, 1.0, 4.0, 2.9, 2.0),
        ("A/B", "C", "X", 9, 1.0, 9.0, 8.0, 7.0), ("C", "D/E", "X", 9, 1.0, 9.0, 8.0, 7.0),
    ]
    return spark.createDataFrame(
        data, "drug1 string, drug2 string, react string, actual long, expected double, rrr double, ebgm double, ebci double"
    )


def test_combinations_are_dropped(spark):
    assert combination_filter(signals(spark)).count() == 4


def test_network(spark):
    nodes, edges = signal_network(signals(spark))
    assert rows(nodes, "id", "label") == [(0, "A"), (1, "B"), (2, "C")]
    assert rows(edges, "source", "target", "weight", "reactions") == [
        (0, 1, 2.5, ["Y", "W", "X"]), (1, 2, 2.0, ["X"])
    ]


def test_dense_ids_over_many_ranges(spark):
    names = [f"n{i * 7919 % 500:03}" for i in range(500)]
    df = spark.createDataFrame([(n,) for n in names], "name string").repartition(7)
    for ranges in (None, 1, 13, 600):
        assert rows(dense_ids(df, "name", ranges=ranges), "id", "name") == list(enumerate(sorted(names)))
