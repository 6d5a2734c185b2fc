"""Names, schemas and model parameters shared by all operators."""

from __future__ import annotations

from dataclasses import dataclass

FULL_STRATA = ("gender", "age", "fda_dt")
YEAR_STRATA = ("gender", "fda_year")


@dataclass(frozen=True)
class Columns:
    """Column names an operator works on, so any report x item x outcome data fits."""

    report: str = "isr"
    case: str = "case_id"
    item: str = "drug"
    outcome: str = "react"
    strata: tuple[str, ...] = FULL_STRATA

    @property
    def item1(self) -> str:
        return f"{self.item}1"

    @property
    def item2(self) -> str:
        return f"{self.item}2"

    @property
    def triple(self) -> tuple[str, str, str]:
        return (self.item1, self.item2, self.outcome)


DEFAULT_COLUMNS = Columns()
YEAR_COLUMNS = Columns(strata=YEAR_STRATA)


@dataclass(frozen=True)
class MixtureParams:
    """Two gamma components (shape alpha, rate beta) and the share p of the first."""

    alpha1: float
    beta1: float
    alpha2: float
    beta2: float
    p: float


# The shipped mixture.
DEFAULT_PARAMS = MixtureParams(
    alpha1=6.810308e-07, beta1=2.364503e-01, alpha2=2.499492e-04, beta2=3.896551e00, p=1.0
)


DEMO = (
    "isr BIGINT, case_id BIGINT, fda_dt STRING, age BIGINT, age_cod STRING, gender STRING"
)
DRUG = "isr BIGINT, drug_seq STRING, drug STRING"
REACT = "isr BIGINT, react STRING"

STRATUM_TYPES = {"gender": "STRING", "age": "BIGINT", "fda_dt": "STRING", "fda_year": "INT"}


def stage_columns(name: str, cols: Columns = DEFAULT_COLUMNS) -> dict[str, str]:
    """Columns of one stage table, in written order, with their types."""
    by = {s: STRATUM_TYPES.get(s, "STRING") for s in cols.strata}
    report = {cols.report: "BIGINT", **by}
    item, outcome = {cols.item: "STRING"}, {cols.outcome: "STRING"}
    triple = {cols.item1: "STRING", cols.item2: "STRING", **outcome}
    actual_expected = {**triple, "actual": "BIGINT", "expected": "DOUBLE"}
    # The names of the stage tables.
    tables = {
        "strat_drugs1_reacs": {**item, **outcome, **report},
        "strat_demo_counts": {**by, "n_stratum": "BIGINT"},
        "strat_drugs_counts": {**by, **item, "n_drug": "BIGINT"},
        "strat_reacs_counts": {**by, **outcome, "n_react": "BIGINT"},
        "strat_drugs_reacs_counts": {**by, **item, **outcome, "n": "BIGINT"},
        "strat_drugs2_reacs": {**triple, **report},
        "strat_drugs2_reacs_counts": {**by, **triple, "n": "BIGINT"},
        "strat_drugs2_reacs_marginals": {
            **by, **triple, **{c: "BIGINT" for c in ("n", "n_stratum", "n_drug1", "n_drug2", "n_react")}
        },
        "drugs2_reacs_actual_expected": actual_expected,
        "drugs2_reacs_sketches": {
            "actual": "BIGINT", "n_group": "BIGINT", "q0": "DOUBLE", "q10": "DOUBLE", "sketch": "BINARY"
        },
        "drugs2_reacs_stats": {
            "actual": "BIGINT", "bin": "INT", "sum_expected": "DOUBLE", "weight": "BIGINT"
        },
        "scored_drugs2_reacs": {
            **actual_expected, "rrr": "DOUBLE", "ebgm": "DOUBLE", "ebci": "DOUBLE"
        },
        "network_nodes": {"id": "BIGINT", "label": "STRING"},
        "network_edges": {
            "source": "BIGINT", "target": "BIGINT", "weight": "DOUBLE", "reactions": "ARRAY<STRING>"
        },
    }
    return tables[name]


# Text stage tables are joined with "$", but for the squashed table.
STAGE_SEPARATORS = {"drugs2_reacs_stats": ","}
