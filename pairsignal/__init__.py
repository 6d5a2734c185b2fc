"""Unusual item pairs in report data, found with Spark DataFrames."""

from pairsignal.schema import DEFAULT_COLUMNS, DEFAULT_PARAMS, Columns, MixtureParams

__all__ = ["Columns", "DEFAULT_COLUMNS", "DEFAULT_PARAMS", "MixtureParams"]
