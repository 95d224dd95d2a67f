"""User-defined functions and their native replacements.

The native column expression is the default everywhere; the Python UDF is a
feature of its own, and both must agree. Rules and groups come from the caller.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Labels of payloads that no rule can name.
EMPTY, OTHER = "no_data", "other"


def classify_payload_udf(rules: Sequence[tuple[str, str]]):
    """Row-at-a-time Python UDF (slow path, kept for parity)."""
    rules = list(rules)

    @F.udf(StringType())
    def classify(payload):
        if payload is None or payload == "":
            return EMPTY
        for needle, label in rules:
            if needle in payload:
                return label
        return OTHER

    return classify


def classify_payload_native(col: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """Same rules as ``classify_payload_udf`` as a JVM-side ``when`` chain."""
    expr = F.when(col.isNull() | (col == ""), EMPTY)
    for needle, label in rules:
        expr = expr.when(col.contains(needle), label)
    return expr.otherwise(OTHER)


def categorize_udf(groups: Mapping[str, Sequence[str]], default: str):
    """Vectorized (Arrow batch) pandas UDF mapping a value to its group label."""
    lookup = {v: label for label, values in groups.items() for v in values}

    @F.pandas_udf(StringType())
    def categorize(values: pd.Series) -> pd.Series:
        return values.map(lookup).fillna(default)

    return categorize
