"""Column naming helpers."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame


def snake_case(name: str) -> str:
    """camelCase / PascalCase / spaced names to snake_case ('OrderID' -> 'order_id')."""
    s = re.sub(r"[\s\-.]+", "_", name.strip())
    s = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", s)
    s = re.sub(r"([A-Z]+)([A-Z][a-z])", r"\1_\2", s)
    return re.sub(r"_+", "_", s).lower()


def snake_case_columns(df: DataFrame) -> DataFrame:
    """Rename every column to snake_case in one projection."""
    return df.withColumnsRenamed({c: snake_case(c) for c in df.columns if snake_case(c) != c})
