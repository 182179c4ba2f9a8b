"""Whole numbers through pandas: a column with nulls would become floats, which hold 53 bits."""

from __future__ import annotations

from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column, functions as F


def as_text(column: str) -> Column:
    """A whole-number column as text, for `numbers` on the other side."""
    return F.col(column).cast("long").cast("string").alias(column)


def number(value: str | None) -> int | None:
    return None if value is None else int(value)


def numbers(values: Iterable[str | None]) -> pd.api.extensions.ExtensionArray:
    return pd.array([number(v) for v in values], "Int64")
