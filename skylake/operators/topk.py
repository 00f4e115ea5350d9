"""Top-k and bottom-k reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def top_k(df: DataFrame, by: str, ascending: bool, k: int = 3) -> DataFrame:
    """First `k` rows by one column, NULLs last either way, ties broken by the other columns."""
    first = F.col(by).asc_nulls_last() if ascending else F.col(by).desc_nulls_last()
    rest = [F.col(c).asc_nulls_last() for c in df.columns if c != by]
    return df.orderBy(first, *rest).limit(k)
