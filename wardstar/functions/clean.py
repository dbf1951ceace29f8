"""Cleaning steps for raw encounter rows."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Columns whose missing-value token is turned into NULL, and the columns that
# then get the text "Unknown" (diagnosis codes stay NULL); dispositions of
# patients who died or went to a hospice.
NULL_TOKEN_COLUMNS = ["race", "payer_code", "medical_specialty", "diag_1", "diag_2", "diag_3"]
UNKNOWN_FILL = {"medical_specialty": "Unknown", "payer_code": "Unknown", "race": "Unknown"}
EXCLUDED_DISPOSITIONS = [11, 19, 20, 21]


def null_tokens(df: DataFrame, cols: Iterable[str] = NULL_TOKEN_COLUMNS,
                token: str = "?") -> DataFrame:
    """Replace an exact token by NULL in the given columns (one projection)."""
    return df.withColumns({c: F.when(F.col(c) == token, F.lit(None)).otherwise(F.col(c))
                           for c in cols})


def fill_unknown(df: DataFrame, values: dict[str, str] | None = None) -> DataFrame:
    return df.fillna(values or UNKNOWN_FILL)


def exclude_values(df: DataFrame, col: str, values: Iterable = EXCLUDED_DISPOSITIONS) -> DataFrame:
    """Keep rows whose ``col`` is not in ``values``.

    SQL three-valued logic: a NULL ``col`` makes ``NOT IN`` NULL, so the row is
    dropped as well.
    """
    return df.filter(~F.col(col).isin(list(values)))

