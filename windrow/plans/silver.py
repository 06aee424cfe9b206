"""Bronze to silver."""

from __future__ import annotations

from pyspark.sql import DataFrame

from windrow.operators.cleaning import (
    clean, derive_features, normalize_categories, select_available,
)


def silver(bronze: DataFrame, from_date: bool = False) -> DataFrame:
    """Clean rows with normalised codes and derived columns; one scan, no shuffle."""
    return (
        bronze.transform(clean)
        .transform(normalize_categories)
        .transform(derive_features, from_date)
        .transform(select_available)
    )
