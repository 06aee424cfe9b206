"""Silver to gold: the KPI tables and the feature table."""

from __future__ import annotations

import logging
from datetime import datetime

from pyspark.sql import DataFrame

from windrow.operators import features, kpis
from windrow.sources import ingest, snapshots

log = logging.getLogger(__name__)

PARTITIONS = ["Year", "Month"]


def gold_tables(silver: DataFrame) -> dict[str, DataFrame]:
    return {
        "airport_analytics": kpis.airport_kpis(silver),
        "airline_analytics": kpis.airline_kpis(silver),
        "temporal_analytics": kpis.temporal_kpis(silver),
        "route_analytics": kpis.route_kpis(silver),
    }


def simple_tables(
    raw: DataFrame,
    min_airport: int = 100,
    min_airline: int = 1000,
    min_temporal: int = 50,
    sample: int | None = None,
) -> dict[str, DataFrame]:
    """The smaller set, straight from one year of raw records."""
    return {
        "airport_analytics": kpis.airport_kpis_simple(raw, min_airport),
        "airline_analytics": kpis.airline_kpis_simple(raw, min_airline),
        "temporal_analytics": kpis.temporal_kpis_simple(raw, min_temporal),
        "features": features.features_simple(raw, sample, year=None),
    }


def write_tables(
    tables: dict[str, DataFrame],
    root: str,
    committed_at: datetime | None = None,
) -> dict[str, str | None]:
    """Overwrites each table; returns the error text, or None, per table.

    A table that fails is reported and does not stop the others.
    """
    outcome: dict[str, str | None] = {}
    for name, table in tables.items():
        try:
            snapshots.commit(table, f"{root}/{name}", PARTITIONS, "overwrite", committed_at)
            outcome[name] = None
        except Exception as error:
            log.exception("writing %s failed", name)
            outcome[name] = str(error)
    return outcome


def write_features(silver: DataFrame, path: str, committed_at: datetime | None = None) -> int:
    table = features.features_full(silver)
    return snapshots.commit(table, path, PARTITIONS, "overwrite", committed_at)


def write_csv_tables(tables: dict[str, DataFrame], root: str) -> None:
    for name, table in tables.items():
        ingest.write_csv(table, f"{root}/{name}")
