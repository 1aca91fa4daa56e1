"""All registered queries of the engine and their DuckDB counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import events, extract, loads, matches, parcels, permits, records, web

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {**events.QUERIES, **records.QUERIES, **permits.QUERIES, **web.QUERIES, **extract.QUERIES, **parcels.QUERIES, **loads.QUERIES, **matches.QUERIES}
ORACLE_SQL: dict[str, str] = {**events.ORACLE_SQL, **records.ORACLE_SQL, **permits.ORACLE_SQL, **web.ORACLE_SQL, **extract.ORACLE_SQL, **parcels.ORACLE_SQL, **loads.ORACLE_SQL, **matches.ORACLE_SQL}
