"""Every registered query with its SQL twin, so that the two cannot drift apart."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lodewatch.fixtures import Tables
from lodewatch.plans.catalog import CATALOG


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: (lambda spark, sf_dir, build=e.build: build(Tables(spark, sf_dir))) for name, e in CATALOG.items()}


def oracle_sql() -> dict[str, str]:
    return {name: e.oracle for name, e in CATALOG.items() if e.oracle is not None}


def entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship query: coverage of every company."""
    return CATALOG["coverage_full"].build(Tables(spark, sf_dir))
