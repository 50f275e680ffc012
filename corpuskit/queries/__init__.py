"""Named queries on the driver's tables, and the SQL that each of them equals."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import builds, corpus, evaluation, messages, reviews, tasks

MODULES = (corpus, messages, tasks, evaluation, builds, reviews)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {name: query for m in MODULES for name, query in m.QUERIES.items()}
ORACLE_SQL: dict[str, str] = {name: sql for m in MODULES for name, sql in m.ORACLE_SQL.items()}
