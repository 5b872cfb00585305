"""Named queries: a DataFrame builder each, and the SQL that checks it where SQL can."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from stayrate.operators.cleaning import drop_blank_totals
from stayrate.plans.base_sql import with_base
from stayrate.session import store
from stayrate.sources.subscribers import load_subscribers, read_table


class Inputs:
    """The tables a query may read, loaded on first use."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, self.folder, name)

    @cached_property
    def subscribers(self) -> DataFrame:
        return load_subscribers(self.spark, self.folder)

    @cached_property
    def clean(self) -> DataFrame:
        return drop_blank_totals(self.subscribers)

    # The two below are for queries of several passes: the joins behind the view run once, and
    # only for the columns asked for.

    def stored_subscribers(self, *columns: str) -> DataFrame:
        return store(self.subscribers.select(*(columns or ["*"])), "subscribers")

    def stored_clean(self, *columns: str) -> DataFrame:
        return store(self.clean.select(*(columns or ["*"])), "clean")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, base: bool = True):
    """Register a builder ``Inputs -> DataFrame`` under ``q_<name>``."""

    def wrap(build: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
        key = f"q_{name}"
        if key in QUERIES:
            raise ValueError(f"{key} is registered twice")
        QUERIES[key] = lambda spark, folder: build(Inputs(spark, folder))
        if sql is not None:
            ORACLES[key] = with_base(sql) if base else sql
        return build

    return wrap
