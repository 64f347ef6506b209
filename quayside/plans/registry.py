"""Registry of named queries and the SQL each one is checked against."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from quayside.session import pin_utc, scratch_path

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


class Inputs:
    """The given tables of one folder, read lazily by attribute: ``t.orders``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = pin_utc(spark)
        self.sf_dir = sf_dir.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def path(self, name: str) -> str:
        return f"{self.sf_dir}/{name}.parquet"

    def scratch(self, label: str) -> str:
        return scratch_path(self.spark, label)

    def sql(self, text: str) -> DataFrame:
        """Run SQL over the given tables; the tables it names become temporary views."""
        for name in TABLES:
            if re.search(rf"\b{name}\b", text):
                getattr(self, name).createOrReplaceTempView(name)
        return self.spark.sql(text)


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Inputs], DataFrame]
    oracle: str | None

    def __call__(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return self.build(Inputs(spark, sf_dir))


QUERIES: dict[str, Query] = {}


def add(name: str, build: Callable[[Inputs], DataFrame], oracle: str | None = None) -> None:
    if name in QUERIES:
        raise ValueError(f"query {name} registered twice")
    QUERIES[name] = Query(name, build, oracle)


def query(name: str, oracle: str | None = None):
    def register(build):
        add(name, build, oracle)
        return build

    return register
