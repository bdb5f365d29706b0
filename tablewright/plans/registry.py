"""Where the named queries register: key, builder over the given tables, and the same question as SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tablewright.session import prepare
from tablewright.sources.files import bytes_below
from tablewright.sources.trial import TABLES, Trial


@dataclass(frozen=True)
class Registered:
    key: str
    build: Callable[[Trial], DataFrame]
    oracle: str | None

    def run(self, spark: SparkSession, folder: str) -> DataFrame:
        prepare(spark, sum(bytes_below(spark, f"{folder.rstrip('/')}/{name}.parquet") for name in TABLES))
        return self.build(Trial(spark, folder))


REGISTRY: dict[str, Registered] = {}


def query(oracle: str | None = None, key: str | None = None):
    """Register the decorated builder under its own name."""

    def add(build: Callable[[Trial], DataFrame]):
        name = key or build.__name__
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        REGISTRY[name] = Registered(name, build, oracle.strip() if oracle else None)
        return build

    return add
