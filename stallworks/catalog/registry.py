"""Collects queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..session import apply_recommended
from .roles import Roles, with_roles

Build = Callable[[Roles], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    build: Build
    sql: str | None

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return self.build(Roles(apply_recommended(spark), sf_dir))


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None) -> Callable[[Build], Build]:
    """Register a query. ``sql`` may refer to role tables; their definitions are added."""

    def register(build: Build) -> Build:
        if name in REGISTRY:
            raise ValueError(f"query {name!r} registered twice")
        REGISTRY[name] = Query(name, build, with_roles(sql) if sql else None)
        return build

    return register
