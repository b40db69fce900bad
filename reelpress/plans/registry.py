"""Named queries over the driver's tables, each with its comparison SQL where SQL can say it."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from reelpress.plans.tables import ROLES, Tables, role_sql


@dataclass(frozen=True)
class Query:
    name: str
    covers: tuple[str, ...]
    build: Callable[[Tables], DataFrame]
    sql: str | None

    def run(self, spark: SparkSession, folder: str) -> DataFrame:
        return self.build(Tables(spark, folder))


CATALOG: dict[str, Query] = {}


def query(covers: str, sql: str | None = None):
    """Registers the function under its own name; ``covers`` lists operator ids."""

    def register(build: Callable[[Tables], DataFrame]):
        name = build.__name__
        if name in CATALOG:
            raise ValueError(f"query {name} is registered twice")
        CATALOG[name] = Query(name, tuple(covers.split()), build, with_roles(sql) if sql else None)
        return build

    return register


def with_roles(sql: str) -> str:
    """Puts the roles the statement mentions in front of it as common table expressions."""
    ctes = [
        f"{name} AS ({role_sql(name)})" for name in ROLES if re.search(rf"\b{name}\b", sql)
    ]
    body = sql.strip()
    if not ctes:
        return body
    if body[:5].upper() == "WITH ":
        return f"WITH {', '.join(ctes)}, {body[5:]}"
    return f"WITH {', '.join(ctes)} {body}"
