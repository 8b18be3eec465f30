"""The registered queries: each a function of the roles, with its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .roles import ROLES_SQL, Roles

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of Roles; sql is the body after the roles' common table expressions."""

    def add(f: Callable[[Roles], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: f(Roles(spark, sf_dir))
        if sql:
            body, start = sql.strip(), "WITH"
            if body.startswith("WITH RECURSIVE "):
                body, start = f"WITH {body[15:]}", "WITH RECURSIVE"
            joined = f", {body[5:]}" if body.upper().startswith("WITH ") else body
            SQL[name] = f"{start} {ROLES_SQL.strip()}\n{joined}"
        return f

    return add
