"""Registry of runnable queries with the independent SQL each is checked against.

``out`` declares the result columns once for both sides: ``s`` string, ``b`` whole number,
``d`` double (compared to eight decimals) and ``l`` truth value.
"""

from dataclasses import dataclass
from typing import Callable, Optional

from pyspark.sql import functions as F

CATALOG = {}


@dataclass
class Query:
    name: str
    build: Callable
    out: Optional[dict]
    sql: Optional[str]

    def __call__(self, spark, root):
        df = self.build(spark, root)
        if self.out is None:
            return df
        return df.select(*(_spark_cell(c, kind).alias(c) for c, kind in self.out.items()))

    def oracle(self):
        if self.sql is None:
            return None
        cells = ", ".join(f"{_sql_cell(c, kind)} AS {c}" for c, kind in self.out.items())
        with_part, body = self.sql if isinstance(self.sql, tuple) else ("", self.sql)
        prefix = f"WITH {with_part} " if with_part else ""
        return f"{prefix}SELECT {cells} FROM ({body}) AS result"


def _spark_cell(column, kind):
    c = F.col(column)
    if kind == "b":
        return c.cast("long")
    if kind == "d":
        rounded = F.round(c.cast("double"), 8)
        return F.when(rounded == 0, F.lit(0.0)).otherwise(rounded)  # no negative zero
    return c.cast("boolean" if kind == "l" else "string")


def _sql_cell(column, kind):
    if kind == "b":
        return f"CAST({column} AS BIGINT)"
    if kind == "d":
        rounded = f"round(CAST({column} AS DOUBLE), 8)"
        return f"CASE WHEN {rounded} = 0 THEN CAST(0 AS DOUBLE) ELSE {rounded} END"
    return f"CAST({column} AS {'BOOLEAN' if kind == 'l' else 'VARCHAR'})"


def query(name, out=None, sql=None, ctes=()):
    """Register a builder ``(spark, root) -> DataFrame``; ``out`` is "col kind, ..."."""
    columns = dict(part.split() for part in out.split(",")) if out else None
    text = None
    if sql is not None:
        text = (", ".join(c.strip() for c in ctes), sql.strip())

    def register(build):
        CATALOG[name] = Query(name, build, columns, text)
        return build

    return register


def load_all():
    """Import every module that registers queries and return the registry."""
    from tagloom.plans import (  # noqa: F401
        catalog_labelling,
        catalog_learning,
        catalog_models,
        catalog_reports,
        catalog_text,
    )

    return CATALOG
