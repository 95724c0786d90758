"""Registry of named queries: a Spark plan and, where SQL can express it, a DuckDB oracle.

Each module under ``tickerflow.plans`` registers entries with ``@query``; the
driver contract in ``__spark_entry__.py`` reads ``QUERIES`` and ``ORACLES``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_checkpoint_dir, ship_package
from .normalize import finish

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame``; results are presented with ``finish``."""

    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_checkpoint_dir(spark)
            ship_package(spark)
            # day boundaries and timestamp text are defined in UTC (as in get_spark)
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return finish(fn(spark, sf_dir))

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        run.raw = fn
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return deco


def load_all() -> None:
    """Import every plan module so their queries register."""
    from . import q_alphas, q_articles, q_features, q_io, q_linking, q_pages, q_sources  # noqa: F401
