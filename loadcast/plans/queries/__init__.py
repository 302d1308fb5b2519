"""Registered queries, each with its SQL counterpart where SQL can express it."""

from . import aggregates, flagship, jobs, joins, models, ordered, rows, scalars, sets, sources, streams  # noqa: F401
from .base import ORACLES, QUERIES, Tables


def prepare(spark, sf_dir: str) -> None:
    """Write the tables and models that stand for landed history, so that no query's time holds another's input."""
    t = Tables(spark, sf_dir)
    t.price_history, t.weather_blocks  # noqa: B018
    t.stored("landed-documents", lambda: sources.landed_documents(t))
    models.dataset(t), models.panel(t), models._models(t)  # noqa: B018


__all__ = ["ORACLES", "QUERIES", "prepare"]
