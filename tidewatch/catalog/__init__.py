"""Checkable query catalog: Spark callables and their DuckDB twins."""

from . import (q_core, q_eval, q_features, q_model, q_profile, q_select,  # noqa: F401
               q_sources, q_stream)
from .base import ORACLE, QUERIES

__all__ = ["QUERIES", "ORACLE"]
