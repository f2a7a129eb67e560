"""Imports every query module (in dependency order) so that the registry is complete."""

from __future__ import annotations

from . import q_series  # noqa: F401  (first: later oracles reuse its SQL)
from . import q_metrics  # noqa: F401
from . import q_decision  # noqa: F401
from . import q_clean  # noqa: F401
from . import q_merge  # noqa: F401
from . import q_load  # noqa: F401
from . import q_report  # noqa: F401
from . import q_sources  # noqa: F401
from . import q_stream_text  # noqa: F401
from .registry import ORACLE, QUERIES

__all__ = ["QUERIES", "ORACLE"]
