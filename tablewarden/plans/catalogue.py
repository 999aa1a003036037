"""All registered queries."""

from tablewarden.plans import (  # noqa: F401
    q_backup, q_cleaning, q_loading, q_monitoring, q_periods, q_quality, q_reshape, q_streams)
from tablewarden.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
