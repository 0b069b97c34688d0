"""Queries over the driver's tables, each beside the SQL that must give the same rows."""

from . import ingesting, labelling, publishing, selecting, signals  # noqa: F401
from .projections import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
