"""All named queries with their comparison SQL."""
from . import folds, plans, selection, series, streams, text, timeline  # noqa: F401
from .registry import ORACLE, QUERIES  # noqa: F401
