"""Imports every query module, so that the registry is complete."""

from farol.queries import modelling, monitoring, relations, scoring, tables, training  # noqa: F401
from farol.queries.registry import ORACLES, QUERIES  # noqa: F401
