"""Registered queries: each runs an operator over whole tables of a data folder."""

from cropspark.plans import cleaning, files, integrity, kept, loads, ranking, statistics  # noqa: F401
from cropspark.plans.registry import oracles, queries  # noqa: F401
