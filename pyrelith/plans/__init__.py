"""Queries composed from the operators; importing this registers all of them."""

from pyrelith.plans import climate, events, ingest, labelled, products, rasters, scalars, shapes, streams, studies  # noqa: F401
from pyrelith.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
