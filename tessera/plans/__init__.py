"""Named queries over the driver tables (see ``registry``)."""

from tessera.plans import basics, communities, formats, graphs, models, recsys, streams, text, typed, vectors, wrangling  # noqa: F401
from tessera.plans.registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
