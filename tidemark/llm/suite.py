"""Importing this module registers the queries of the subpackage."""

from tidemark.llm import bytepairs, centroids, lines, packing, passages, pieces, quality, search, secrets, sharding, simhash, spelling, toxicity  # noqa: F401
from tidemark.llm.registry import ORACLES, QUERIES  # noqa: F401
