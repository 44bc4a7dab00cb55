"""Warehouse building on Spark DataFrames.

Incremental extraction, key registries, slowly changing dimensions, versioned
facts, hub/link/satellite loading, marts and checks, plus three pipelines that
compose them (dimensional star, normalised corporate warehouse, data vault).
"""

from siltstone.session import build_session, materialize

__all__ = ["build_session", "materialize"]
