"""Connected components of a link table, by the engine's alternating-star operator."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.graph import connected_components


def components(links: DataFrame) -> DataFrame:
    """node, component (the smallest node reachable) for every end of the links (a, b)."""
    return connected_components(links, "a", "b")
