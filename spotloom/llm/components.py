"""Components of links: folded within tasks first, contracted across tasks where needed."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from ..operators.components import contract_labels, least_reached
from ..session import cut_lineage

EDGES = 500_000  # links folded in one task, some 50 MB


def _folded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Links of one task as stars around the least id of each of its components."""
    held = [batch[["a", "b"]].to_numpy(dtype=np.int64) for batch in batches]
    links = np.concatenate(held) if held else np.zeros((0, 2), np.int64)
    ids, at = np.unique(links, return_inverse=True)
    root = least_reached(len(ids), at.reshape(links.shape))
    yield pd.DataFrame({"a": ids, "b": ids[root]}).astype("int64")


def components(edges: DataFrame) -> DataFrame:
    """(id, root) of every id of ``edges`` (a, b); root is the smallest id it reaches.

    Links are folded in tasks of at most EDGES links; one task's stars are final, those
    of several go through rounds of label contraction. ``edges`` should be a written table.
    """
    tasks = max(1, -(-edges.count() // EDGES))
    stars = edges.select("a", "b").coalesce(tasks).mapInPandas(_folded, "a long, b long")
    if tasks == 1:
        return cut_lineage(stars.selectExpr("a AS id", "b AS root"))
    return contract_labels(stars)
