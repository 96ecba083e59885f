"""Sums of large numeric tables that every task contributes to, added in a tree of fixed fan-in."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCKS = 64
FAN_IN = 64
LEVELS = 3


def _add(group: pa.Table) -> pa.Table:
    group = group.sort_by("part")
    total = sum(np.frombuffer(b, np.float32).astype(float) for b in group["sums"].to_pylist())
    part = group["part"][0].as_py() // FAN_IN
    columns = [group["block"][:1], pa.array([part], pa.int64()), pa.array([total.astype(np.float32).tobytes()], pa.binary())]
    return pa.table(columns, names=["block", "part", "sums"])


def tree_sum(parts: DataFrame) -> np.ndarray | None:
    """Sum per ``block`` of the float32 arrays ``sums`` of all tasks (``part``), one row per block.

    A group never holds more than ``FAN_IN`` arrays while there are up to
    ``FAN_IN ** LEVELS`` tasks, and the driver gets ``BLOCKS`` arrays. None without tasks.
    """
    for _ in range(LEVELS):
        parts = parts.groupBy("block", F.expr(f"part DIV {FAN_IN}")).applyInArrow(_add, parts.schema)
    blocks: dict[int, np.ndarray] = {}
    for r in parts.collect():
        blocks[r.block] = blocks.get(r.block, 0) + np.frombuffer(r.sums, np.float32).astype(float)
    return np.stack([blocks[b] for b in range(BLOCKS)]) if blocks else None
