"""Hexagon cells from column arithmetic; cell ids are our own."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Hexagon edge per resolution, in degrees.
EDGE = {4: 0.2, 6: 0.03, 7: 0.011, 8: 0.004}


def hex_cell(x: Column, y: Column, resolution: int) -> Column:
    """Id ``<resolution>:<q>:<r>`` of the hexagon around a point (axial coordinates)."""
    edge = EDGE[resolution]
    q = (F.lit(math.sqrt(3) / 3) * x - y / F.lit(3.0)) / F.lit(edge)
    r = (F.lit(2.0 / 3.0) * y) / F.lit(edge)
    s = -q - r
    near = lambda c: F.floor(c + F.lit(0.5))
    dq, dr, ds = F.abs(near(q) - q), F.abs(near(r) - r), F.abs(near(s) - s)
    # the axis with the largest rounding error follows from the other two
    cell_q = F.when((dq > dr) & (dq > ds), -near(r) - near(s)).otherwise(near(q))
    cell_r = F.when(~((dq > dr) & (dq > ds)) & (dr > ds), -near(q) - near(s)).otherwise(near(r))
    return F.concat_ws(":", F.lit(str(resolution)), cell_q.cast("string"), cell_r.cast("string"))


def hex_cells(resolutions=tuple(EDGE)) -> dict[str, Column]:
    """Origin and destination cells at every resolution."""
    return {f"{end}_cell_{n}": hex_cell(F.col(f"{end}_long"), F.col(f"{end}_lat"), n)
            for n in resolutions for end in ("o", "d")}
