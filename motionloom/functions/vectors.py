"""Vector arithmetic on native columns."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add, and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..vocabulary import VECTORS


def columns_of(quantity: str) -> list[Column]:
    return [F.col(c) for c in VECTORS[quantity]]


def finite(value: Column) -> Column:
    return F.coalesce(F.abs(value) < F.lit(float("inf")), F.lit(False))  # NaN is greater than everything


def all_finite(parts: Sequence[Column]) -> Column:
    return reduce(and_, [finite(p) for p in parts])


def norm(parts: Sequence[Column]) -> Column:
    """Length of a vector, NULL unless every component is finite."""
    return F.when(all_finite(parts), F.sqrt(reduce(add, [p * p for p in parts])))


def norm_of(quantity: str) -> Column:
    """Length of a vector of the table, NULL unless every component is finite."""
    names = [f"`{c}`" for c in VECTORS[quantity]]
    whole = " AND ".join(f"abs({c}) < double('Infinity')" for c in names)
    return F.expr(f"CASE WHEN {whole} THEN sqrt({' + '.join(f'{c} * {c}' for c in names)}) END")


def gravity_from_quaternion(quat: Sequence[Column]) -> list[Column]:
    """World-frame down vector seen by the device, for scalar-last attitude quaternions.

    The third row of the rotation matrix, negated; dividing by the squared norm makes it
    independent of the quaternion's scale.  NULL for a zero quaternion.
    """
    x, y, z, w = quat
    size = x * x + y * y + z * z + w * w
    scale = F.when(size > 0, F.lit(2.0) / size)
    return [-scale * (x * z - w * y), -scale * (y * z + w * x), scale * (x * x + y * y) - 1.0]


def with_attitude_gravity(table: DataFrame) -> DataFrame:
    """``table`` with ``down_x, down_y, down_z``: what :func:`gravity_from_quaternion` says of its attitude.

    Each step has columns of its own, so that what builds on them refers to a value and does not repeat its expression.
    """
    x, y, z, w = (f"`{c}`" for c in VECTORS["quat"])
    sized = table.withColumn("_turn", F.expr(f"{x} * {x} + {y} * {y} + {z} * {z} + {w} * {w}"))
    scaled = sized.withColumn("_turn", F.expr("CASE WHEN _turn > 0 THEN 2D / _turn END"))
    return scaled.withColumns({"down_x": F.expr(f"-_turn * ({x} * {z} - {w} * {y})"), "down_y": F.expr(f"-_turn * ({y} * {z} + {w} * {x})"),
                               "down_z": F.expr(f"_turn * ({x} * {x} + {y} * {y}) - 1D")}).drop("_turn")


def angle_to_down(quantity: str) -> Column:
    """Angle in degrees between a vector and the gravity that :func:`with_attitude_gravity` added."""
    a = [f"`{c}`" for c in VECTORS[quantity]]
    dot = " + ".join(f"{p} * down_{q}" for p, q in zip(a, "xyz", strict=True))
    size = f"sqrt({' + '.join(f'{p} * {p}' for p in a)}) * sqrt(down_x * down_x + down_y * down_y + down_z * down_z)"
    return F.expr(f"CASE WHEN {size} > 0 THEN degrees(acos(greatest(-1D, least(1D, ({dot}) / ({size}))))) END")


def angle_deg(a: Sequence[Column], b: Sequence[Column]) -> Column:
    """Angle between two vectors in degrees."""
    dot = reduce(add, [p * q for p, q in zip(a, b)])
    size = F.sqrt(reduce(add, [p * p for p in a])) * F.sqrt(reduce(add, [q * q for q in b]))
    return F.when(size > 0, F.degrees(F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), dot / size)))))
