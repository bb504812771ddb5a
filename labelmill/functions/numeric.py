"""Tolerant comparison, bounds and small vector arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The tolerances the effect checks are stated in.
SIGNAL_TOLERANCE = 1e-6
READBACK_TOLERANCE = 1e-4
CONFIG_ABSOLUTE = 1e-6
CONFIG_RELATIVE = 1e-4


def clamp(value: Column, low: Column | float, high: Column | float) -> Column:
    low = low if isinstance(low, Column) else F.lit(float(low))
    high = high if isinstance(high, Column) else F.lit(float(high))
    return F.greatest(low, F.least(value, high))


def within(a: Column, b: Column, tolerance: Column | float) -> Column:
    return F.coalesce(F.abs(a - b) <= tolerance, F.lit(False))


def close_config(got: Column, want: Column) -> Column:
    """max(1e-6, 1e-4 |want|); text that is not a number is not close."""
    got, want = got.try_cast("double"), want.try_cast("double")
    return within(got, want, F.greatest(F.lit(CONFIG_ABSOLUTE), F.lit(CONFIG_RELATIVE) * F.abs(want)))


def close_reference(got: Column, want: Column) -> Column:
    """1e-4 max(1, |want|); text that is not a number is not close."""
    got, want = got.try_cast("double"), want.try_cast("double")
    return within(got, want, F.lit(READBACK_TOLERANCE) * F.greatest(F.lit(1.0), F.abs(want)))


def same_vector(got: Column, want: Column, tolerance: float = READBACK_TOLERANCE) -> Column:
    """Equal length and every component within the tolerance."""
    close = F.forall(F.zip_with(got, want, lambda g, w: within(g, w, tolerance)), lambda ok: ok)
    return F.coalesce((F.size(got) == F.size(want)) & close, F.lit(False))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cross(a: Column, b: Column) -> Column:
    def minor(i: int, j: int) -> Column:
        return F.get(a, i) * F.get(b, j) - F.get(a, j) * F.get(b, i)

    return F.array(minor(1, 2), minor(2, 0), minor(0, 1))


def normalised(a: Column) -> Column:
    length = norm(a)
    return F.transform(a, lambda v: v / length)


def diagonal_determinant(a: Column) -> Column:
    return F.aggregate(a, F.lit(1.0), lambda p, v: p * v)


def inverse_translation(a: Column) -> Column:
    return F.transform(a, lambda v: -v)


def argb32(red: Column, green: Column, blue: Column) -> Column:
    """Opaque 0xAARRGGBB from unit channels."""

    def byte(channel: Column) -> Column:
        return F.bround(channel * 255, 0).cast("bigint")

    packed = F.shiftleft(F.lit(255).cast("bigint"), 24)
    packed = packed.bitwiseOR(F.shiftleft(byte(red), 16))
    return packed.bitwiseOR(F.shiftleft(byte(green), 8)).bitwiseOR(byte(blue))
