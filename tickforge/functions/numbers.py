"""Rounding as the wire format defines it."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def round_exact(x: Column, places: int) -> Column:
    """The decimal nearest to the binary value, ties to even.

    ``F.round`` and ``F.bround`` work on the shortest decimal text of a double, so they
    differ from this near ties (2.675, 0.15625).  Here ``x * 10^places`` is rounded; only
    if that product lands exactly on a half can its own rounding error decide.  Then the
    error is recovered exactly from two short factors (the float part of ``x`` and the
    rest), and its sign moves the product off the half.
    """
    scale = F.lit(10.0 ** places)
    product = x * scale
    high = x.cast("float").cast("double")
    error = (high * scale - product) + (x - high) * scale
    on_half = F.abs(product % F.lit(1.0)) == 0.5
    return F.rint(F.when(on_half, product + F.signum(error) * 0.25).otherwise(product)) / scale
