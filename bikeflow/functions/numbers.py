"""Rounding and pseudo-random draws that give the same value on every engine."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DRAW_SPACE = 4294967296.0


def ratio(num: Column, den: Column, digits: int, scale: int = 1) -> Column:
    """``round(scale * num / den, digits)``, half away from zero, on exact integers.

    Doubles round ties differently from decimals, so the quotient is never formed
    in floating point, and the product has 38 digits. ``den`` must be positive; a zero denominator gives null.
    """
    unit = 10**digits
    num = num.cast("decimal(38,0)")
    den = F.nullif(den.cast("bigint"), F.lit(0).cast("bigint")).cast("decimal(38,0)")
    whole = F.call_function(
        "div", F.lit(2 * unit * scale) * F.abs(num) + den, F.lit(2) * den
    )
    signed = F.when(num < 0, -whole).otherwise(whole)
    return signed.cast("double") / F.lit(float(unit))


def mean(column: Column, digits: int) -> Column:
    """Rounded average of an integer column, ignoring nulls."""
    return ratio(F.sum(column), F.count(column), digits)


def half_up(value: Column, digits: int = 0) -> Column:
    """Round a non-negative double half up, the rule of a numeric ``round``."""
    unit = float(10**digits)
    return F.floor(value * F.lit(unit) + F.lit(0.5)).cast("double") / F.lit(unit)


def unit_draw(*parts: Column | str) -> Column:
    """Deterministic uniform value in [0, 1) from the text of ``parts``.

    A task that is retried after an executor loss draws the same value again,
    which ``rand()`` does not promise once partition contents move.
    """
    columns = [F.col(p) if isinstance(p, str) else p for p in parts]
    text = F.concat_ws("|", *[c.cast("string") for c in columns])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(DRAW_SPACE)
