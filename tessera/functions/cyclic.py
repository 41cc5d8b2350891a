"""Cyclic weekday encoding (day on the unit circle) and its inverse."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weekday names as they appear in the accident table's `Vkpv`
# column, Monday first (day number 1..7 = position in this list).
WEEKDAY_NAMES = ("Maanantai", "Tiistai", "Keskiviikko", "Torstai", "Perjantai", "Lauantai", "Sunnuntai")


def day_angle_point(day: int) -> tuple[float, float]:
    """Unit-circle point of day ``day`` (1..7): (cos 2πd/7, sin 2πd/7).

    Sunday (7) is the full turn; its sine is exactly 0, not the rounding
    residue of sin(2π).
    """
    angle = day * 2.0 * math.pi / 7
    return math.cos(angle), (0.0 if day == 7 else math.sin(angle))


# Computed once on the driver so every engine sees identical bits.
DAY_POINTS = tuple(day_angle_point(d) for d in range(1, 8))


def encode_day_number(day: Column | str) -> tuple[Column, Column]:
    """Day number 1..7 (Monday = 1) -> (dow_x, dow_y); anything else -> nulls."""
    d = F.col(day) if isinstance(day, str) else day
    xs = F.array(*[F.lit(p[0]) for p in DAY_POINTS])
    ys = F.array(*[F.lit(p[1]) for p in DAY_POINTS])
    valid = d.between(1, 7)
    return (F.when(valid, F.element_at(xs, d.cast("int"))),
            F.when(valid, F.element_at(ys, d.cast("int"))))


def day_number_of_name(name: Column | str) -> Column:
    """Weekday name -> day number 1..7; unknown or null -> null."""
    n = F.col(name) if isinstance(name, str) else name
    pos = F.array_position(F.array(*[F.lit(w) for w in WEEKDAY_NAMES]), n)
    return F.when(pos > 0, pos.cast("int"))


def decode_day(dow_x: Column | str, dow_y: Column | str) -> Column:
    """Inverse of the encoding: a = atan2(y, x)·7/2π, returned in (0, 7].

    Works on averaged (off-circle) points too, which is how a cluster's
    "typical weekday" is read. Null in -> null out.
    """
    x = F.col(dow_x) if isinstance(dow_x, str) else dow_x
    y = F.col(dow_y) if isinstance(dow_y, str) else dow_y
    a = F.atan2(y, x) * 7 / (2 * math.pi)
    return F.when(a > 0, a).otherwise(a + 7)


def weekday_number(ts: Column | str) -> Column:
    """Day number 1..7 (Monday = 1) of a date or timestamp column."""
    t = F.col(ts) if isinstance(ts, str) else ts
    return (F.weekday(t) + 1).cast("int")
