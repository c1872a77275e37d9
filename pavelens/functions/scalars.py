"""Column functions: missing values, rounding, ids, tiles, time, camera geometry."""

from __future__ import annotations

import math
import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def nan_to_null(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def max_known(*cs: Column) -> Column:
    """The largest; null as soon as one is null (greatest would skip it)."""
    known = cs[0].isNotNull()
    for c in cs[1:]:
        known = known & c.isNotNull()
    return F.when(known, F.greatest(*cs))


def round_half_up(c: Column, digits: int = 2) -> Column:
    """floor(x · 10^d + 0.5) / 10^d: the same numbers in every engine."""
    return F.floor(c * F.lit(10.0**digits) + F.lit(0.5)).cast("double") / F.lit(10.0**digits)


def round_exact(c: Column, digits: int = 2) -> Column:
    """Rounded as Python rounds a float: to the nearest decimal of the binary value, ties to the even digit. digits: 0 to 6.

    x lies between k / 10^d and (k + 1) / 10^d; which is nearer is told by the sign of 2 x 10^d - (2 k + 1), taken without
    error: the product's rounding error is exact once x is split into two halves of 26 bits. Beyond 2^40 x stays as it is.
    """
    scale = F.lit(10.0**digits)
    twice = F.lit(2 * 10.0**digits)
    x = c.cast("double")
    k = F.floor(x * scale).cast("double")
    high = x * F.lit(134217729.0) - (x * F.lit(134217729.0) - x)
    product = x * twice
    error = (twice * high - product) + twice * (x - high)
    above = (product - (F.lit(2.0) * k + F.lit(1.0))) + error
    up = (above > 0) | ((above == 0) & (F.pmod(k, F.lit(2.0)) == 1))
    return F.when(F.isnan(x) | (F.abs(x) > F.lit(2.0**40)), x).otherwise((k + F.when(up, 1.0).otherwise(0.0)) / scale)


def tile_id(name: Column, delimiter: str = "_") -> Column:
    """The first <digits><delimiter><digits> in a file name, null if there is none."""
    found = F.regexp_extract(name, f"([0-9]+{re.escape(delimiter)}[0-9]+)", 1)
    return F.when(found != "", found)


def tile_corner(tile: Column, delimiter: str = "_", size: int = 1) -> tuple[Column, Column]:
    """Lower left corner of a tile; size other than 1 where ids number the tiles."""
    parts = F.split(tile, re.escape(delimiter))
    return tuple(F.get(parts, F.lit(i)).try_cast("bigint") * size for i in (0, 1))


def base_number(text: Column, base: int = 36) -> Column:
    """An id written in another base as a whole number."""
    return F.conv(F.upper(text), base, 10).try_cast("decimal(20,0)")


def to_base(number: Column, base: int = 36) -> Column:
    return F.conv(number.cast("string"), 10, base)


def gps_seconds(instant: Column) -> Column:
    """Adjusted standard GPS time of a UTC timestamp without leap seconds: Unix seconds - 1315964800."""
    return F.unix_micros(instant) / F.lit(1e6) - F.lit(1315964800.0)


def utc_micros(gps: Column) -> Column:
    """UTC microseconds of adjusted standard GPS seconds."""
    return F.round(gps * 1e6).cast("bigint") + F.lit(1_315_964_800_000_000)


def image_folder(image_id: Column, letters: int = 6) -> Column:
    """The sub-directory of an image: the first letters of its id."""
    return F.substring(image_id, 1, letters)


def intensity_byte(intensity: Column) -> Column:
    """16-bit intensities as 0 to 255; values outside of 16 bits are cut to them."""
    return F.floor(F.least(F.greatest(intensity, F.lit(0)), F.lit(65_535)) / 256).cast("int")


def height_code(z: Column, lowest: Column, span: float = 100.0) -> Column:
    """A height as 0 to 65,535 over `span` metres from the lowest one up; heights beyond are cut to the ends."""
    return F.floor(F.least(F.greatest((z - lowest) / span, F.lit(0.0)), F.lit(1.0)) * 65_535).cast("int")


def in_range(x: Column, low: Column | float | None, high: Column | float | None) -> Column:
    """Inclusive at both ends; an open end is None."""
    ok = F.lit(True)
    if low is not None:
        ok = ok & (x >= low)
    if high is not None:
        ok = ok & (x <= high)
    return ok & x.isNotNull()


def within(*ranges: slice) -> Column:
    """Rows of x, y and, with three ranges, z inside of all ranges, both ends included; open ends are None: within(slice(0, 5), slice(None, 9))."""
    if len(ranges) not in (2, 3):
        raise ValueError("two or three ranges are needed")
    if not all(isinstance(r, slice) and r.step is None for r in ranges):
        raise ValueError("ranges are slices without a step")
    out = F.lit(True)
    for c, r in zip("xyz", ranges):
        out = out & in_range(F.col(c), r.start, r.stop)
    return out


def boxes_overlap(ax0, ay0, ax1, ay1, bx0, by0, bx1, by1) -> Column:
    """Whether two boxes touch or overlap."""
    return (ax0 <= bx1) & (ax1 >= bx0) & (ay0 <= by1) & (ay1 >= by0)


def convergence(lon: Column, lat: Column, meridian: float = 9.0) -> Column:
    """Meridian convergence in radians at longitude and latitude in degrees."""
    return F.atan(F.tan(F.radians(lon - meridian)) * F.sin(F.radians(lat)))


def rotated(dx: Column, dy: Column, dz: Column, matrix: Column) -> tuple[Column, Column, Column]:
    """The row vector (dx, dy, dz) times a row-major 3 × 3 matrix."""
    m = lambda i, k: F.element_at(matrix, 3 * i + k + 1)
    return tuple(dx * m(0, k) + dy * m(1, k) + dz * m(2, k) for k in range(3))


def panorama_pixel(dx: Column, dy: Column, dz: Column, turn: Column, width: int, height: int, inverse_rotation: Column | None = None) -> tuple[Column, Column]:
    """(column, row) of an equirectangular panorama that sees the direction (dx, dy, dz), cut to whole pixels; north is in the middle.

    turn: radians added to the azimuth, as the convergence of the grid. inverse_rotation: of the panorama in the world, row-major.
    """
    if inverse_rotation is not None:
        dx, dy, dz = rotated(dx, dy, dz, inverse_rotation)
    azimuth = F.atan2(dx, dy) + F.lit(math.pi) + turn
    zenith = F.atan2(F.sqrt(dx * dx + dy * dy), dz)
    cut = lambda v: v.cast("bigint")  # towards zero
    return F.pmod(cut(azimuth / (2 * math.pi) * width), F.lit(width)).cast("int"), cut(zenith / math.pi * height).cast("int")


def rotation_zxy(yaw: Column, pitch: Column, roll: Column) -> Column:
    """Row-major 3 × 3 matrix of the intrinsic rotations about z, x and y, angles in degrees."""
    a, b, c = F.radians(yaw), F.radians(pitch), F.radians(roll)
    sa, ca, sb, cb, sc, cc = F.sin(a), F.cos(a), F.sin(b), F.cos(b), F.sin(c), F.cos(c)
    return F.array(
        ca * cc - sa * sb * sc, -sa * cb, ca * sc + sa * sb * cc,
        sa * cc + ca * sb * sc, ca * cb, sa * sc - ca * sb * cc,
        -cb * sc, sb, cb * cc,
    )


def ring_area(ring: Column) -> Column:
    """Shoelace area of a closed ring given as array<struct<x, y>>."""
    at = F.sequence(F.lit(1), F.size(ring) - 1)
    twice = F.aggregate(at, F.lit(0.0), lambda s, i: s + F.element_at(ring, i)["x"] * F.element_at(ring, i + 1)["y"] - F.element_at(ring, i + 1)["x"] * F.element_at(ring, i)["y"])
    return F.when(F.size(ring) > 2, F.abs(twice) / 2).otherwise(F.lit(0.0))
