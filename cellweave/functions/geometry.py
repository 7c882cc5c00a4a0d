"""Shapes and curves as Column expressions. A ring is an array of structs x, y; it closes itself."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def ring_of(points: list[tuple[float, float]]) -> Column:
    """A ring from given points."""
    return F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in points])


def edges(ring: Column) -> Column:
    """Each vertex with the one before it."""
    before = F.concat(F.slice(ring, F.size(ring), 1), F.slice(ring, 1, F.size(ring) - 1))
    return F.zip_with(ring, before, lambda a, b: F.struct(a.x.alias("xi"), a.y.alias("yi"), b.x.alias("xj"), b.y.alias("yj")))


def crossed_oddly(x: Column, y: Column, some: Column) -> Column:
    """Whether a ray to the right crosses an odd number of edges."""

    def crosses(e: Column) -> Column:
        return ((e.yi > y) != (e.yj > y)) & (x < (e.xj - e.xi) * (y - e.yi) / (e.yj - e.yi) + e.xi)

    return F.size(F.filter(some, crosses)) % 2 == 1


def in_ring(x: Column, y: Column, ring: Column) -> Column:
    """Even-odd rule; a lower or left edge belongs to the ring, an upper or right one doesn't."""
    return crossed_oddly(x, y, edges(ring))


def in_any_ring(x: Column, y: Column, rings: Column) -> Column:
    """Inside one ring of three vertices or more; a hole's ring counts like any other."""
    return F.exists(rings, lambda r: (F.size(r) >= 3) & in_ring(x, y, r))


def turned_about(x: Column, y: Column, cx: float, cy: float, rotation: float) -> tuple[Column, Column]:
    """The point as seen by a shape that is turned by `rotation` radians about (cx, cy)."""
    if not rotation:
        return x, y
    c, s = math.cos(rotation), math.sin(rotation)
    return (x - cx) * c + (y - cy) * s + cx, (y - cy) * c - (x - cx) * s + cy


def in_rectangle(x: Column, y: Column, a: tuple[float, float], b: tuple[float, float], rotation: float = 0.0) -> Column:
    """Between two corners in any order, edges included."""
    x, y = turned_about(x, y, (a[0] + b[0]) / 2, (a[1] + b[1]) / 2, rotation)
    return x.between(min(a[0], b[0]), max(a[0], b[0])) & y.between(min(a[1], b[1]), max(a[1], b[1]))


def in_ellipse(x: Column, y: Column, centre: tuple[float, float], edge: tuple[float, float], third: tuple[float, float] | None = None, rotation: float = 0.0) -> Column:
    """Radius along x from an edge point, along y from a third point, else the same; the edge included. Both must be above 0."""
    rx = abs(edge[0] - centre[0])
    ry = abs(third[1] - centre[1]) if third else rx
    if rx <= 0 or ry <= 0:
        return F.lit(False)
    x, y = turned_about(x, y, *centre, rotation)
    dx, dy = (x - centre[0]) / rx, (y - centre[1]) / ry
    return dx * dx + dy * dy <= 1


def moved(ring: Column, dx: Column, dy: Column) -> Column:
    return F.transform(ring, lambda v: F.struct((v.x + dx).alias("x"), (v.y + dy).alias("y")))


def bezier(t: Column, p: list[tuple[float, float]], axis: int) -> Column:
    """A point of the cubic curve through p[0] and p[3] with control points p[1] and p[2]."""
    u = 1 - t
    return u * u * u * p[0][axis] + 3 * u * u * t * p[1][axis] + 3 * u * t * t * p[2][axis] + t * t * t * p[3][axis]


def bezier_slope(t: Column, p: list[tuple[float, float]], axis: int) -> Column:
    u = 1 - t
    return 3 * u * u * (p[1][axis] - p[0][axis]) + 6 * u * t * (p[2][axis] - p[1][axis]) + 3 * t * t * (p[3][axis] - p[2][axis])


def width_at(t: Column, start: float, middle: float, end: float) -> Column:
    """The parabola through the widths at 0, 1/2 and 1."""
    return start * 2 * (t - 0.5) * (t - 1) - middle * 4 * t * (t - 1) + end * 2 * t * (t - 0.5)
