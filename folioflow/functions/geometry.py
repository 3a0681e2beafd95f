"""Boxes: a struct x0, y0, x1, y1 in points, or in pixels with the raster's size."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BOX = "struct<x0:double,y0:double,x1:double,y1:double>"


def box(x0, y0, x1, y1) -> Column:
    f = lambda v, n: (v if isinstance(v, Column) else F.lit(v)).cast("double").alias(n)
    return F.struct(f(x0, "x0"), f(y0, "y0"), f(x1, "x1"), f(y1, "y1"))


def width(b: Column) -> Column:
    return b["x1"] - b["x0"]


def height(b: Column) -> Column:
    return b["y1"] - b["y0"]


def area(b: Column) -> Column:
    return width(b) * height(b)


def overlap(a: Column, b: Column) -> Column:
    """Intersection over the smaller area; 0 where either has none."""
    w = F.least(a["x1"], b["x1"]) - F.greatest(a["x0"], b["x0"])
    h = F.least(a["y1"], b["y1"]) - F.greatest(a["y0"], b["y0"])
    small = F.least(area(a), area(b))
    return F.when((w > 0) & (h > 0) & (small > 0), w * h / small).otherwise(0.0)


def centre_in(inner: Column, outer: Column) -> Column:
    cx, cy = (inner["x0"] + inner["x1"]) / 2, (inner["y0"] + inner["y1"]) / 2
    return (cx >= outer["x0"]) & (cx <= outer["x1"]) & (cy >= outer["y0"]) & (cy <= outer["y1"])


def pad_pixels(b: Column, pad: float, raster_w: Column, raster_h: Column) -> Column:
    return box(F.greatest(F.lit(0.0), b["x0"] - pad), F.greatest(F.lit(0.0), b["y0"] - pad), F.least(raster_w, b["x1"] + pad), F.least(raster_h, b["y1"] + pad))


def to_points(b: Column, raster_w: Column, raster_h: Column, page: Column) -> Column:
    """Pixels to points by the raster's actual size; the low corner is held from below, the high one from above.

    Null where nothing of the box is left on the page, for the caller to reject.
    """
    sx, sy = width(page) / raster_w, height(page) / raster_h
    x0, y0 = F.greatest(page["x0"], page["x0"] + b["x0"] * sx), F.greatest(page["y0"], page["y0"] + b["y0"] * sy)
    x1, y1 = F.least(page["x1"], page["x0"] + b["x1"] * sx), F.least(page["y1"], page["y0"] + b["y1"] * sy)
    return F.when((x0 < x1) & (y0 < y1), box(x0, y0, x1, y1))


def coverage(images: Column, page_area: Column, exact: bool = False) -> Column:
    """Share of the page under its largest image, to three places, or exactly."""
    top = F.array_max(F.transform(images, lambda b: area(b) / page_area))
    share = F.coalesce(top, F.lit(0.0))
    return F.when(page_area > 0, share if exact else F.bround(share, 3)).otherwise(0.0)


def text_share(blocks: Column, page_area: Column) -> Column:
    total = F.aggregate(blocks, F.lit(0.0), lambda n, b: n + F.greatest(F.lit(0.0), area(b)))
    return F.when(page_area > 0, F.bround(F.least(F.lit(1.0), total / page_area), 3)).otherwise(0.0)


def in_band(b: Column, page_height: Column, frac: float) -> Column:
    return (b["y0"] <= page_height * frac) | (b["y1"] >= page_height * (1 - frac))


def fills_page(b: Column, page_height: Column) -> Column:
    return (b["y0"] <= 1.0) & (b["y1"] >= page_height - 1.0)


def bucket(v: Column, step: int) -> Column:
    return F.bround(v / step).cast("long")
