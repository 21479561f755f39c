"""Camera geometry of hand keypoints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MARGIN, MIN_SIDE, MIN_DEPTH, MIN_POINTS = 1.8, 96.0, 0.01, 4


def project(p: list[Column], head: list[Column], q: list[Column], k: list[list[float | Column]]) -> tuple[Column, Column, Column]:
    """(u, v, depth) of a world point seen by a camera at ``head`` with rotation q = (w, x, y, z):
    R'(p - head), then the 3x4 intrinsics and the homogeneous divide (null at depth 0)."""
    w, x, y, z = q
    d = [a - b for a, b in zip(p, head, strict=True)]
    r = [
        [1 - 2 * (y * y + z * z), 2 * (x * y - w * z), 2 * (x * z + w * y)],
        [2 * (x * y + w * z), 1 - 2 * (x * x + z * z), 2 * (y * z - w * x)],
        [2 * (x * z - w * y), 2 * (y * z + w * x), 1 - 2 * (x * x + y * y)],
    ]
    c = [r[0][i] * d[0] + r[1][i] * d[1] + r[2][i] * d[2] for i in range(3)]
    number = lambda x: x if isinstance(x, Column) else F.lit(float(x))
    image = [sum(number(row[i]) * c[i] for i in range(3)) + number(row[3]) for row in k]
    return F.try_divide(image[0], image[2]), F.try_divide(image[1], image[2]), c[2]


def hand_box(points: DataFrame, key: str, width: int | Column, height: int | Column, margin: float = MARGIN) -> DataFrame:
    """(key, left, top, right, bottom): a square with a margin around the visible points, shifted into
    the picture; no row for fewer than MIN_POINTS of them.

    Visible is what lies before the camera and no more than a picture's width beside the picture,
    however high or low; the square's centre is the points' mean."""
    size = {"u": width, "v": height}
    size = {c: (s if isinstance(s, Column) else F.lit(s)).cast("double") for c, s in size.items()}
    seen = points.withColumns({"__w": size["u"], "__h": size["v"]})
    seen = seen.where((F.col("depth") > MIN_DEPTH) & (F.col("u") > -F.col("__w")) & (F.col("u") < 2 * F.col("__w")))
    boxes = seen.groupBy(key).agg(
        F.count("*").alias("n"), F.max("__w").alias("w"), F.max("__h").alias("h"),
        *(f(c).alias(f"{n}_{c}") for c in "uv" for f, n in ((F.avg, "mid"), (F.min, "lo"), (F.max, "hi"))),
    )
    longest = F.greatest(F.col("hi_u") - F.col("lo_u"), F.col("hi_v") - F.col("lo_v")) * margin
    side = F.least(F.greatest(longest, F.lit(MIN_SIDE)), F.least("w", "h"))
    edge = lambda c, n: F.least(F.greatest(F.col(f"mid_{c}") - F.col("side") / 2, F.lit(0.0)), F.col(n) - F.col("side"))
    return (
        boxes.where(F.col("n") >= MIN_POINTS).withColumn("side", side)
        .withColumn("x", edge("u", "w")).withColumn("y", edge("v", "h"))
        .select(
            key, F.col("x").cast("long").alias("left"), F.col("y").cast("long").alias("top"),
            (F.col("x") + F.col("side")).cast("long").alias("right"), (F.col("y") + F.col("side")).cast("long").alias("bottom"),
        )
    )
