"""Image geometry as column arithmetic, and suppression of overlapping boxes."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Overlap above which a box is suppressed, and least confidence of a detection.
MOST_OVERLAP = 0.45
LEAST_CONFIDENCE = 0.25
CANVAS = 640
#: Classes of the detection model that are animals, and the least side of a subject in pixels.
ANIMAL_CLASSES = (14, 15, 16, 17, 18, 19, 20, 21, 22, 23)
LEAST_SIDE = 10


def _box(left: Column, top: Column, width: Column, height: Column) -> Column:
    i = lambda c: c.cast("bigint")
    return F.struct(i(left).alias("left"), i(top).alias("top"), i(left + width).alias("right"), i(top + height).alias("bottom"))


def _half(c: Column) -> Column:
    return F.floor(c / 2)


def center_crop(w: Column, h: Column, ratio: float) -> Column:
    """The largest centred box of the ratio (width to height)."""
    wide = w / h > ratio
    cw, ch = F.floor(h * ratio), F.floor(w / ratio)
    return F.when(wide, _box(_half(w - cw), F.lit(0), cw, h)).otherwise(_box(F.lit(0), _half(h - ch), w, ch))


def anchor_crop(w: Column, h: Column, ratio: float, anchor: Column) -> Column:
    """The box at one of nine places (1 top left to 9 bottom right); the whole image if its ratio is right."""
    row, column = F.floor((anchor - 1) / 3), (anchor - 1) % 3
    cw, ch = F.floor(h * ratio), F.floor(w / ratio)
    place = lambda k, room: F.greatest(F.lit(0), F.when(k == 0, 0).when(k == 1, _half(room)).otherwise(room))
    whole = _box(F.lit(0), F.lit(0), w, h)
    wide = _box(place(column, w - cw), F.lit(0), cw, h)
    tall = _box(F.lit(0), place(row, h - ch), w, ch)
    return F.when(F.abs(w / h - ratio) < 0.01, whole).when(w / h > ratio, wide).otherwise(tall)


def subject_crop(w: Column, h: Column, ratio: float, x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """The box around a subject, its upper part if it is too tall; centred without a subject (nulls)."""
    cw, ch = F.floor(h * ratio), F.floor(w / ratio)
    clamp = lambda v, most: F.greatest(F.lit(0), F.least(v, most))
    toward_zero = lambda v: F.when(v >= 0, F.floor(v)).otherwise(F.ceil(v))
    left = clamp(toward_zero((x1 + x2) / 2 - cw / 2), w - cw)
    top = clamp(F.when(y2 - y1 > ch, toward_zero(y1)).otherwise(toward_zero((y1 + y2) / 2 - ch / 2)), h - ch)
    whole = _box(F.lit(0), F.lit(0), w, h)
    return (
        F.when(F.abs(w / h - ratio) < 0.01, whole).when(x1.isNull(), center_crop(w, h, ratio))
        .when(w / h > ratio, _box(left, F.lit(0), cw, h)).otherwise(_box(F.lit(0), top, w, ch))
    )


def letterbox(w: Column, h: Column, canvas: int = CANVAS) -> Column:
    """struct(scale, width, height, pad_x, pad_y) that fits an image into a square canvas."""
    scale = F.least(F.lit(float(canvas)) / w, F.lit(float(canvas)) / h)
    nw, nh = F.floor(w * scale).cast("bigint"), F.floor(h * scale).cast("bigint")
    return F.struct(scale.alias("scale"), nw.alias("width"), nh.alias("height"), _half(F.lit(canvas) - nw).alias("pad_x"), _half(F.lit(canvas) - nh).alias("pad_y"))


def kept_boxes(boxes: np.ndarray, scores: np.ndarray, most_overlap: float = MOST_OVERLAP) -> list[int]:
    """Indices of the boxes that no better kept box overlaps by more than `most_overlap`, best first."""
    left = list(np.lexsort((np.arange(len(scores)), -scores)))
    area = np.maximum(0, boxes[:, 2] - boxes[:, 0]) * np.maximum(0, boxes[:, 3] - boxes[:, 1]) if len(boxes) else np.zeros(0)
    kept: list[int] = []
    for i in left:
        b = boxes[i]
        over = False
        for k in kept:
            c = boxes[k]
            inter = max(0.0, min(b[2], c[2]) - max(b[0], c[0])) * max(0.0, min(b[3], c[3]) - max(b[1], c[1]))
            if inter / (area[i] + area[k] - inter + 1e-6) > most_overlap:
                over = True
                break
        if not over:
            kept.append(int(i))
    return kept


def suppress(df: DataFrame, image: str, box_id: str) -> DataFrame:
    """(image, box_id, rank): kept boxes of each image. A group is one image's boxes, at most thousands."""
    fields = {f.name: f.dataType.simpleString() for f in df.schema.fields}

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(box_id).reset_index(drop=True)
        keep = kept_boxes(pdf[["x1", "y1", "x2", "y2"]].to_numpy(float), pdf["score"].to_numpy(float))
        return pd.DataFrame({image: pdf[image].iloc[keep].to_numpy(), box_id: pdf[box_id].iloc[keep].to_numpy(), "rank": range(1, len(keep) + 1)})

    d = df.where(F.col("score") > LEAST_CONFIDENCE).select(image, box_id, "x1", "y1", "x2", "y2", "score")
    return d.groupBy(image).applyInPandas(run, f"{image} {fields[image]}, {box_id} {fields[box_id]}, rank bigint")


def subjects(detections: DataFrame, image: str, box_id: str) -> DataFrame:
    """(image, x1, y1, x2, y2): the subject of each image in its own pixels, no row where none is found.

    detections(image, box_id, x1, y1, x2, y2, score, class_id on the canvas; scale, pad_x, pad_y, w, h of the image), as
    `suppress` keeps them. Boxes of animal classes come before others, then the surest; a box is clamped to the
    image and dropped if a side is below LEAST_SIDE pixels. One aggregate an image, combined before the shuffle.
    """
    animal = F.col("class_id").isin(*ANIMAL_CLASSES)
    d = detections.where(F.col("score") > LEAST_CONFIDENCE)
    at = ["x1", "y1", "x2", "y2", "scale", "pad_x", "pad_y", "w", "h"]
    best = d.groupBy(image).agg(F.max_by(F.struct(*at), F.struct(animal.alias("a"), "score", -F.col(box_id))).alias("b")).select(image, "b.*")
    place = lambda c, pad, side: F.greatest(F.lit(0), F.least(((F.col(c) - F.col(pad)) / F.col("scale")).cast("bigint"), F.col(side).cast("bigint"))).alias(c)
    out = best.select(image, place("x1", "pad_x", "w"), place("y1", "pad_y", "h"), place("x2", "pad_x", "w"), place("y2", "pad_y", "h"))
    return out.where((F.col("x2") - F.col("x1") >= LEAST_SIDE) & (F.col("y2") - F.col("y1") >= LEAST_SIDE))
