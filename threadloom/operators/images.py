"""Image augmentation: parameters in SQL, pixels in Arrow batches."""

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from threadloom.schemas import IMAGE

VARIANTS = ("bright", "contrast", "rotated", "flipped", "cropped")
FACTOR_RANGE = (0.5, 1.4)
ANGLE_RANGE = (-45.0, 45.0)
CROP_SHARE = 0.8


def _uniform(key: Column) -> Column:
    """A number in [0, 1) fixed by the key."""
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("double") / float(1 << 32)


def _drawn(aug: Column, seed) -> dict[str, Column]:
    """The parameters of one variant, NULL where it uses none."""

    def draw(what: str, lo, span) -> Column:
        key = F.concat_ws(":", F.col("origin"), aug, F.lit(what), F.lit(str(seed)))
        return _uniform(key) * span + lo

    def only(value: Column, *names: str) -> Column:
        return F.when(aug.isin(*names), value)

    side = F.floor(F.least("width", "height") * F.lit(CROP_SHARE)).cast("int")
    factor = F.round(draw("factor", FACTOR_RANGE[0], FACTOR_RANGE[1] - FACTOR_RANGE[0]), 6)
    angle = F.round(draw("angle", ANGLE_RANGE[0], ANGLE_RANGE[1] - ANGLE_RANGE[0]), 6)
    return {
        "factor": only(factor, "bright", "contrast"),
        "angle": only(angle, "rotated"),
        "size": only(side, "cropped"),
        "left": only(F.floor(draw("left", 0, F.col("width") - side + 1)).cast("int"), "cropped"),
        "top": only(F.floor(draw("top", 0, F.col("height") - side + 1)).cast("int"), "cropped"),
    }


def augment_params(images: DataFrame, seed) -> DataFrame:
    """One row per image and variant with the drawn parameters (NULL where unused)."""
    variants = F.array(*[F.lit(v) for v in VARIANTS])
    return images.withColumn("aug", F.explode(variants)).withColumns(_drawn(F.col("aug"), seed))


def _to_byte(values: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(values + 0.5), 0, 255).astype(np.uint8)


def _recolour(pixels: np.ndarray, change) -> np.ndarray:
    """Change the colour channels; a fourth one is transparency and stays."""
    out = pixels.copy()
    colours = slice(0, 3) if pixels.shape[2] == 4 else slice(None)
    out[..., colours] = change(pixels[..., colours])
    return out


def _bright(pixels: np.ndarray, factor: float) -> np.ndarray:
    return _to_byte(pixels.astype(float) * factor)


def _contrast(pixels: np.ndarray, factor: float) -> np.ndarray:
    bgr = pixels[..., :3] if pixels.shape[2] >= 3 else np.repeat(pixels[..., :1], 3, axis=2)
    luminance = bgr.astype(float) @ np.array([0.114, 0.587, 0.299])
    middle = np.floor(luminance.mean() + 0.5)
    return _to_byte(middle + factor * (pixels.astype(float) - middle))


def _rotate(pixels: np.ndarray, angle: float) -> np.ndarray:
    """Counter-clockwise, canvas grown to the bounding box, nearest source pixel, black fill."""
    h, w, channels = pixels.shape
    cos, sin = np.cos(np.radians(angle)), np.sin(np.radians(angle))
    new_w = int(np.ceil(round(abs(w * cos) + abs(h * sin), 6)))
    new_h = int(np.ceil(round(abs(w * sin) + abs(h * cos), 6)))
    y, x = np.mgrid[0:new_h, 0:new_w]
    dx, dy = x + 0.5 - new_w / 2, y + 0.5 - new_h / 2
    sx = np.floor(np.round(cos * dx - sin * dy + w / 2, 6)).astype(int)
    sy = np.floor(np.round(sin * dx + cos * dy + h / 2, 6)).astype(int)
    inside = (sx >= 0) & (sx < w) & (sy >= 0) & (sy < h)
    out = np.zeros((new_h, new_w, channels), dtype=np.uint8)
    out[inside] = pixels[sy[inside], sx[inside]]
    return out


def _crop(pixels: np.ndarray, left: int, top: int, size: int) -> np.ndarray:
    """Cut a square and stretch it back to the full size, nearest source pixel."""
    h, w, _ = pixels.shape
    rows = top + (np.arange(h) * size) // h
    cols = left + (np.arange(w) * size) // w
    return pixels[rows][:, cols]


def _variant(pixels: np.ndarray, plan: dict) -> np.ndarray:
    match plan["aug"]:
        case "bright":
            return _recolour(pixels, lambda p: _bright(p, plan["factor"]))
        case "contrast":
            return _recolour(pixels, lambda p: _contrast(p, plan["factor"]))
        case "flipped":
            return pixels[:, ::-1]
        case "rotated":
            return _rotate(pixels, plan["angle"])
        case "cropped":
            return _crop(pixels, int(plan["left"]), int(plan["top"]), int(plan["size"]))
    return pixels


def augment_images(images: DataFrame, seed) -> DataFrame:
    """The original and five variants per image, with the parameters used.

    Pixels travel to Python once per image, next to its five sets of parameters; a batch of
    results holds the variants of one image.
    """
    typed = images.select(*IMAGE.fieldNames())
    shape = augment_params(typed, seed).schema
    added = [f.name for f in shape.fields if f.name not in IMAGE.fieldNames()]
    plans = F.array(
        *[
            F.struct(F.lit(v).alias("aug"), *[c.alias(n) for n, c in _drawn(F.lit(v), seed).items()])
            for v in VARIANTS
        ]
    )
    unused = [F.lit(None).cast(shape[c].dataType).alias(c) for c in added[1:]]
    original = typed.select("*", F.lit("original").alias("aug"), *unused)

    def run(batches):
        for batch in batches:
            for row in batch.itertuples(index=False):
                pixels = np.frombuffer(row.data, dtype=np.uint8).reshape(row.height, row.width, row.nChannels)
                out = []
                for plan in row.plans:
                    changed = _variant(pixels, plan)
                    fixed = {"height": changed.shape[0], "width": changed.shape[1], "data": changed.tobytes()}
                    out.append({**row._asdict(), **plan, **fixed})
                table = pd.DataFrame(out).drop(columns="plans")
                yield table.astype({"size": "Int32", "left": "Int32", "top": "Int32", "factor": float, "angle": float})

    drawn = typed.withColumn("plans", plans).mapInPandas(run, T.StructType(shape.fields))
    return drawn.unionByName(original)
