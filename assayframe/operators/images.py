"""Crops of cells from tiles, and batched embedding of crops."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

SAMPLE = "well string, tile string, cell long, crop array<float>, mask array<tinyint>"


def join_cells(segments: DataFrame, reads: DataFrame, keys: list[str]) -> DataFrame:
    """Segments with their reads; a cell on one side only is an error."""
    marked = segments.withColumn("__s", F.lit(True)).join(reads.withColumn("__r", F.lit(True)), keys, "full_outer")
    lone = F.when(F.col("__s").isNull() | F.col("__r").isNull(), F.raise_error(F.concat(F.lit("a cell on one side only: "), F.concat_ws("/", *(F.col(k).cast("string") for k in keys)))))
    return marked.withColumn("__ok", F.coalesce(lone.cast("string"), F.lit(""))).where("__ok = ''").drop("__s", "__r", "__ok")


def zip_by_position(left: DataFrame, right: DataFrame, by: list[str], left_order: list[str], right_order: list[str]) -> DataFrame:
    """Rows of both sides of a tile joined by their place in it; unequal counts are an error."""
    mine = left.withColumn("__i", F.row_number().over(Window.partitionBy(*by).orderBy(*left_order))).withColumn("__l", F.lit(True))
    other = right.withColumn("__i", F.row_number().over(Window.partitionBy(*by).orderBy(*right_order))).withColumn("__o", F.lit(True))
    both = mine.join(other, [*by, "__i"], "full_outer")
    lone = F.when(F.col("__l").isNull() | F.col("__o").isNull(), F.raise_error(F.concat(F.lit("unequal numbers of rows in "), F.concat_ws("/", *(F.col(b).cast("string") for b in by)))))
    return both.withColumn("__ok", F.coalesce(lone.cast("string"), F.lit(""))).where("__ok = ''").drop("__i", "__l", "__o", "__ok")


def window(image: np.ndarray, labels: np.ndarray, box: tuple[float, float, float, float], own: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Square crop at a box's middle, zero beyond the edges, and the mask of the cell's own label."""
    top, left = int((box[0] + box[2]) // 2) - size // 2, int((box[1] + box[3]) // 2) - size // 2
    crop, mask = np.zeros((*image.shape[:-2], size, size), np.float32), np.zeros((size, size), np.int8)
    rows, cols = slice(max(0, top), min(image.shape[-2], top + size)), slice(max(0, left), min(image.shape[-1], left + size))
    if rows.start < rows.stop and cols.start < cols.stop:
        to = slice(rows.start - top, rows.stop - top), slice(cols.start - left, cols.stop - left)
        crop[..., to[0], to[1]] = image[..., rows, cols]
        mask[to] = labels[rows, cols] == own
    return crop, mask


def crops(tiles: DataFrame, cells: DataFrame, size: int) -> DataFrame:
    """A sample for each cell: tiles hold ``pixels, labels`` (flat), ``channels, height, width``; cells hold ``bbox_*`` and ``cell``.

    Boxes are gathered per tile first, so a tile's pixels are moved once.  An
    empty tile gives no sample; pixels that don't fit the shape are an error.
    """
    boxes = cells.groupBy("well", "tile").agg(F.collect_list(F.struct("cell", "bbox_x1", "bbox_y1", "bbox_x2", "bbox_y2")).alias("boxes"))
    rows = tiles.join(boxes, ["well", "tile"]).select("well", "tile", "pixels", "labels", "channels", "height", "width", "boxes")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples():
                image = np.asarray(r.pixels, np.float32).reshape(r.channels, r.height, r.width)
                labels = np.asarray(r.labels).reshape(r.height, r.width)
                out = []
                for b in r.boxes:
                    crop, mask = window(image, labels, (b["bbox_x1"], b["bbox_y1"], b["bbox_x2"], b["bbox_y2"]), b["cell"], size)
                    out.append((r.well, r.tile, b["cell"], crop.ravel(), mask.ravel()))
                yield pd.DataFrame(out, columns=["well", "tile", "cell", "crop", "mask"])

    return rows.mapInPandas(cut, SAMPLE)


def embed(samples: DataFrame, model: Callable[[], Callable[[np.ndarray], np.ndarray]], shape: list[int], width: int, batch: int = 64, crop: str = "crop") -> DataFrame:
    """``samples`` with ``embedding``; ``model`` makes the function from crops of ``shape`` to vectors once a worker."""
    infer = predict_batch_udf(model, return_type=T.ArrayType(T.FloatType()), batch_size=batch, input_tensor_shapes=[shape])
    return samples.withColumn("embedding", infer(crop))


def embedding_columns(df: DataFrame, vector: Column, width: int, meta: list[str]) -> DataFrame:
    """Metadata and ``emb_0000, emb_0001, ...``; typed also when there are no rows."""
    return df.select(*meta, *(F.get(vector, F.lit(i)).cast("double").alias(f"emb_{i:04d}") for i in range(width)))
