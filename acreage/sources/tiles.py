"""Raster tiles held as rows of raw bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acreage.contracts import require_columns

# Pixels worked on at a time, so that a batch of large strips does not fill a worker's memory.
CHUNK_PIXELS = 1 << 21


def split_strips(tiles: DataFrame, rows: int) -> DataFrame:
    """Cut (tile_id, width, height, data) into strips of ``rows`` pixel rows, JVM-side.

    Strips are the unit of parallel work and of pruning: a tile of any size
    becomes many rows, and ``row0`` with the strip height bounds its extent.
    """
    require_columns(tiles, ["tile_id", "width", "height", "data"], "tiles")
    starts = tiles.withColumn("row0", F.explode(F.sequence(F.lit(0), F.col("height") - 1, F.lit(rows))))
    take = F.least(F.lit(rows), F.col("height") - F.col("row0"))
    piece = F.substring(F.col("data"), (F.col("row0") * F.col("width") + 1).cast("int"), (take * F.col("width")).cast("int"))
    return starts.select("tile_id", "row0", "width", take.alias("rows"), piece.alias("data"))


def strips_in_window(strips: DataFrame, first_row: int, last_row: int) -> DataFrame:
    """Strips that meet a window of pixel rows."""
    return strips.filter((F.col("row0") <= last_row) & (F.col("row0") + F.col("rows") > first_row))


def pixel_chunks(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(tile, px, py, code) arrays of the strips of a batch, about CHUNK_PIXELS pixels at a time.

    The strips' bytes lie behind one another in the Arrow buffer, so a chunk is
    a slice of it and nothing is copied per strip; a long strip is cut too.
    """
    data = batch.column("data")
    # Sessions may use Arrow's large types, whose offsets are twice as wide.
    kind = np.int64 if pa.types.is_large_binary(data.type) else np.int32
    ends = np.frombuffer(data.buffers()[1], dtype=kind)[data.offset : data.offset + len(data) + 1].astype(np.int64)
    if ends[-1] == ends[0]:
        return
    raw = np.frombuffer(data.buffers()[2], dtype=np.uint8)
    tile, row0, width = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("tile_id", "row0", "width"))
    for start in range(int(ends[0]), int(ends[-1]), CHUNK_PIXELS):
        code = raw[start : min(start + CHUNK_PIXELS, int(ends[-1]))]
        place = np.arange(start, start + code.size, dtype=np.int64)
        strip = np.searchsorted(ends, place, side="right") - 1
        spot = place - ends[strip]
        yield tile[strip], spot % width[strip], spot // width[strip] + row0[strip], code


def slim_strips(strips: DataFrame) -> DataFrame:
    require_columns(strips, ["tile_id", "row0", "width", "data"], "strips")
    whole = strips.filter(F.col("data").isNotNull())
    return whole.select(*[F.col(c).cast("bigint") for c in ("tile_id", "row0", "width")], "data")


def decode_pixels(strips: DataFrame, nodata: int | None = 255) -> DataFrame:
    """(tile_id, px, py, code) of uint8 strips; nodata pixels are dropped where they are decoded."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tile, px, py, code in pixel_chunks(batch):
                kept = slice(None) if nodata is None else code != nodata
                yield pa.RecordBatch.from_pydict(
                    {
                        "tile_id": pa.array(tile[kept], pa.int64()),
                        "px": pa.array(px[kept], pa.int64()),
                        "py": pa.array(py[kept], pa.int64()),
                        "code": pa.array(code[kept].astype(np.int32), pa.int32()),
                    }
                )

    return slim_strips(strips).mapInArrow(decode, "tile_id bigint, px bigint, py bigint, code int")


def with_map_position(pixels: DataFrame, origin_x: float | Column, origin_y: float | Column, pixel: float) -> DataFrame:
    """Map coordinates of pixel centres; rows run southwards from the origin."""
    ox = origin_x if isinstance(origin_x, Column) else F.lit(origin_x)
    oy = origin_y if isinstance(origin_y, Column) else F.lit(origin_y)
    return pixels.withColumns({"x": ox + (F.col("px") + 0.5) * pixel, "y": oy - (F.col("py") + 0.5) * pixel})
