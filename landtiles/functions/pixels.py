"""Numpy helpers that work on whole Arrow batches of image tiles inside a task."""

from functools import lru_cache

import numpy as np
import pyarrow as pa

from landtiles.fixed import COLOUR_RADIUS, CROP_RATIO

FEW_LINES = 16  # tiles of so few lines are stretched by one product of matrices


def stacks(batch: pa.RecordBatch):
    """Yield (row numbers, uint8 array n x height x width x 3) per tile shape in a batch.

    The batch has the fields of an image in columns with a leading underscore.

    Channel order stays blue, green, red. Grey tiles are repeated to three channels and
    an alpha channel is left out.
    """
    shapes = np.stack(
        [batch.column(c).to_numpy() for c in ("_height", "_width", "_nChannels")], axis=1
    )
    kinds, kind_of_row = np.unique(shapes, axis=0, return_inverse=True)
    data = batch.column("_data")
    for kind, (height, width, channels) in enumerate(kinds):
        rows = np.flatnonzero(kind_of_row.ravel() == kind)
        raw = b"".join(data.take(pa.array(rows)).to_pylist())
        tiles = np.frombuffer(raw, np.uint8).reshape(len(rows), height, width, channels)
        yield rows, np.repeat(tiles, 3, axis=3) if channels == 1 else tiles[..., :3]


def crop_side(height: int, width: int) -> int:
    return max(1, int(np.floor(CROP_RATIO * min(height, width) + 0.5)))


def crop(tiles: np.ndarray, draws: np.ndarray) -> np.ndarray:
    """Square piece of each tile; its corner follows from two draws in [0, 1) per tile."""
    n, height, width, _ = tiles.shape
    side = crop_side(height, width)
    top = np.floor(draws[:, 0] * (height - side + 1)).astype(int)
    left = np.floor(draws[:, 1] * (width - side + 1)).astype(int)
    steps = np.arange(side)
    return tiles[
        np.arange(n)[:, None, None],
        (top[:, None] + steps)[:, :, None],
        (left[:, None] + steps)[:, None, :],
    ]


def unroll(tiles: np.ndarray) -> np.ndarray:
    """n x height x width x channel to floats in n x channel x height x width."""
    return np.ascontiguousarray(tiles.transpose(0, 3, 1, 2), dtype=np.float32)


@lru_cache(maxsize=1024)
def sources(size: int, side: int) -> tuple[np.ndarray, np.ndarray]:
    """The line that each of ``side`` new lines starts from, and the weight of the line after it."""
    at = np.clip((np.arange(side) + 0.5) * size / side - 0.5, 0, size - 1)
    low = np.floor(at).astype(int)
    return low, (at - low).astype(np.float32)


@lru_cache(maxsize=16)
def stretch(size: int, side: int) -> np.ndarray:
    """The matrix that makes ``side`` lines of ``size`` lines and their steps to the next, one below the other."""
    low, weight = sources(size, side)
    made = np.zeros((side, 2 * size), np.float32)
    made[np.arange(side), low] = 1
    made[np.arange(side), size + low] = weight
    return made


def resize(unrolled: np.ndarray, side: int) -> np.ndarray:
    """Linear interpolation to side x side, pixel centres aligned, edges repeated.

    Columns go first, so that the large step copies whole lines.
    """
    for axis in (3, 2):
        size = unrolled.shape[axis]
        if size == side:
            continue
        last = unrolled.take([size - 1], axis)
        steps = np.diff(unrolled, axis=axis, append=last)
        if axis == 2 and size <= FEW_LINES:
            unrolled = stretch(size, side) @ np.concatenate([unrolled, steps], axis=axis)
            continue
        low, weight = sources(size, side)
        stretched = steps.take(low, axis)
        stretched *= weight.reshape((-1, 1) if axis == 2 else -1)
        stretched += unrolled.take(low, axis)
        unrolled = stretched
    return unrolled


def jitter(unrolled: np.ndarray, draws: np.ndarray) -> np.ndarray:
    """Change brightness, contrast and saturation of each tile by three draws in [0, 1)."""
    return np.clip(recolour(unrolled, draws, unrolled.mean(axis=(1, 2, 3), keepdims=True)), 0, 255)


@lru_cache(maxsize=1024)
def line_shares(size: int, side: int) -> np.ndarray:
    """How much of ``side`` new lines comes from each of ``size`` lines."""
    low, weight = sources(size, side)
    above = np.minimum(low + 1, size - 1)
    return (np.bincount(low, 1 - weight, size) + np.bincount(above, weight, size)) / side


def jitter_resized(unrolled: np.ndarray, draws: np.ndarray, side: int) -> np.ndarray:
    """``jitter`` of the tiles resized to ``side``.

    Interpolation keeps sums of channels and shares, so colours are changed on the few pixels there are before it.
    """
    shares = [line_shares(size, side) for size in unrolled.shape[2:]]
    mean = np.einsum("nchw,h,w->n", unrolled, *shares) / unrolled.shape[1]
    changed = resize(recolour(unrolled, draws, mean.astype(np.float32).reshape(-1, 1, 1, 1)), side)
    return np.clip(changed, 0, 255, out=changed)


def recolour(unrolled: np.ndarray, draws: np.ndarray, mean: np.ndarray) -> np.ndarray:
    """Tiles whose mean is known with other brightness, contrast and saturation, not yet clipped."""
    shift = ((2 * draws - 1) * COLOUR_RADIUS).astype(np.float32)
    brightness, contrast, saturation = (shift[:, i].reshape(-1, 1, 1, 1) for i in range(3))
    changed = (unrolled - mean) * (1 + contrast) + mean * (1 + brightness)
    grey = changed.mean(axis=1, keepdims=True)
    return grey + (changed - grey) * (1 + saturation)
