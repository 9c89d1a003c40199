"""A small network file: channel means (output ``z.x``) and a linear layer (output ``scores``)."""

import numpy as np
from pyarrow import fs
from pyspark.sql import SparkSession

from landtiles.session import scratch_path

# Six classes; whole numbers keep all sums exact.
WEIGHTS = np.array([[1, -1, 2, 0, 1, -2], [0, 2, -1, 1, -2, 1], [-1, 0, 1, 2, 1, -1]], np.float32)
BIAS = np.array([3, -2, 0, 1, 5, -4], np.float32)


def _varint(n: int) -> bytes:
    out = b""
    while n > 127:
        out += bytes([n & 127 | 128])
        n >>= 7
    return out + bytes([n])


def _field(number: int, value) -> bytes:
    """One protobuf field: an int as varint, all others length-delimited."""
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value)
    data = value.encode() if isinstance(value, str) else value
    return _varint(number << 3 | 2) + _varint(len(data)) + data


def _tensor(name: str, values: np.ndarray) -> bytes:
    dims = b"".join(_field(1, d) for d in values.shape)
    return dims + _field(2, 1) + _field(8, name) + _field(9, values.astype("<f4").tobytes())


def _value(name: str, dims: list) -> bytes:
    shape = b"".join(_field(1, _field(1, d) if isinstance(d, int) else _field(2, d)) for d in dims)
    return _field(1, name) + _field(2, _field(1, _field(1, 1) + _field(2, shape)))


def _node(kind: str, inputs: list[str], output: str) -> bytes:
    return b"".join(_field(1, i) for i in inputs) + _field(2, output) + _field(4, kind)


def network_bytes(side: int, batch="n", weights: np.ndarray = WEIGHTS) -> bytes:
    graph = (
        _field(1, _node("GlobalAveragePool", ["x"], "pooled"))
        + _field(1, _node("Flatten", ["pooled"], "z.x"))
        + _field(1, _node("Gemm", ["z.x", "W", "b"], "scores"))
        + _field(2, "means")
        + _field(5, _tensor("W", weights))
        + _field(5, _tensor("b", BIAS))
        + _field(11, _value("x", [batch, 3, side, side]))
        + _field(12, _value("scores", [batch, WEIGHTS.shape[1]]))
        + _field(12, _value("z.x", [batch, 3]))
    )
    return _field(1, 8) + _field(7, graph) + _field(8, _field(1, "") + _field(2, 13))


def network_file(spark: SparkSession, name: str, side: int = 8, batch="n", folder: str | None = None) -> str:
    folder = folder or scratch_path(spark, "network")
    target, base = fs.FileSystem.from_uri(folder)
    target.create_dir(base, recursive=True)
    with target.open_output_stream(f"{base}/{name}") as out:
        out.write(network_bytes(side, batch))
    return f"{folder}/{name}"
