"""Sampled SentencePiece segmentation by forward filtering and backward sampling, and lossless decoding.

The lattice of a text has an edge for every piece that matches its bytes, and for characters that are no
piece one for each byte, so each text has a path. The forward pass sums path probabilities up to each byte; the backward pass draws an edge at a
time from the end, with random numbers that are a hash of row key, place and step. The same row is cut the same way
in every run and layout.

No piece has a blank after another character, so the lattice falls apart before each blank that follows a
non-blank, and at line feeds. Such segments repeat; their lattices are built once per run of texts. Segments are told
apart, and pieces found, by hashes whose hits are compared by content, so strings made to collide change nothing.
The blank sign of the pieces stands for the plain blank only; the sign itself, if a text has it, is written in
byte pieces. Decoding joins the bytes of the pieces and gives the text back unchanged.

A merge model states ranks, not probabilities, so a piece of rank r is taken to have the Zipf weight 1 / (r + 10).
Null and empty texts have no pieces and decode to the empty text. Rows without an id share the key of id -1.
Repeated rows are cut alike. Other columns are not read.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landtiles.llm.spans import Lookup, Texts, chunks, mixed, owners, paired

MODEL = public_tokenizers.path("piece_bpe_32k.model")
BLANK_SIGN = "▁"
RANK_SHIFT = 10.0
BYTE_PENALTY = 12.0  # nats that a byte piece costs above the rarest piece
SEED = 0
CHARACTER_SIZE = np.select([np.arange(256) < 0x80, np.arange(256) < 0xE0, np.arange(256) < 0xF0], [1, 2, 3], 4)
_models = {}


@dataclass
class Pieces:
    """Byte strings of all pieces, the log weight of each, and tables by length to find them.

    A piece of up to 8 bytes is found by its bytes as one number. Longer ones are looked for only where the first 8
    bytes of one stand.
    """

    strings: list[bytes]
    log_weight: np.ndarray
    byte_ids: np.ndarray  # piece of each of the 256 bytes
    by_length: dict[int, tuple[Lookup, np.ndarray]]
    leads: Lookup  # the first 8 bytes of the pieces that are longer
    data: np.ndarray
    eights: np.ndarray  # the 8 bytes from each place of the data on
    bounds: np.ndarray


def eights(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place on as one number, zeros after the end."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))


def leading(numbers: np.ndarray, length: int) -> np.ndarray:
    """Of the 8 bytes of each number, the first ``length``."""
    return numbers & np.uint64((1 << 8 * length) - 1) if length < 8 else numbers


def folded(at: np.ndarray, numbers: np.ndarray, length: int) -> np.ndarray:
    """A key of the ``length`` bytes, over 8 of them, from each place of ``eights``; others may have it, too."""
    key = numbers[at]
    for step in range(8, length, 8):
        key = paired(key, leading(numbers[at + step], length - step), 4)
    return key


def same_bytes(one: np.ndarray, at: np.ndarray, other: np.ndarray, start: np.ndarray, length: int) -> np.ndarray:
    """Whether ``length`` bytes from each place ``at`` equal those from ``start``; both as ``eights``."""
    equal = np.ones(len(at), bool)
    for step in range(0, length, 8):
        equal &= leading(one[at + step] ^ other[start + step], length - step) == 0
    return equal


def kinds_of(texts: Texts, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One span of each content, and for each span the number of its content."""
    _, first, kind = np.unique(texts.hashes(start, end), return_index=True, return_inverse=True)
    size = end - start
    if (size == size[first][kind]).all() and texts.same(start, end, start[first][kind]):
        return first, kind
    body, numbers = texts.data.tobytes(), {}
    kind = np.array([numbers.setdefault(body[a:b], len(numbers)) for a, b in zip(start.tolist(), end.tolist())], np.int64)
    return np.unique(kind, return_index=True)[1], kind


def make_pieces(strings: list[bytes], log_weight: np.ndarray, byte_ids: np.ndarray) -> Pieces:
    """Tables for pieces; a string that is empty matches nothing, byte pieces match by ``byte_ids`` alone."""
    is_byte = np.zeros(len(strings), bool)
    is_byte[byte_ids] = True
    data = np.frombuffer(b"".join(strings), np.uint8)
    bounds = np.append(0, np.cumsum([len(s) for s in strings]))
    numbers, by_length, leads = eights(data), {}, []
    for length in sorted({len(s) for s in strings} - {0}):
        ids = np.array([i for i, s in enumerate(strings) if len(s) == length and not is_byte[i]], np.int64)
        if len(ids):
            at = bounds[ids]
            key = folded(at, numbers, length) if length > 8 else leading(numbers[at], length)
            by_length[length] = (Lookup(key), ids)
            if length > 8:
                leads.append(numbers[at])
    leads = Lookup(np.unique(np.concatenate([np.zeros(0, np.uint64), *leads])))
    return Pieces(strings, log_weight, byte_ids, by_length, leads, data, numbers, bounds)


def pieces_of(path: str) -> Pieces:
    """The pieces of a model file, loaded once per Python worker."""
    if path not in _models:
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        count = model.vocab_size()
        strings, weight, byte_ids = [], np.zeros(count), np.zeros(256, np.int64)
        for i in range(count):
            name = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(name[3:5], 16)
                byte_ids[value] = i
                strings.append(bytes([value]))
                weight[i] = -np.log(count + RANK_SHIFT) - BYTE_PENALTY
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                strings.append(b"")
            else:
                strings.append(name.replace(BLANK_SIGN, " ").encode())
                weight[i] = -np.log(min(-model.get_score(i), count) + RANK_SHIFT)
        _models[path] = make_pieces(strings, weight, byte_ids)
    return _models[path]


@dataclass
class Lattice:
    """Edges of the segments of a buffer, sorted by where they end, with running probabilities per end."""

    source: np.ndarray
    piece: np.ndarray
    running: np.ndarray  # the probability of this and earlier edges to the same end
    first: np.ndarray  # the first edge to each place of the buffer


def build_lattice(pieces: Pieces, texts: Texts, start: np.ndarray, end: np.ndarray) -> Lattice:
    """The lattice of the segments ``start`` to ``end`` with forward weights."""
    size, total = end - start, len(texts.data) + 1
    place = (np.repeat(start - np.append(0, np.cumsum(size)[:-1]), size) + np.arange(size.sum())).astype(np.int32)
    origin = np.zeros(total, np.int32)
    origin[place] = np.repeat(start, size)
    here = eights(texts.data)
    at, room, number = place, np.repeat(end, size).astype(np.int32) - place, here[place]
    covered = np.zeros(total, bool)
    edges = []  # source, piece, length; an end has at most one edge of a length
    for length, (table, ids) in sorted(pieces.by_length.items()):
        fits = room >= length
        if length > 8 and len(number):
            fits &= pieces.leads.find(number) >= 0
        if not fits.all():
            at, room, number = at[fits], room[fits], number[fits]
        hit = table.find(folded(at, here, length) if length > 8 else leading(number, length))
        known = np.flatnonzero(hit >= 0)
        source, piece = at[known], ids[hit[known]]
        if length > 8:
            equal = same_bytes(here, source, pieces.eights, pieces.bounds[piece], length)
            source, piece = source[equal], piece[equal]
        edges.append((source, piece.astype(np.int32), length))
        if length <= 4:
            whole = source[CHARACTER_SIZE[texts.data[source]] == length]
            for back in range(length):
                covered[whole + back] = True
    bare = place[~covered[place]]
    edges.insert(0, (bare, pieces.byte_ids[texts.data[bare]].astype(np.int32), 1))
    # edges go by their end, long ones first
    count = np.zeros(total, np.int32)
    for from_, _, length in edges:
        count[from_ + length] += 1
    free = np.cumsum(count, dtype=np.int32) - count
    first_edge = np.where(count > 0, free, -1)
    source, piece, depth = np.empty((3, count.sum()), np.int32)
    for from_, kind, length in reversed(edges):
        to = from_ + length
        slot = free[to]
        free[to] += 1
        source[slot], piece[slot], depth[slot] = from_, kind, to - origin[from_]
    target = np.repeat(np.arange(total, dtype=np.int32), count)
    del edges, at, room, number, place
    # the forward pass goes by distance from the segment's start, then by end
    far = depth.max() > 0xFFFF
    order = np.argsort(depth if far else depth.astype(np.uint16), kind="stable")
    from_, to_, gain = source[order], target[order], pieces.log_weight[piece[order]]
    forward = np.zeros(len(texts.data) + 1)
    steps = np.append(np.flatnonzero(np.diff(depth[order], prepend=-1)), len(depth)).tolist()
    for at, to in zip(steps[:-1], steps[1:]):
        gain[at:to] += forward[from_[at:to]]
        first = np.flatnonzero(np.diff(to_[at:to], prepend=-1))
        most = np.maximum.reduceat(gain[at:to], first)
        sums = np.add.reduceat(np.exp(gain[at:to] - np.repeat(most, np.diff(np.append(first, to - at)))), first)
        forward[to_[at:to][first]] = most + np.log(sums)
    value = np.empty(len(gain))
    value[order] = gain
    share = np.exp(value - forward[target])
    count = count[count > 0]
    first = np.cumsum(count) - count
    running = np.cumsum(share)
    running -= np.repeat(running[first] - share[first], count)
    running[first + count - 1] = 1.0
    return Lattice(source, piece, running, first_edge)


def segments(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and bounds per text of the parts no piece reaches across."""
    data = texts.data
    before = np.roll(data, 1)
    cut = ((data == 0x20) & (before != 0x20)) | (data == 0x0A) | (before == 0x0A)
    cut[texts.ends] = False
    cut[texts.starts] |= texts.ends > texts.starts
    cut[: texts.starts[0]] = False
    start = np.flatnonzero(cut)
    bounds = np.append(np.searchsorted(start, texts.starts), len(start))
    end = np.append(start[1:], 0)
    full = np.diff(bounds) > 0
    end[bounds[1:][full] - 1] = texts.ends[full]
    return start, end, bounds


def sampled_ids(pieces: Pieces, texts: Texts, keys: np.ndarray, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Piece ids of all texts and where each text's ids begin and end; ``keys`` are a 64-bit number per text."""
    start, end, bounds = segments(texts)
    if not len(start):
        return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
    first, kind = kinds_of(texts, start, end)
    lattice = build_lattice(pieces, texts, start[first], end[first])
    owner = owners(bounds)
    chance = paired(keys[owner], (np.arange(len(start)) - bounds[owner]).astype(np.uint64), 500 + seed)
    here, stop = end[first][kind], start[first][kind]
    active, drawn, took = np.arange(len(start)), [], np.zeros(len(start), np.int64)
    while len(active):
        u = (mixed(chance[active], 700 + len(drawn)) >> np.uint64(11)) * 2.0**-53
        edge = lattice.first[here[active]]
        later = np.flatnonzero(u >= lattice.running[edge])
        while len(later):
            edge[later] += 1
            later = later[u[later] >= lattice.running[edge[later]]]
        drawn.append((active, lattice.piece[edge]))
        took[active] += 1
        here[active] = lattice.source[edge]
        active = active[here[active] > stop[active]]
    filled = np.append(0, np.cumsum(took))
    out = np.empty(filled[-1], np.int32)
    for step, (where, piece) in enumerate(drawn):  # the last piece of a segment was drawn first
        out[filled[where + 1] - 1 - step] = piece
    return out, filled[bounds]


def joined(pieces: Pieces, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all pieces one after another, and where each begins."""
    size = np.diff(pieces.bounds)[ids]
    begin = np.append(0, np.cumsum(size))
    at = np.repeat(pieces.bounds[ids] - begin[:-1], size) + np.arange(begin[-1])
    return pieces.data[at], begin


def spelled(pieces: Pieces, blobs: list[bytes]) -> pa.Array:
    """The texts that lists of ids spell."""
    return pa.array([joined(pieces, np.frombuffer(b or b"", "<i4"))[0].tobytes().decode("utf-8") for b in blobs], pa.string())


def encoded(docs: DataFrame, path: str = MODEL, seed: int = SEED, decode: bool = False) -> DataFrame:
    """``doc_id, text, ids`` of each row; ``ids`` are little-endian 32-bit numbers, drawn for the row's id.

    With ``decode`` the ids are decoded again in the same pass, as ``decoded`` does with stored ones.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of(path)
        for batch in batches:
            keys = mixed(batch.column("doc_id").fill_null(-1).to_numpy().astype(np.int64).view(np.uint64), 800)
            for first, last, texts in chunks(batch.column("text"), most=2 << 20):
                ids, bounds = sampled_ids(pieces, texts, keys[first:last], seed)
                offsets = pa.py_buffer((bounds * 4).astype(np.int32))
                body = pa.Array.from_buffers(pa.binary(), last - first, [None, offsets, pa.py_buffer(ids.astype("<i4"))])
                part = batch.slice(first, last - first)
                columns = {"doc_id": part.column("doc_id"), "text": part.column("text"), "ids": body}
                if decode:
                    columns["decoded"] = spelled(pieces, body.to_pylist())
                yield pa.RecordBatch.from_pydict(columns)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id bigint, text string, ids binary" + ", decoded string" * decode)


def decoded(rows: DataFrame, path: str = MODEL) -> DataFrame:
    """``rows`` with ``decoded``, the text that their ``ids`` spell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of(path)
        for batch in batches:
            for at in range(0, len(batch), 500):
                part = batch.slice(at, 500)
                yield part.append_column("decoded", spelled(pieces, part.column("ids").to_pylist()))

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(run, schema + ", decoded string")
