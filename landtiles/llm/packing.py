"""Token packing: first-fit decreasing on a tournament tree, within randomised groups of documents.

A document is its token ids and an end id. It is cut into pieces of at most ``CAPACITY`` ids; the pieces of a
group are placed in order of falling length, each into the first sequence that still has room, which a
tournament tree over the room left in each sequence finds in logarithmic time.

Null and empty texts consist of the end id alone. Ties in length go by id and start. Repeated rows are packed each,
with equal pieces. A text of any length is cut, never shortened. Other columns are not read.
"""

import json
from array import array
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landtiles.llm.common import give_back
from landtiles.llm.spans import IS_SPACE, Texts, chunks

CAPACITY = 2048
END_ID = 1
GROUP_PIECES = 8192  # a group has about half as many, and not more but by a very rare chance
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
CACHE_BYTES = 48 << 20  # of segments and ids that a Python worker keeps from chunk to chunk
LONG_SEGMENT = 256  # bytes from which a segment is not kept
ENTRY_BYTES = 180  # that an entry takes besides its contents
_encoders = {}


def _byte_letters() -> dict[str, int]:
    """The printable stand-in of each byte in the vocabulary file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    """Ids of whole texts, from the ids of their blank-led segments, most of which repeat.

    The splitting pattern of the tokenizer never joins a blank to a non-blank before it, so a text may be cut
    there. Segments of ASCII and Latin-1 letters go to a faster library with the same merges; segments with
    other characters, or with the name of a special token, go to the tokenizer of the file itself.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.path, self.tokenizer, self.load = path, None, Tokenizer.from_file
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        self.special = [t["content"].encode() for t in described["added_tokens"]]
        leads = {t[:1] for t in self.special}
        self.lead = leads.pop() if len(leads) == 1 else b""  # without it a segment has no special name
        letters = _byte_letters()
        special = {t["content"] for t in described["added_tokens"]}
        ranks = {
            bytes(letters[c] for c in token): number
            for token, number in described["model"]["vocab"].items()
            if token not in special
        }
        self.fast = tiktoken.Encoding(
            "plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self.known: dict[bytes, bytes] = {}
        self.held = 0

    def _encode(self, segment: bytes, plain: bool) -> bytes:
        """The ids of a segment, 4 bytes each."""
        text = segment.decode("utf-8")
        if plain and not any(s in segment for s in self.special):
            return array("I", self.fast.encode_ordinary(text)).tobytes()
        if self.tokenizer is None:
            self.tokenizer = self.load(self.path)
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _ids_of(self, segments: list[bytes], plain: list[bool]) -> list[bytes]:
        """The ids of each segment, from what the worker knows; it keeps no more than its bound from call to call."""
        known, encode, found = self.known, self.fast.encode_ordinary, []
        for segment, simple in zip(segments, plain):
            ids = known.get(segment)
            if ids is None:
                if simple and self.lead not in segment:
                    ids = array("I", encode(segment.decode())).tobytes()
                else:
                    ids = self._encode(segment, simple)
                if len(segment) < LONG_SEGMENT:
                    known[segment] = ids
                    self.held += ENTRY_BYTES + len(segment) + len(ids)
            found.append(ids)
        if self.held > CACHE_BYTES:
            self.known, self.held = {}, 0
        return found

    def ids(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, end ids included, and where each text's ids begin and end."""
        data = texts.data
        before, lead = np.roll(data, 1), np.roll(data, 2)
        solid = ((before > 0x20) & (before < 0x7F)) | ((before >= 0x80) & (lead >= 0xC3) & (lead < 0xE0))
        cut = IS_SPACE[data] & solid
        cut[texts.ends] = False  # the line end after a text is no part of it
        cut[texts.starts] |= texts.ends > texts.starts
        cut[: texts.starts[0]] = False
        start = np.flatnonzero(cut)
        bounds = np.append(np.searchsorted(start, texts.starts), len(start))
        # a segment ends where the next one starts, or with its text
        last = np.append(start[1:], 0)
        full = np.diff(bounds) > 0
        last[bounds[1:][full] - 1] = texts.ends[full]
        odd = (data >= 0x80) & ~((data == 0xC3) | ((data < 0xC0) & (before == 0xC3)))
        oddness = np.append(0, np.cumsum(odd))
        body = data.tobytes()
        _, first, place = np.unique(texts.hashes(start, last), return_index=True, return_inverse=True)
        sizes = last - start
        if (sizes != sizes[first][place]).any() or not texts.same(start, last, start[first][place]):
            # segments with one hash that differ: tell them apart by their bytes
            numbers: dict[bytes, int] = {}
            place = np.array([numbers.setdefault(body[a:b], len(numbers)) for a, b in zip(start.tolist(), last.tolist())], np.int64)
            first = np.unique(place, return_index=True)[1]
        plain = (oddness[start[first]] == oddness[last[first]]).tolist()
        found = self._ids_of([body[a:b] for a, b in zip(start[first].tolist(), last[first].tolist())], plain)
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        pool = np.frombuffer(b"".join(found), np.uint32)
        pool_start = np.append(0, np.cumsum(sizes))
        # lay the segments out one after another, with a place for the end id behind each text
        size = sizes[place] if len(start) else np.zeros(0, np.int64)
        filled = np.append(0, np.cumsum(size))
        text_sizes = filled[bounds[1:]] - filled[bounds[:-1]] + 1
        text_bounds = np.append(0, np.cumsum(text_sizes))
        owner = np.repeat(np.arange(len(texts)), np.diff(bounds))
        target = filled[:-1] + owner
        within = np.arange(filled[-1]) - np.repeat(filled[:-1], size)
        out = np.full(text_bounds[-1], END_ID, np.uint32)
        out[np.repeat(target, size) + within] = pool[np.repeat(pool_start[place] if len(start) else size, size) + within]
        return out, text_bounds


def encoder(path: str) -> Encoder:
    """The encoder of this Python worker."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def token_pieces(docs: DataFrame, capacity: int = CAPACITY, path: str = TOKENIZER) -> DataFrame:
    """``doc_id, start, length, doc_tokens, ids`` per piece; ``ids`` are little-endian unsigned 32-bit numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            nulls = np.asarray(batch.column("doc_id").is_null())
            for first, last, texts in chunks(batch.column("text")):
                tokens, bounds = encoder(path).ids(texts)
                count = np.diff(bounds)
                pieces = -(-count // capacity)
                owner = np.repeat(np.arange(len(texts)), pieces)
                start = (np.arange(len(owner)) - np.repeat(np.append(0, np.cumsum(pieces)[:-1]), pieces)) * capacity
                length = np.minimum(count[owner] - start, capacity)
                offsets = np.append(0, np.cumsum(length)).astype(np.int32) * 4
                body = pa.Array.from_buffers(
                    pa.binary(), len(owner), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(tokens.astype("<u4"))]
                )
                owned = pa.array(ids[first:last][owner], pa.int64(), mask=nulls[first:last][owner], from_pandas=True)
                yield pa.RecordBatch.from_arrays(
                    [owned, pa.array(start), pa.array(length), pa.array(count[owner]), body],
                    names=["doc_id", "start", "length", "doc_tokens", "ids"],
                )
        give_back()

    schema = "doc_id bigint, start bigint, length bigint, doc_tokens bigint, ids binary"
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, schema)


class Tournament:
    """Bins in order, and at each inner node the most room in any bin below it."""

    def __init__(self, bins: int, capacity: int):
        self.width = 1 << max(0, (bins - 1).bit_length())
        self.room = [capacity] * (2 * self.width)

    def place(self, size: int) -> tuple[int, int]:
        """Put ``size`` into the first bin with room; its number and the room it had."""
        room, node = self.room, 1
        while node < self.width:
            node *= 2
            if room[node] < size:
                node += 1
        had = room[node]
        room[node] = had - size
        number = node - self.width
        while node > 1:
            node //= 2
            room[node] = max(room[2 * node], room[2 * node + 1])
        return number, had


def first_fit_decreasing(lengths: list[int], capacity: int) -> list[tuple[int, int]]:
    """Bin and offset of each length; the lengths must not rise."""
    tree = Tournament(len(lengths), capacity)
    placed = []
    for size in lengths:
        number, had = tree.place(size)
        placed.append((number, capacity - had))
    return placed


def assign_sequences(pieces: DataFrame, groups: int, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; any further columns are carried along.

    Groups come from a hash of id, start and row number, so rows that repeat do not meet in one group.
    """
    group = F.pmod(F.xxhash64("doc_id", "start", F.monotonically_increasing_id()), F.lit(groups))
    placed = (
        pieces.withColumn("group", group)
        .repartition("group")
        .sortWithinPartitions("group", F.desc("length"), "doc_id", "start")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, now = [], None

        def pack():
            table = pa.Table.from_batches(waiting)
            bins = first_fit_decreasing(table.column("length").to_pylist(), capacity)
            table = table.drop_columns(["group"])
            table = table.append_column("sequence_id", pa.array([(now << 32) + b for b, _ in bins], pa.int64()))
            table = table.append_column("offset", pa.array([o for _, o in bins], pa.int64()))
            return table.to_batches()

        for batch in batches:
            group = batch.column("group").to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(group)]
            for at, to in zip(edges[:-1], edges[1:]):
                if waiting and group[at] != now:
                    yield from pack()
                    waiting = []
                now = int(group[at])
                waiting.append(batch.slice(at, to - at))
        if waiting:
            yield from pack()
        give_back()

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema)
    return placed.mapInArrow(run, schema + ", sequence_id bigint, offset bigint")


def group_count(docs: DataFrame, capacity: int = CAPACITY) -> int:
    """So many groups that one has ``GROUP_PIECES / 2`` pieces on average, if every second byte were an id."""
    pieces = F.coalesce(F.octet_length("text"), F.lit(0)) / (2.0 * capacity) + 1
    return max(1, -(-int(docs.agg(F.coalesce(F.sum(pieces), F.lit(0.0))).first()[0]) // (GROUP_PIECES // 2)))


def packed_ids(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Pieces with their ids, sequence and offset: all that is needed to write the sequences."""
    return assign_sequences(token_pieces(docs, capacity), group_count(docs, capacity), capacity)
