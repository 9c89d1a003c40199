"""Removal of passages that an earlier document has, by a sparse suffix array over all documents.

A suffix is told by its first ``LENGTH`` bytes, its window. Suffixes next to each other that have the same smallest
16-byte lead (two tokens of 8 bytes, in the order of a hash) among their windows travel as one slice of the text; equal
windows choose the same lead, wherever they stand, so they meet if slices with equal leads meet.

1. Texts are stored in blocks. Each block asks, by hashes of its leads, which of them occur in several documents.
   Only slices with such a lead go on, so the texts that are sent are about those that repeat.
2. A sample of leads gives splitters, and slices are range-partitioned by their leading tokens. A lead that is in very
   many slices may span several ranges: splitters go on, behind the tokens, with a number of the block.
3. Each range sorts its suffixes by multikey quicksort, 8 bytes at a time, down to whole windows. Among equal windows
   all but those of the smallest ``doc_id`` are repeats.
4. Across a boundary, the windows of leads that splitters cut are compared once more, one row per range and window.
5. The spans found go back to the blocks, and each text is cut.

Slices that are equal in a block, or in a range, are compared once. Hashes only choose which slices may be left out
of the comparison; repeats are decided on bytes.

Null texts count as empty. A row without ``doc_id`` is neither larger nor smaller than another one: it keeps all and
removes nothing. Rows with one id remove nothing from one another. Texts shorter than a window stay whole. An empty
table gives an empty result. Columns other than ``doc_id`` and ``text`` are not read.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landtiles.llm.spans import mixed, parts_of
from landtiles.session import cut

LENGTH = 50
TOKEN = 8  # bytes that are compared at once
LEAD = 2 * TOKEN
BLOCK_BYTES = 4 << 20
SEGMENT = 1 << 18  # suffixes whose leads are chosen at once
ASKED_BYTES = 16 << 20  # of hashes in one task
HASH_BITS = 48
RANGE_BYTES = 8 << 20  # of slices in one task
SAMPLED_BLOCKS = 64
SAMPLED_LEADS = 512  # of a block
SMALL = 1 << 16  # parts that numpy sorts

_FACTORS = [np.uint64(f) for f in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]
_LOW = np.uint64(0xFFFFFFFF)


# ---- slices of suffixes


def token_codes(data: np.ndarray) -> np.ndarray:
    """At each place the 8 bytes from there, zeros behind the end, as a number that sorts as they do."""
    codes = np.concatenate([data, np.zeros(TOKEN, np.uint8)]).astype(np.uint64)
    for step in (1, 2, 4):
        codes = (codes[:-step] << np.uint64(8 * step)) | codes[step:]
    return codes[: len(data)]


def lead_hashes(codes: np.ndarray) -> np.ndarray:
    """A hash of the lead at each place that has two tokens."""
    h = codes[:-TOKEN] * _FACTORS[0]
    h ^= h >> np.uint64(32)
    h += codes[TOKEN:]
    for factor, shift in ((_FACTORS[1], 29), (_FACTORS[2], 32)):
        h *= factor
        h ^= h >> np.uint64(shift)
    return h


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while 2 * size <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def slices(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Slices of the texts: first suffix, number of suffixes, place of the lead, and the lead's hash."""
    width = length - LEAD + 1
    full = ends - starts >= length
    step = np.zeros(len(data) + 1, np.int8)
    step[starts[full]] += 1
    step[ends[full] - length + 1] -= 1
    whole = np.cumsum(step[:-1], dtype=np.int8) > 0  # suffixes whose window lies in their text
    found = [[np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]]
    for at in range(0, len(data) - length + 1, SEGMENT):
        to = min(at + SEGMENT, len(data) - length + 1)
        here = whole[at:to]
        if not here.any():
            continue
        hashes = lead_hashes(token_codes(data[at : to + length - 1 + TOKEN]))[: to - at + width - 1]
        least = sliding_least((hashes & ~_LOW) | np.arange(len(hashes), dtype=np.uint64), width)
        lead = (least & _LOW).astype(np.int64)
        change = lead[1:] != lead[:-1]
        first, last = here.copy(), here.copy()
        first[1:] &= ~here[:-1] | change
        last[:-1] &= ~here[1:] | change
        begin = np.flatnonzero(first)
        lead = lead[begin]
        for column, more in zip(found, (begin + at, np.flatnonzero(last) - begin + 1, lead + at, hashes[lead])):
            column.append(more)
    return tuple(np.concatenate(c) for c in found)


def gathered(data: np.ndarray, begin: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Some parts of a buffer, one after another."""
    offsets = np.cumsum(sizes) - sizes
    return data[np.repeat(begin - offsets, sizes) + np.arange(int(sizes.sum()))]


def lead_keys(data: np.ndarray, lead: np.ndarray, salt: int) -> np.ndarray:
    """The two leading tokens of each slice and a number of its block, as bytes in their order."""
    keys = np.empty((len(lead), LEAD + 8), np.uint8)
    keys[:, :LEAD] = data[lead[:, None] + np.arange(LEAD)]
    keys[:, LEAD:] = np.frombuffer(salt.to_bytes(8, "big"), np.uint8)
    return keys.reshape(-1).view(f"S{LEAD + 8}")


def packed(*columns: np.ndarray) -> bytes:
    """Columns of numbers or bytes, compressed, with their sizes in front."""
    raw = [np.ascontiguousarray(c).tobytes() for c in columns]
    body = b"".join(raw)
    head = np.array([len(body), *map(len, raw)], np.int64).tobytes()
    return head + pa.compress(body, codec="zstd", asbytes=True)


def unpacked(blob: bytes, *types) -> list[np.ndarray]:
    sizes = np.frombuffer(blob, np.int64, len(types) + 1)
    body = pa.decompress(blob[8 * len(sizes) :], int(sizes[0]), codec="zstd", asbytes=True)
    at = np.append(0, np.cumsum(sizes[1:]))
    return [np.frombuffer(body[at[i] : at[i + 1]], t) for i, t in enumerate(types)]


# ---- blocks of texts


class Block:
    """The texts of a stored block in one buffer, and which of their suffixes are to be compared."""

    def __init__(self, row: dict, length: int):
        self.number = row["block"]
        self.ids = row["ids"]
        sizes = np.array(row["sizes"], np.int64)
        self.data = np.frombuffer(pa.decompress(row["body"], int(sizes.sum()), codec="zstd", asbytes=True), np.uint8)
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        self.length = length

    def compared(self) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the texts whose suffixes are compared; and of those that equal a text with a smaller id here."""
        least: dict[bytes, int] = {}
        known = [i for i, doc_id in enumerate(self.ids) if doc_id is not None and self.ends[i] - self.starts[i] >= self.length]
        bodies = {i: self.data[self.starts[i] : self.ends[i]].tobytes() for i in known}
        for i in known:
            least[bodies[i]] = min(self.ids[i], least.get(bodies[i], self.ids[i]))
        late = [i for i in known if self.ids[i] > least[bodies[i]]]
        return np.setdiff1d(known, late).astype(np.int64), np.array(late, np.int64)

    def slices(self, texts: np.ndarray):
        begin, count, lead, hashes = slices(self.data, self.starts[texts], self.ends[texts], self.length)
        owner = np.searchsorted(self.starts[texts], begin, side="right") - 1
        # leads are chosen by small hashes; hashed once more they fill all parts evenly
        return begin, count, lead, mixed(hashes) >> np.uint64(64 - HASH_BITS), texts[owner]


def blocks(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``block, ids, sizes, body``: whole texts, compressed; a text that is larger than a block stands alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tag, ids, parts, held = TaskContext.get().partitionId() << 33, [], [], 0

        def block():
            made = [[tag], [ids], [[len(p) for p in parts]], [pa.compress(b"".join(parts), codec="zstd", asbytes=True)]]
            types = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(m, t) for m, t in zip(made, types)], names=["block", "ids", "sizes", "body"])

        for batch in batches:
            for doc_id, part in zip(batch.column("doc_id").to_pylist(), parts_of(batch.column("text"))):
                if parts and held + len(part) > block_bytes:
                    yield block()
                    tag, ids, parts, held = tag + 1, [], [], 0
                ids.append(doc_id)
                parts.append(bytes(part))
                held += len(part)
        if parts:
            yield block()

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(run, "block bigint, ids array<bigint>, sizes array<bigint>, body binary")


# ---- which leads repeat


def questions(stored: DataFrame, part_bits: int, length: int) -> DataFrame:
    """Per block and part of the hashes: the distinct hashes of its leads, and which of them several ids here have."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row, length)
                _, _, _, hashes, owner = block.slices(block.compared()[0])
                if not len(hashes):
                    continue
                order = np.argsort(hashes)
                first = np.flatnonzero(np.diff(hashes[order], prepend=hashes[order[0]] ^ np.uint64(1)))
                ids = np.array([-1 if i is None else i for i in block.ids], np.int64)[owner[order]]
                several = np.minimum.reduceat(ids, first) != np.maximum.reduceat(ids, first)
                known = hashes[order[first]]
                edges = np.searchsorted(known, np.arange((1 << part_bits) + 1, dtype=np.uint64) << np.uint64(HASH_BITS - part_bits))
                planes = known.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:]
                made = [
                    (block.number, part, packed(planes[at:to].T, np.packbits(several[at:to])), to - at)
                    for part, (at, to) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist())) if to > at
                ]
                types = (pa.int64(), pa.int64(), pa.binary(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*made), types)], names=["block", "part", "hashes", "n"]
                )

    return stored.mapInArrow(run, "block bigint, part bigint, hashes binary, n bigint")


def answers(asked: DataFrame) -> DataFrame:
    """``block, part, shared, n``: a bit for each hash asked for, whether several documents have it, and how many do."""

    def answer(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        keys, several = [], []
        for row in rows:
            planes, bits = unpacked(row["hashes"], np.uint8, np.uint8)
            whole = np.zeros((row["n"], 8), np.uint8)
            whole[:, 2:] = planes.reshape(-1, row["n"]).T
            keys.append(whole.reshape(-1).view(">u8").astype(np.uint64))
            several.append(np.unpackbits(bits, count=row["n"]))
        _, place, count = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
        often = count > 1
        often[place[np.concatenate(several) > 0]] = True
        shared = np.split(often[place], np.cumsum([len(k) for k in keys])[:-1])
        made = [
            [r["block"] for r in rows], [r["part"] for r in rows], [packed(np.packbits(s)) for s in shared], [int(s.sum()) for s in shared]
        ]
        types = (pa.int64(), pa.int64(), pa.binary(), pa.int64())
        return pa.Table.from_arrays(
            [pa.array(c, t) for c, t in zip([*made, [r["n"] for r in rows]], (*types, pa.int64()))],
            names=["block", "part", "shared", "found", "n"],
        )

    return asked.groupBy("part").applyInArrow(answer, "block bigint, part bigint, shared binary, found bigint, n bigint")


class Candidates:
    """The slices of a block whose leads several documents have."""

    def __init__(self, stored: pa.Table, answered: pa.Table, length: int):
        self.block = Block(stored.to_pylist()[0], length)
        texts, self.late = self.block.compared()
        begin, count, lead, hashes, owner = self.block.slices(texts)
        bits = [np.zeros(0, bool)]
        for row in sorted(answered.to_pylist(), key=lambda r: r["part"]):
            bits.append(np.unpackbits(unpacked(row["shared"], np.uint8)[0], count=row["n"]) > 0)
        shared = np.concatenate(bits)
        known, place = np.unique(hashes, return_inverse=True)
        if len(known) != len(shared):
            raise ValueError("a block changed between its question and the answer")
        keep = shared[place] if len(place) else np.zeros(0, bool)
        self.begin, self.count, self.lead, self.owner = begin[keep], count[keep], lead[keep], owner[keep]
        # blocks of one number get one salt, so equal work gives equal keys
        self.salt = (self.block.number * 0x9E3779B97F4A7C15) % (1 << 64)

    def keys(self) -> np.ndarray:
        return lead_keys(self.block.data, self.lead, self.salt)


# ---- ranges of suffixes


def find_splitters(stored: DataFrame, answered: DataFrame, length: int, range_bytes: int) -> np.ndarray:
    """Sorted keys that split the slices into ranges, from the leads of sampled blocks.

    The sample, and with it what the driver holds, is about 32 keys for each range, of 24 bytes each.
    """
    found = answered.agg(F.coalesce(F.sum("found"), F.lit(0))).first()[0]
    ranges = max(1, -(-found * (length + (length - LEAD) // 2) // range_bytes))
    if ranges == 1:
        return np.zeros(0, f"S{LEAD + 8}")
    wanted = max(SAMPLED_BLOCKS, 32 * ranges // SAMPLED_LEADS)
    few = cut(stored.select("block").orderBy(F.xxhash64("block"), "block").limit(wanted), "sampled")

    def sample(left: pa.Table, right: pa.Table) -> pa.Table:
        keys = Candidates(left, right, length).keys()
        chosen = keys[:: max(1, len(keys) // SAMPLED_LEADS)]
        return pa.table({"key": pa.array([k.ljust(LEAD + 8, b"\0") for k in chosen.tolist()], pa.binary())})

    sides = [side.join(few, "block", "left_semi").groupBy("block") for side in (stored, answered)]
    drawn = sides[0].cogroup(sides[1]).applyInArrow(sample, "key binary").toArrow().column("key").to_pylist()
    drawn = np.sort(np.array(drawn, f"S{LEAD + 8}"))
    at = np.arange(1, ranges) * len(drawn) // ranges
    return np.unique(drawn[at]) if len(drawn) else np.zeros(0, f"S{LEAD + 8}")


RUN_TYPES = (np.int64, np.uint32, np.uint32, np.uint16, np.uint16, np.uint8)  # id, text, start, lead, suffixes, bytes


def sent(stored: DataFrame, answered: DataFrame, splitters: np.ndarray, length: int) -> DataFrame:
    """``range, block, slices, spans``: each block's slices by range, and the spans that the block found in itself."""

    def emit(left: pa.Table, right: pa.Table) -> pa.Table:
        found = Candidates(left, right, length)
        block = found.block
        sizes = found.count + length - 1
        ids = np.array([-1 if i is None else i for i in block.ids], np.int64)[found.owner]
        start = found.begin - block.starts[found.owner]
        body = block.data.tobytes()
        least: dict[bytes, int] = {}
        contents = [body[a:b] for a, b in zip(found.begin.tolist(), (found.begin + sizes).tolist())]
        for content, doc_id in zip(contents, ids.tolist()):
            if doc_id <= least.get(content, doc_id):
                least[content] = doc_id
        early = ids == np.fromiter((least[c] for c in contents), np.int64, len(contents))
        whole = block.ends[found.late] - block.starts[found.late]
        own = spans_of(
            np.append(found.owner[~early], found.late),
            np.append(start[~early], np.zeros(len(whole), np.int64)),
            np.append(sizes[~early], whole),
        )
        place = np.searchsorted(splitters, found.keys()[early], side="right")
        order = np.argsort(place, kind="stable")
        columns = [c[early][order] for c in (ids, found.owner, start, found.lead - found.begin, found.count, found.begin, sizes)]
        edges = np.append(np.flatnonzero(np.diff(place[order], prepend=-1)), len(order)).tolist()
        rows = []
        for at, to in zip(edges[:-1], edges[1:]):
            *numbers, begin, size = (c[at:to] for c in columns)
            run = packed(*(n.astype(t) for n, t in zip(numbers, RUN_TYPES)), gathered(block.data, begin, size))
            rows.append((int(place[order[at]]), block.number, run, None))
        if own is not None:
            rows.append((block.number % (len(splitters) + 1), block.number, None, own))
        types = (pa.int64(), pa.int64(), pa.binary(), pa.binary())
        return pa.Table.from_arrays(
            [pa.array(list(c), t) for c, t in zip(zip(*rows) if rows else [[]] * 4, types)], names=["range", "block", "slices", "spans"]
        )

    sides = [side.groupBy("block") for side in (stored, answered)]
    return sides[0].cogroup(sides[1]).applyInArrow(emit, "range bigint, block bigint, slices binary, spans binary")


def spans_of(texts: np.ndarray, start: np.ndarray, size: np.ndarray) -> bytes | None:
    return packed(*(c.astype(np.uint32) for c in (texts, start, size))) if len(texts) else None


def multikey_sorted(codes: np.ndarray, places: np.ndarray, offsets: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes sorted by their tokens at ``offsets``, and for each whether it differs from the one before.

    Multikey quicksort: three parts by one token of a pivot; the part that equals it goes on with the next token.
    """
    order, differs = np.empty(len(places), np.int64), np.ones(len(places), bool)
    waiting = [(np.arange(len(places)), 0, 0)]
    while waiting:
        members, depth, at = waiting.pop()
        if depth == len(offsets):
            order[at : at + len(members)] = members
            differs[at + 1 : at + len(members)] = False
        elif len(members) <= SMALL:
            to = at + len(members)
            order[at:to], differs[at:to] = _small_sorted(codes, places, members, offsets[depth:])
        else:
            token = codes[places[members] + offsets[depth]]
            pivot = np.sort(token[:: len(token) // 64])[32]
            below, above = token < pivot, token > pivot
            for part, deeper in ((members[below], 0), (members[~(below | above)], 1), (members[above], 0)):
                if len(part):
                    waiting.append((part, depth + deeper, at))
                at += len(part)
    return order, differs


def _small_sorted(codes, places, members, offsets):
    """The same for a part that is sorted token by token, each time among those still equal."""
    token = codes[places[members] + offsets[0]]
    order = np.argsort(token, kind="stable")
    members, token = members[order], token[order]
    differs = np.append(True, token[1:] != token[:-1])[: len(members)]
    for offset in offsets[1:]:
        equal = ~differs
        equal[:-1] |= ~differs[1:]
        at = np.flatnonzero(equal)
        if not len(at):
            break
        run = np.cumsum(differs)[at]
        token = codes[places[members[at]] + offset]
        order = np.lexsort((token, run))
        members[at], token = members[at][order], token[order]
        differs[at[1:]] |= token[1:] != token[:-1]
    return members, differs


def compared(slices_: DataFrame, splitters: np.ndarray, length: int) -> DataFrame:
    """``block, spans`` found in each range; and ``block, text, start, doc_id, window`` of suffixes at its boundaries
    that were not found to be repeats."""
    offsets = [*range(0, length - TOKEN, TOKEN), length - TOKEN]

    def compare(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        spans = [(r["block"], r["spans"]) for r in rows if r["spans"] is not None]
        rows = [r for r in rows if r["slices"] is not None]
        edges: list[tuple] = []
        if rows:
            parts = [unpacked(r["slices"], *RUN_TYPES) for r in rows]
            home = np.repeat(np.arange(len(rows)), [len(p[0]) for p in parts])
            ids, text, start, lead, count, data = (np.concatenate(c) for c in zip(*parts))
            count = count.astype(np.int64)
            sizes = count + length - 1
            ends = np.cumsum(sizes)
            body, seen, least = data.tobytes(), {}, []
            kind = np.empty(len(ids), np.int64)
            firsts = []
            for i, (a, b, doc_id) in enumerate(zip((ends - sizes).tolist(), ends.tolist(), ids.tolist())):
                k = seen.setdefault(body[a:b], len(least))
                if k == len(least):
                    least.append(doc_id)
                    firsts.append(i)
                elif doc_id < least[k]:
                    least[k] = doc_id
                kind[i] = k
            del seen
            firsts = np.array(firsts)
            # one suffix for each place of each distinct slice, with the smallest id that has the slice
            many = count[firsts]
            bounds = np.append(0, np.cumsum(many))
            places = np.repeat((ends - sizes)[firsts] - bounds[:-1], many) + np.arange(bounds[-1])
            order, differs = multikey_sorted(token_codes(data), places, offsets)
            owner = np.repeat(np.array(least, np.int64), many)[order]
            begin = np.flatnonzero(differs)
            smallest = np.empty(len(order), np.int64)
            smallest[order] = np.repeat(np.minimum.reduceat(owner, begin), np.diff(np.append(begin, len(order))))
            # back to the slices: which of their suffixes somebody with a smaller id has
            offset = np.cumsum(count) - count
            which = np.repeat(bounds[kind] - offset, count) + np.arange(int(count.sum()))
            late = smallest[which] < np.repeat(ids, count)
            inner = np.ones(len(late), bool)
            inner[offset] = False  # not the first of a slice
            first, last = late.copy(), late.copy()
            first[1:] &= ~(late[:-1] & inner[1:])
            last[:-1] &= ~(late[1:] & inner[1:])
            first, last = np.flatnonzero(first), np.flatnonzero(last)
            of = np.repeat(np.arange(len(ids)), count)
            at = start[of[first]] + first - offset[of[first]]
            size = last - first + length
            cuts = np.searchsorted(home[of[first]], np.arange(len(rows) + 1))
            for n, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
                if b > a:
                    spans.append((rows[n]["block"], spans_of(text[of[first[a:b]]], at[a:b], size[a:b])))
            number = table.column("range")[0].as_py()
            near = {splitters[i][:LEAD].ljust(LEAD, b"\0") for i in (number - 1, number) if 0 <= i < len(splitters)}
            if near:
                tokens = data[(ends - sizes + lead)[:, None] + np.arange(LEAD)].reshape(-1).view(f"V{LEAD}")
                cut_off = np.zeros(len(ids), bool)
                for token in near:
                    cut_off |= tokens == np.void(token)
                for w in np.flatnonzero(~late & np.repeat(cut_off, count)).tolist():
                    i = of[w]
                    within = int(w - offset[i])
                    a = int(ends[i] - sizes[i]) + within
                    edges.append((rows[home[i]]["block"], int(text[i]), int(start[i]) + within, int(ids[i]), body[a : a + length]))
        made = [
            [*(b for b, _ in spans), *(e[0] for e in edges)],
            [*(s for _, s in spans), *(None for _ in edges)],
            *([*(None for _ in spans), *(e[k] for e in edges)] for k in (1, 2, 3, 4)),
        ]
        types = (pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
        return pa.Table.from_arrays(
            [pa.array(c, t) for c, t in zip(made, types)], names=["block", "spans", "text", "start", "doc_id", "window"]
        )

    kinds = "block bigint, spans binary, text bigint, start bigint, doc_id bigint, window binary"
    return slices_.groupBy("range").applyInArrow(compare, kinds)


# ---- texts without repeats


def across_boundaries(found: DataFrame) -> DataFrame:
    """``block, text, start`` of the suffixes at boundaries whose window another range has under a smaller id."""
    edges = found.where("window is not null")
    least = edges.groupBy("window").agg(F.min("doc_id").alias("least"))
    return edges.join(least, "window").where("doc_id > least").select("block", "text", "start")


def without_repeats(
    docs: DataFrame, length: int = LENGTH, block_bytes: int = BLOCK_BYTES, range_bytes: int = RANGE_BYTES, asked_bytes: int = ASKED_BYTES
) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_bytes, starts, ends, kept``.

    ``starts`` and ``ends`` bound the runs of bytes, in order and apart, that are covered by strings of ``length`` bytes
    which also start in a document with a smaller id; ``kept`` has the bytes outside them.
    """
    if length < LEAD + TOKEN:
        raise ValueError(f"strings of {LEAD + TOKEN} bytes or more")
    stored = cut(blocks(docs, block_bytes), "blocks")
    raw = stored.agg(F.coalesce(F.sum(F.aggregate("sizes", F.lit(0).cast("bigint"), lambda a, b: a + b)), F.lit(0))).first()[0]
    asked = raw * 2 / (length - LEAD + 2) * HASH_BITS / 8
    part_bits = min(HASH_BITS // 2, max(0, int(asked // asked_bytes).bit_length()))
    answered = cut(answers(questions(stored, part_bits, length)), "answers")
    splitters = find_splitters(stored, answered, length, range_bytes)
    found = cut(compared(sent(stored, answered, splitters, length), splitters, length), "spans")
    single = F.lit(None).cast("binary").alias("spans")
    late = found.where("spans is not null").select("block", "spans", "text", "start").unionByName(
        across_boundaries(found).select("block", single, "text", "start")
    )

    def cut_out(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left):
            raise ValueError("spans of a block that is not there")
        block = Block(left.to_pylist()[0], length)
        step = np.zeros(len(block.data) + 1, np.int32)
        for row in right.to_pylist():
            if row["spans"] is None:
                text, start, size = np.array([row["text"]]), np.array([row["start"]]), np.array([length])
            else:
                text, start, size = (c.astype(np.int64) for c in unpacked(row["spans"], np.uint32, np.uint32, np.uint32))
            np.add.at(step, block.starts[text] + start, 1)
            np.add.at(step, block.starts[text] + start + size, -1)
        gone = np.cumsum(step[:-1]) > 0
        edge = np.zeros(len(gone) + 1, bool)  # where a text starts a run ends, whatever the text before
        edge[block.starts] = True
        edge[block.ends] = True
        first, last = gone.copy(), gone.copy()
        first[1:] &= ~gone[:-1] | edge[1:-1]
        last[:-1] &= ~gone[1:] | edge[1:-1]
        first, last = np.flatnonzero(first), np.flatnonzero(last) + 1
        begin, end = np.searchsorted(first, block.starts), np.searchsorted(first, block.ends)
        kept = block.data[~gone].tobytes()
        left_over = np.append(0, np.cumsum(~gone))
        made = [
            block.ids,
            (block.ends - block.starts).tolist(),
            [(first[a:b] - s).tolist() for a, b, s in zip(begin, end, block.starts)],
            [(last[a:b] - s).tolist() for a, b, s in zip(begin, end, block.starts)],
            [kept[a:b] for a, b in zip(left_over[block.starts].tolist(), left_over[block.ends].tolist())],
        ]
        types = (pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary())
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(made, types)], names=["doc_id", "n_bytes", "starts", "ends", "kept"])

    kinds = "doc_id bigint, n_bytes bigint, starts array<bigint>, ends array<bigint>, kept binary"
    return stored.groupBy("block").cogroup(late.groupBy("block")).applyInArrow(cut_out, kinds)
