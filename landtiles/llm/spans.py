"""Words, lines and 64-bit hashes of many UTF-8 texts at once, as numpy work on one byte buffer.

A span's hash is a polynomial over its bytes modulo 2**64, read off prefix sums, with its length mixed
in; equal spans have equal hashes wherever they stand, so hashes may be compared across tasks.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20

SPACES = [0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]
IS_SPACE = np.isin(np.arange(256), SPACES)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_LONG = 256  # bytes of a span that is compared by itself
_FIRST_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)  # of a little-endian number
_powers = {_BASE: np.ones(1, np.uint64), _BASE_INVERSE: np.ones(1, np.uint64)}


def _power(base: int, count: int) -> np.ndarray:
    """The first powers of a base; as many as a chunk needs are kept for the next one."""
    if len(_powers[base]) < count:
        steps = np.full(max(count, 2 * CHUNK_BYTES), base, np.uint64)
        steps[0] = 1
        made = np.multiply.accumulate(steps)
        if count > 4 * CHUNK_BYTES:
            return made[:count]
        _powers[base] = made
    return _powers[base][:count]


def mixed(values: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijection of 64-bit numbers whose bits all depend on all input bits."""
    z = values.astype(np.uint64, copy=True)
    z += np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) % (1 << 64))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        z ^= z >> np.uint64(shift)
        z *= np.uint64(factor)
    z ^= z >> np.uint64(31)
    return z


def paired(left: np.ndarray, right: np.ndarray, seed: int = 1) -> np.ndarray:
    """One hash of an ordered pair of hashes."""
    return mixed(mixed(left, seed) * np.uint64(3) + right, seed)


class Texts:
    """Some whole texts in one buffer, each after ``pad`` line ends.

    ``starts`` and ``ends`` bound each text in ``data``. A null counts as an empty text.
    """

    def __init__(self, parts: list, pad: int = 1):
        sizes = np.fromiter((len(p) for p in parts), np.int64, len(parts))
        gap = b"\n" * pad
        self.data = np.frombuffer(gap + b"".join(x for p in parts for x in (p, gap)), np.uint8)
        self.starts = pad + np.concatenate([[0], np.cumsum(sizes + pad)[:-1]]).astype(np.int64)
        self.ends = self.starts + sizes
        self._sums = None

    def __len__(self) -> int:
        return len(self.starts)

    def lowered(self) -> "Texts":
        """The same texts with A-Z in lower case."""
        twin = object.__new__(Texts)
        twin.data, twin.starts, twin.ends, twin._sums = LOWER[self.data], self.starts, self.ends, None
        return twin

    def words(self, is_gap: np.ndarray = IS_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of the words in all texts, and where each text's words begin and end.

        Words of text i are numbers ``bounds[i]`` to ``bounds[i + 1]``.
        """
        inside = ~is_gap[self.data]
        step = np.diff(inside.view(np.int8))
        starts, ends = np.flatnonzero(step == 1) + 1, np.flatnonzero(step == -1) + 1
        return starts, ends, np.append(np.searchsorted(starts, self.starts), len(starts))

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """As ``words``, for the lines between line feeds, blank ones included."""
        feeds = np.flatnonzero(self.data == 10)
        starts, ends = feeds[:-1] + 1, feeds[1:]
        # a gap of one byte before each text makes its first line start where the text starts
        return starts, ends, np.append(np.searchsorted(starts, self.starts), len(starts))

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if self._sums is None:
            terms = (self.data.astype(np.uint64) + np.uint64(1)) * _power(_BASE, len(self.data))
            self._sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)])
        inverse = _power(_BASE_INVERSE, len(self.data) + 1)
        body = (self._sums[ends] - self._sums[starts]) * inverse[starts]
        return mixed(body ^ ((ends - starts).astype(np.uint64) << np.uint64(40)))

    def same(self, starts: np.ndarray, ends: np.ndarray, others: np.ndarray) -> bool:
        """Whether each span has the bytes of another one of its length, which starts at ``others``."""
        padded = np.concatenate([self.data, np.zeros(8, np.uint8)])
        eight = np.ndarray((len(self.data),), "<u8", padded, strides=(1,))  # the 8 bytes from each place on
        sizes = ends - starts
        for i in np.flatnonzero(sizes > _LONG).tolist():
            if self.data[starts[i] : ends[i]].tobytes() != self.data[others[i] : others[i] + sizes[i]].tobytes():
                return False
        left = np.flatnonzero(sizes <= _LONG)
        for step in range(0, _LONG, 8):
            left = left[sizes[left] > step]
            if not len(left):
                break
            differ = eight[starts[left] + step] ^ eight[others[left] + step]
            if (differ & _FIRST_BYTES[np.minimum(sizes[left] - step, 8)]).any():
                return False
        return True

    def gram_hashes(self, size: int) -> np.ndarray:
        """The hash of the ``size`` bytes that end at each byte of the buffer."""
        ends = np.arange(1, len(self.data) + 1)
        return self.hashes(np.maximum(ends - size, 0), ends)


def parts_of(column: pa.Array) -> list:
    """The bytes of each text, without a copy; nulls are empty."""
    if not len(column):
        return []
    column = column.fill_null("") if column.null_count else column
    column = column.cast(pa.large_string()).cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    body = memoryview(column.buffers()[2] or b"")
    return [body[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]


def chunks(column: pa.Array, pad: int = 1, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int, Texts]]:
    """Runs of whole texts of about ``most`` bytes, with the rows they span; a longer text stands alone."""
    parts = parts_of(column)
    first = total = 0
    for row, part in enumerate(parts):
        if row > first and total + len(part) > most:
            yield first, row, Texts(parts[first:row], pad)
            first, total = row, 0
        total += len(part) + pad
    if first < len(parts):
        yield first, len(parts), Texts(parts[first:], pad)


def sums_within(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The sum of each run ``bounds[i]`` to ``bounds[i + 1]``; zero for an empty run."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.float64 if values.dtype.kind == "f" else np.int64)])
    return total[bounds[1:]] - total[bounds[:-1]]


def owners(bounds: np.ndarray) -> np.ndarray:
    """For each item of consecutive runs, the number of its run."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def occurrences(hashes: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """For each item, how often its hash occurs under the same owner."""
    _, inverse, counts = np.unique(
        paired(hashes, owner.astype(np.uint64)), return_inverse=True, return_counts=True
    )
    return counts[inverse]


class Lookup:
    """An open-addressing table from 64-bit keys to their positions, probed for whole arrays."""

    def __init__(self, keys: np.ndarray):
        bits = max(4, int(len(keys) * 3).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.places = np.zeros(1 << bits, np.uint64), np.full(1 << bits, -1, np.int32)
        waiting, slot = np.arange(len(keys), dtype=np.int32), self._slot(keys)
        while len(waiting):
            free = self.places[slot] < 0
            self.places[slot[free]] = waiting[free]  # of several claims the last one stays
            lost = self.places[slot] != waiting
            waiting, slot = waiting[lost], (slot[lost] + 1) & self.mask
        taken = self.places >= 0
        self.keys[taken] = keys[self.places[taken]]

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(_BASE)) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The position of each key, or -1."""
        slot = self._slot(keys)
        found = self.places[slot]
        wrong = np.flatnonzero((found >= 0) & (self.keys[slot] != keys))
        slot = slot[wrong]
        while len(wrong):
            slot = (slot + 1) & self.mask
            place = self.places[slot]
            found[wrong] = place
            more = (place >= 0) & (self.keys[slot] != keys[wrong])
            wrong, slot = wrong[more], slot[more]
        return found
