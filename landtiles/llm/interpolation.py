"""Language-model scores by deleted interpolation of word bigrams, words and a uniform share.

The probability of a token after another one mixes the maximum-likelihood estimates of the pair and of the token
with 1 / (V + 1). Mixture weights depend on a bucket of the context's frequency and are learned by expectation
maximisation on held-out counts: each training token is scored by the counts of all training text without itself.

Counts cover all training rows. Texts lie in blocks; a block asks for the counts of its distinct words and pairs,
and tells how often its training rows hold them. Requests meet by ranges of the hash, at most one per block and
gram, are summed, and each block gets its counts back. Nothing of the vocabulary is broadcast or collected; the
driver sees N, V and a histogram of rounded probabilities whose size does not depend on the rows.

Null and empty texts consist of the end token. Repeated rows count and are scored each. Rows without an id are in fold
0, so they are learned from. An empty table gives an empty result; without training rows the score is that of the uniform
share. Other columns are not read. Blocks follow the order of the scan, so hand in a stored table, whose rows come in the
same order when a task runs again; a block that differs from its request ends the job.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landtiles.llm.common import fold
from landtiles.llm.spans import chunks, mixed, owners, paired
from landtiles.session import cut

BLOCK_BYTES = 8 << 20
FOLDS, HELD_OUT = 7, 2
START, END = (mixed(np.array([k], np.uint64), 900)[0] for k in (1, 2))
BUCKETS = 48  # of the context's frequency, by powers of two
STEPS = 4  # rounded probabilities per factor of two, in the histogram for EM
ROUNDS = 60


# ---- number arrays as short byte strings


def squeezed(values: np.ndarray) -> bytes:
    """Numbers as compressed planes of their bytes, with the count in front."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T)
    return len(values).to_bytes(8, "little") + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def restored(blob: bytes, kind) -> np.ndarray:
    count, width = int.from_bytes(blob[:8], "little"), np.dtype(kind).itemsize
    if not count:
        return np.zeros(0, kind)
    planes = np.frombuffer(pa.decompress(blob[8:], count * width, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(width, count).T).view(kind).ravel()


def squeezed_sorted(values: np.ndarray) -> bytes:
    return squeezed(np.diff(values, prepend=np.uint64(0)))


def restored_sorted(blob: bytes) -> np.ndarray:
    return np.cumsum(restored(blob, np.uint64), dtype=np.uint64)


# ---- tokens of a block


def token_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens of the texts, an end after each, and where each text's tokens begin and end."""
    tokens, sizes = [], []
    for _, _, texts in chunks(column):
        low = texts.lowered()
        start, end, bounds = low.words()
        count = np.diff(bounds)
        found = np.full(len(start) + len(texts), END, np.uint64)
        found[np.arange(len(start)) + owners(bounds)] = low.hashes(start, end)
        tokens.append(found)
        sizes.append(count + 1)
    if not tokens:
        return np.zeros(0, np.uint64), np.zeros(1, np.int64)
    return np.concatenate(tokens), np.append(0, np.cumsum(np.concatenate(sizes)))


def pair_hashes(tokens: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The hash of each token with the one before it in its text, or with the start."""
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[bounds[:-1]] = START
    return paired(before, tokens, 3)


def grams(column: pa.Array) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Bounds of the texts' tokens; for words, then pairs: the distinct hashes, and each token's place among them."""
    tokens, bounds = token_hashes(column)
    return bounds, [np.unique(x, return_inverse=True) for x in (tokens, pair_hashes(tokens, bounds))]


# ---- counts


def with_blocks(docs: DataFrame, block_bytes: int) -> tuple[DataFrame, int]:
    """``doc_id, text, train, block`` with the rows of a block together, and the number of blocks."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text") + 64), F.lit(0))).first()[0]
    count = max(1, -(-size // block_bytes))
    # the row number deals the copies of a repeated row over all blocks
    block = F.pmod(F.xxhash64("doc_id", F.monotonically_increasing_id()), F.lit(count))
    train = fold("doc_id", FOLDS) != HELD_OUT
    return rows.withColumns({"train": train, "block": block}).repartition(count, "block"), count


def requests(blocks: DataFrame, part_bits: int) -> DataFrame:
    """Per block, kind of gram and range of hashes: the block's distinct hashes and their training counts."""

    def ask(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        bounds, kinds = grams(table.column("text").combine_chunks())
        train = np.repeat(table.column("train").to_numpy(), np.diff(bounds))
        block, rows = table.column("block")[0].as_py(), []
        for kind, (known, place) in enumerate(kinds):
            count = np.bincount(place, train, len(known)).astype(np.uint32)
            part = (known >> np.uint64(64 - part_bits)).astype(np.int64) if part_bits else np.zeros(len(known), np.int64)
            edges = np.append(np.flatnonzero(np.diff(part, prepend=-1)), len(known)).tolist()
            for at, to in zip(edges[:-1], edges[1:]):
                rows.append((block, kind, int(part[at]), squeezed_sorted(known[at:to]), squeezed(count[at:to])))
        return pa.Table.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary()))],
            names=["block", "kind", "part", "hashes", "counts"],
        )

    return blocks.groupBy("block").applyInArrow(ask, "block bigint, kind int, part bigint, hashes binary, counts binary")


def answers(asked: DataFrame, parts: int) -> DataFrame:
    """The requests with counts over all blocks in place of their own, and rows of a negative block with N and V."""
    placed = asked.repartition(parts, "kind", "part").sortWithinPartitions("kind", "part")
    names = ["block", "kind", "part", "counts", "tokens", "distinct"]

    def summed(rows: list[dict]) -> pa.RecordBatch:
        pieces = [restored_sorted(r["hashes"]) for r in rows]
        known, place = np.unique(np.concatenate(pieces), return_inverse=True)
        total = np.bincount(place, np.concatenate([restored(r["counts"], np.uint32) for r in rows]), len(known)).astype(np.uint64)
        out, at = [], 0
        for row, piece in zip(rows, pieces):
            out.append((row["block"], row["kind"], row["part"], squeezed(total[place[at : at + len(piece)]]), None, None))
            at += len(piece)
        if rows[0]["kind"] == 0:
            out.append((-1 - rows[0]["part"], 0, rows[0]["part"], None, int(total.sum()), int((total > 0).sum())))
        types = (pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if waiting and (row["kind"], row["part"]) != (waiting[0]["kind"], waiting[0]["part"]):
                    yield summed(waiting)
                    waiting = []
                waiting.append(row)
        if waiting:
            yield summed(waiting)

    return placed.mapInArrow(run, "block bigint, kind int, part bigint, counts binary, tokens bigint, distinct bigint")


def counted_tokens(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per block: its ids, folds and token numbers, and for all its tokens the counts of the word and of the pair.

    Rows of a negative block hold parts of N (``tokens``) and V (``distinct``).
    """
    blocks, count = with_blocks(docs, block_bytes)
    part_bits = max(0, (count - 1).bit_length())
    returned = answers(requests(blocks, part_bits), 1 << part_bits)
    schema = (
        "block bigint, doc_ids array<bigint>, train array<boolean>, sizes array<bigint>, words binary, pairs binary,"
        " tokens bigint, distinct bigint"
    )
    names = [x.split()[0] for x in schema.split(", ")]

    def lay(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left):
            row = right.to_pylist()[0]
            made = [[row["block"]], [None], [None], [None], [None], [None], [row["tokens"]], [row["distinct"]]]
        else:
            left = left.combine_chunks()
            bounds, kinds = grams(left.column("text").combine_chunks())
            back = sorted(right.select(["kind", "part", "counts"]).to_pylist(), key=lambda r: (r["kind"], r["part"]))
            laid = []
            for kind, (known, place) in enumerate(kinds):
                every = np.concatenate([restored(r["counts"], np.uint64) for r in back if r["kind"] == kind])
                if len(every) != len(known):
                    raise ValueError("a block changed between its request and the answer")
                laid.append(squeezed(every[place]))
            ids, train = left.column("doc_id").to_pylist(), left.column("train").to_pylist()
            made = [[left.column("block")[0].as_py()], [ids], [train], [np.diff(bounds).tolist()], [laid[0]], [laid[1]], [None], [None]]
        types = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.int64(), pa.int64()]
        return pa.Table.from_arrays([pa.array(m, t) for m, t in zip(made, types)], names=names)

    return blocks.groupBy("block").cogroup(returned.groupBy("block")).applyInArrow(lay, schema)


# ---- mixture weights


def contexts(words: np.ndarray, sizes: np.ndarray, starts: int) -> np.ndarray:
    """How often each token's context is followed by something in training text."""
    before = np.empty_like(words)
    before[1:] = words[:-1]
    before[np.append(0, np.cumsum(sizes)[:-1])] = starts
    return before


def bucket_of(frequency: np.ndarray) -> np.ndarray:
    return np.minimum(np.frexp(frequency.astype(float))[1], BUCKETS - 1)


def unpacked(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    words, pairs = (restored(row[c], np.uint64).astype(np.int64) for c in ("words", "pairs"))
    sizes = np.array(row["sizes"], np.int64)
    return words, pairs, sizes


def histogram(counted: DataFrame, tokens: int, starts: int) -> DataFrame:
    """How many training tokens have each bucket and rounded pair and word probability, themselves left out.

    Probabilities are rounded in their logarithm; -1 stands for zero.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                words, pairs, sizes = unpacked(row)
                train = np.repeat(np.array(row["train"], bool), sizes)
                context = contexts(words, sizes, starts)[train] - 1
                p2 = (pairs[train] - 1) / np.maximum(context, 1)
                p1 = (words[train] - 1) / max(tokens - 1, 1)
                cells = [bucket_of(context)]
                for p in (p2, p1):
                    cells.append(np.where(p > 0, np.rint(-STEPS * np.log2(np.maximum(p, 1e-30))), -1).astype(np.int64))
                code, count = np.unique((cells[0] << 32) + ((cells[1] + 1) << 16) + cells[2] + 1, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(count)], names=["code", "n"])

    cells = counted.where("block >= 0").select("train", "sizes", "words", "pairs").mapInArrow(run, "code bigint, n bigint")
    return cells.groupBy("code").agg(F.sum("n").alias("n"))


def mixture(cells: list[tuple[int, int]], distinct: int, rounds: int = ROUNDS) -> np.ndarray:
    """Weights of pair, word and uniform share per bucket, by expectation maximisation over the histogram."""
    weights = np.tile([0.4, 0.55, 0.05], (BUCKETS, 1))
    weights[0] = [0.0, 0.9, 0.1]  # nothing is known about a context never seen
    if not cells:
        return weights
    code, n = np.array(cells, np.int64).T
    bucket, second, first = code >> 32, ((code >> 16) & 0xFFFF) - 1, (code & 0xFFFF) - 1
    p = [np.where(k < 0, 0.0, np.exp2(-k / STEPS)) for k in (second, first)]
    given = np.column_stack([*p, np.full(len(n), 1.0 / (distinct + 1))])
    for _ in range(rounds):
        share = weights[bucket] * given
        share *= (n / share.sum(axis=1))[:, None]
        for b in np.unique(bucket):
            total = share[bucket == b].sum(axis=0) + [0.0, 0.0, 1e-3]
            weights[b] = total / total.sum()
    return weights


# ---- scores


def scores(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per row of ``docs``: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``; logs to base 10."""
    counted = cut(counted_tokens(docs, block_bytes), "tokens")
    totals = counted.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("distinct"), F.lit(0))).first()
    tokens, distinct = totals
    starts = docs.where(fold("doc_id", FOLDS) != HELD_OUT).count()
    cells = [(r.code, r.n) for r in histogram(counted, tokens, starts).collect()]
    weights = mixture(cells, distinct)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                words, pairs, sizes = unpacked(row)
                context = contexts(words, sizes, starts)
                mix = weights[bucket_of(context)]
                p = mix[:, 0] * pairs / np.maximum(context, 1) + mix[:, 1] * words / max(tokens, 1) + mix[:, 2] / (distinct + 1)
                base = np.log10((words + 1) / (tokens + distinct + 1))
                first = np.append(0, np.cumsum(sizes)[:-1])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row["doc_ids"], pa.int64()),
                        pa.array([not t for t in row["train"]]),
                        pa.array(sizes),
                        pa.array(np.add.reduceat((words > 0).astype(np.int64), first)),
                        pa.array(np.full(len(sizes), tokens, np.int64)),
                        pa.array(np.add.reduceat(base, first)),
                        pa.array(np.add.reduceat(np.log10(np.maximum(p, 1e-300)), first)),
                    ],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                )

    schema = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    return counted.where("block >= 0").select("doc_ids", "train", "sizes", "words", "pairs").mapInArrow(run, schema)
