"""Exact duplicates by Grace hashing with tables that compare complete contents.

1. Each Arrow batch is folded by an open-addressing table: copies inside it leave one record.
2. Records are partitioned by digits of their hash. A histogram of the records' bytes says which partitions
   do not fit a table; those are split by further digits, again and again, until each fits or holds one hash
   only, whose records fold into one entry. Records then go to their partitions in one exchange, whose sorted
   files are the spill files, and each partition in turn fills a table.

Of equal texts the row with the largest ``doc_id`` stays; a null id is smaller than any other. A null text
counts as empty. Of repeated rows with the same id and text exactly one stays. Two texts of one SHA-256
would end the job. Empty tables give empty results; other columns are carried, not read.
"""

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landtiles.llm.spans import parts_of
from landtiles.session import cut

TABLE_BYTES = 32 << 20
DIGIT_BITS = 6
KEY_BITS = 63


class ContentTable:
    """Open addressing with linear probing; an entry is found by its hash and its complete content."""

    def __init__(self):
        self.slots, self.mask = [-1] * 64, 63
        self.keys: list[int] = []
        self.contents: list[bytes] = []

    def entry(self, key: int, content) -> tuple[int, bool]:
        """The number of the entry with this content, and whether it is new."""
        slot = key & self.mask
        while (at := self.slots[slot]) >= 0:
            if self.keys[at] == key and self.contents[at] == content:
                return at, False
            slot = (slot + 1) & self.mask
        at = self.slots[slot] = len(self.keys)
        self.keys.append(key)
        self.contents.append(content)
        if 2 * len(self.keys) > self.mask:
            self._grow()
        return at, True

    def _grow(self):
        self.mask = 4 * self.mask + 3
        self.slots = [-1] * (self.mask + 1)
        for at, key in enumerate(self.keys):
            slot = key & self.mask
            while self.slots[slot] >= 0:
                slot = (slot + 1) & self.mask
            self.slots[slot] = at


def hash_key(digest: bytes) -> int:
    return int.from_bytes(digest[:8], "big") >> 1


def larger(one: int | None, other: int | None) -> bool:
    return one is not None and (other is None or one > other)


def folded_batches(docs: DataFrame, carried: list[str], with_members: bool) -> DataFrame:
    """One record per content of each Arrow batch: hash, size, copies, the largest id and the columns of its row."""
    schema = "key bigint, sha binary, size bigint, keep_id bigint, copies bigint, tag bigint"
    if with_members:
        schema += ", members array<bigint>"
    carried_types = {f.name: f.dataType.simpleString() for f in docs.schema}
    schema += "".join(f", {c} {carried_types[c]}" for c in carried)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tag = TaskContext.get().partitionId() << 33
        for batch in batches:
            table, rows, digests, members = ContentTable(), [], [], []
            ids = batch.column("doc_id").to_pylist()
            for row, text in enumerate(parts_of(batch.column("text"))):
                digest = hashlib.sha256(text).digest()
                at, new = table.entry(hash_key(digest), text)
                if new:
                    rows.append(row)
                    digests.append(digest)
                    members.append([ids[row]])
                else:
                    members[at].append(ids[row])
                    if larger(ids[row], ids[rows[at]]):
                        rows[at] = row
            made = [
                pa.array(table.keys, pa.int64()),
                pa.array(digests, pa.binary()),
                pa.array([len(c) for c in table.contents], pa.int64()),
                batch.column("doc_id").take(pa.array(rows, pa.int64())),
                pa.array([len(m) for m in members], pa.int64()),
                pa.array(range(tag, tag + len(rows)), pa.int64()),
            ]
            names = ["key", "sha", "size", "keep_id", "copies", "tag"]
            if with_members:
                made.append(pa.array(members, pa.list_(pa.int64())))
                names.append("members")
            for c in carried:
                made.append(batch.column(c).take(pa.array(rows, pa.int64())))
                names.append(c)
            tag += len(rows)
            yield pa.RecordBatch.from_arrays(made, names=names)

    return docs.mapInArrow(run, schema)


def leaf_of(records: DataFrame, table_bytes: int) -> Column:
    """The partition of each record, as its leading hash digits after a one; found by splitting what does not fit."""
    key = F.col("key")
    total = records.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    bits = max(0, (2 * (total[0] + 64 * total[1]) // table_bytes).bit_length())
    levels, inside = [], records
    while bits < KEY_BITS:
        prefix = F.shiftright(key, KEY_BITS - bits)
        counted = inside.groupBy(prefix.alias("prefix")).agg(
            F.sum(F.col("size") + 64).alias("bytes"), F.min("key").alias("low"), F.max("key").alias("high")
        )
        over = [r.prefix for r in counted.where(f"bytes > {table_bytes} and low < high").select("prefix").collect()]
        levels.append((bits, over))
        if not over:
            break
        inside = inside.where(prefix.isin(over))
        bits = min(bits + DIGIT_BITS, KEY_BITS)
    leaf = F.lit(1 << KEY_BITS - 1).bitwiseOR(key) if levels and levels[-1][1] else None
    for bits, over in reversed(levels):
        prefix = F.shiftright(key, KEY_BITS - bits)
        own = prefix + F.lit(1 << bits)
        leaf = F.when(prefix.isin(over), leaf).otherwise(own) if over else own
    return leaf


def tabled(records: DataFrame, leaf: Column, carried: list[str]) -> DataFrame:
    """Per content over all records: ``sha, keep_id, group_size`` and the carried columns of the row that stays."""
    types = {f.name: f.dataType.simpleString() for f in records.schema}
    schema = "sha binary, keep_id bigint, group_size bigint" + "".join(f", {c} {types[c]}" for c in carried)
    placed = records.withColumn("leaf", leaf).repartition("leaf").sortWithinPartitions("leaf")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, best, copies, digests, now = ContentTable(), [], [], {}, None

        def flush():
            if not best:
                return
            made = [
                pa.array([digests[k] for k in table.keys], pa.binary()),
                pa.array([b[0] for b in best], pa.int64()),
                pa.array(copies, pa.int64()),
            ]
            for c in carried:
                made.append(pa.concat_arrays([batch.column(c).slice(row, 1) for _, batch, row in best]))
            yield pa.RecordBatch.from_arrays(made, names=["sha", "keep_id", "group_size", *carried])

        for batch in batches:
            keys, shas, leaves, ids, counts = (
                batch.column(c).to_pylist() for c in ("key", "sha", "leaf", "keep_id", "copies")
            )
            for row, text in enumerate(parts_of(batch.column("text"))):
                if leaves[row] != now:
                    yield from flush()
                    table, best, copies, digests, now = ContentTable(), [], [], {}, leaves[row]
                at, new = table.entry(keys[row], text)
                if new:
                    if digests.setdefault(keys[row], shas[row]) != shas[row]:
                        raise ValueError("two hashes agree in their first 63 bits; lengthen the key")
                    best.append((ids[row], batch, row))
                    copies.append(counts[row])
                else:
                    copies[at] += counts[row]
                    if larger(ids[row], best[at][0]):
                        best[at] = (ids[row], batch, row)
        yield from flush()

    return placed.mapInArrow(run, schema)


def exact_groups(docs: DataFrame, table_bytes: int = TABLE_BYTES) -> DataFrame:
    """Per row of ``docs``: ``doc_id, keep_id, group_size, kept, sha`` (SHA-256 of the text, binary)."""
    pairs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    light = cut(folded_batches(pairs, [], True), "copies")
    groups = tabled(folded_batches(pairs, ["text"], False), leaf_of(light, table_bytes), [])
    # of batches that share the largest id, the one with the smallest tag holds the row that stays
    staying = light.groupBy("sha").agg(
        F.min(F.struct(F.col("keep_id").isNull().alias("none"), F.bitwise_not("keep_id").alias("order"), "tag")).alias("first")
    )
    known = groups.join(staying, "sha").select("sha", F.col("keep_id").alias("best"), "group_size", F.col("first.tag").alias("first_tag"))
    rows = light.join(known, "sha").select(
        "sha", "best", "group_size", (F.col("tag") == F.col("first_tag")).alias("here"),
        F.when(F.col("best").isNull(), F.lit(1)).otherwise(F.array_position("members", F.col("best"))).alias("place"),
        F.posexplode("members").alias("at", "doc_id"),
    )
    return rows.select(
        "doc_id", F.col("best").alias("keep_id"), "group_size", (F.col("here") & (F.col("at") + 1 == F.col("place"))).alias("kept"), "sha"
    )


def without_copies(docs: DataFrame, table_bytes: int = TABLE_BYTES) -> DataFrame:
    """The rows of ``docs`` that stay, columns unchanged."""
    if not {"doc_id", "text"} <= set(docs.columns):
        raise ValueError("doc_id and text are needed")
    names = [f"c{i}" for i in range(len(docs.columns))]
    plain = docs.toDF(*names).withColumns(
        {
            "doc_id": F.col(names[docs.columns.index("doc_id")]).cast("bigint"),
            "text": F.coalesce(F.col(names[docs.columns.index("text")]), F.lit("")),
        }
    )
    light = cut(folded_batches(plain.select("doc_id", "text"), [], False), "copies")
    # the text is carried once; a null text among copies of the empty text comes back as it was
    others = [n for n in names if n != names[docs.columns.index("text")]]
    flag = F.col(names[docs.columns.index("text")]).isNull().alias("was_null")
    records = folded_batches(plain.select("doc_id", "text", flag, *others), ["text", "was_null", *others], False)
    found = tabled(records, leaf_of(light, table_bytes), ["text", "was_null", *others])
    back = [
        (F.when(~F.col("was_null"), F.col("text")) if c == "text" else F.col(n)).alias(c) for n, c in zip(names, docs.columns)
    ]
    return found.select(*back)
