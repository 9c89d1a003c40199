"""Shards of nearly equal bytes by histogram sort, in DataFrame operations only.

Rows are ordered by a hash of their text, so equal texts lie together, and by a hash of id and row number within
it. The bytes below candidate boundaries are counted exactly over all partitions; around each wanted splitter the
boundaries are refined until the bytes below one of them meet the tolerance. Then rows are exchanged once, into
ranges of bounded row count inside the shards, and numbered.

Null and empty texts have size 1 (their end). Repeated rows have order keys of their own, so a boundary may lie
between them. An empty table gives an empty result. Other columns are carried by ``shards`` unless their
names are those of the result, which then win. Row numbers follow the order of the scan, so hand in a stored table,
whose rows come in the same order when a task runs again.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landtiles.session import cut

SHARDS = 16
TOLERANCE = 0.0005  # of one shard's bytes
RANGE_ROWS = 250_000
KEY_BITS = 63
PROBE_BITS = 8  # each refinement looks at 256 boundaries inside an interval


@dataclass(frozen=True)
class Splitter:
    """Rows whose (high, low) key is smaller lie before it."""

    high: int
    low: int


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with ``size`` and the order key ``high, low``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.withColumns(
        {
            "size": F.octet_length(text).cast("bigint") + 1,
            "high": F.shiftrightunsigned(F.xxhash64(text), 1),
            "low": F.shiftrightunsigned(F.xxhash64("doc_id", F.monotonically_increasing_id()), 1),
        }
    )


def _histogram(rows: DataFrame, interval: Column, slot: Column) -> dict:
    counted = rows.groupBy(interval.alias("interval"), slot.alias("slot")).agg(F.sum("size").alias("bytes"))
    found: dict = {}
    for r in counted.collect():
        found.setdefault(r.interval, []).append((r.slot, r.bytes))
    return {k: sorted(v) for k, v in found.items()}


def find_splitters(rows: DataFrame, shards: int, tolerance: float = TOLERANCE) -> list[Splitter]:
    """``shards - 1`` splitters whose bytes below are within the tolerance of even shares, or as near as rows allow."""
    total = rows.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    slack = tolerance * total / shards
    found: dict[int, Splitter] = {}
    # open: target number -> (bytes before its interval, where the interval starts, bits known)
    open_high = {t: (0, 0, 0) for t in range(1, shards)} if total else {}
    open_low: dict[int, tuple[int, int, int, int]] = {}

    def narrowed(target, before, slots, width):
        """The nearest boundary of the slots, how far it is off, and the slot that holds the target."""
        want, below, best = total * target / shards, before, (abs(before - total * target / shards), None, before)
        holder = None
        for slot, size in slots:
            if below <= want < below + size:
                holder = (slot, below)
            below += size
            best = min(best, (abs(below - want), slot + 1, below), key=lambda b: b[0])
        return best, holder

    while open_high:
        bits = next(iter(open_high.values()))[2]
        after = min(bits + PROBE_BITS, KEY_BITS)
        starts = sorted({v[1] for v in open_high.values()})
        interval = F.shiftright("high", KEY_BITS - bits) if bits else F.lit(0)
        slots = _histogram(rows.where(interval.isin(starts)), interval, F.shiftright("high", KEY_BITS - after))
        nearer = {}
        for target, (before, start, _) in open_high.items():
            (off, edge, _), holder = narrowed(target, before, slots.get(start, []), after)
            if off <= slack or holder is None:
                first = (start << (after - bits)) if edge is None else edge
                found[target] = Splitter(first << (KEY_BITS - after), 0)
            elif after == KEY_BITS:
                open_low[target] = (holder[1], 0, 0, holder[0])
            else:
                nearer[target] = (holder[1], holder[0], after)
        open_high = nearer
    while open_low:
        bits = next(iter(open_low.values()))[2]
        after = min(bits + PROBE_BITS, KEY_BITS)
        highs = sorted({v[3] for v in open_low.values()})
        starts = sorted({v[1] for v in open_low.values()})
        prefix = F.shiftright("low", KEY_BITS - bits) if bits else F.lit(0).cast("bigint")
        chosen = rows.where(F.col("high").isin(highs) & prefix.isin(starts))
        slots = _histogram(chosen, F.struct("high", prefix.alias("prefix")), F.shiftright("low", KEY_BITS - after))
        nearer = {}
        for target, (before, start, _, high) in open_low.items():
            (off, edge, _), holder = narrowed(target, before, slots.get((high, start), []), after)
            if off <= slack or holder is None or after == KEY_BITS:
                first = (start << (after - bits)) if edge is None else edge
                found[target] = Splitter(high, first << (KEY_BITS - after))
            else:
                nearer[target] = (holder[1], holder[0], after, high)
        open_low = nearer
    return [found[t] for t in sorted(found)]


def shard_of(splitters: list[Splitter]) -> Column:
    """How many splitters lie at or before the row's key."""
    total = F.lit(0)
    for s in splitters:
        behind = (F.col("high") > s.high) | ((F.col("high") == s.high) & (F.col("low") >= s.low))
        total = total + behind.cast("int")
    return total


def numbered(rows: DataFrame, splitters: list[Splitter], range_rows: int = RANGE_ROWS) -> DataFrame:
    """``rows`` with ``shard`` and ``slot``, its place in the shard, without gaps from 0.

    A shard is dealt to tasks by ranges of at most about ``range_rows`` rows: by leading bits of the text's hash
    (``cell``), and a text that alone has more copies than that by leading bits of ``low`` (``part``).
    """
    count = rows.count()
    bits = max(0, (4 * count // range_rows).bit_length())
    cell = F.shiftright("high", KEY_BITS - bits) if bits else F.lit(0).cast("bigint")
    placed = rows.withColumns({"shard": shard_of(splitters), "cell": cell})
    crowded = placed.groupBy("cell").count().where(f"count > {range_rows}").select("cell")
    # at most count / range_rows cells or texts can be that large, so both tables are bounded
    heavy = (
        placed.join(F.broadcast(crowded), "cell", "left_semi")
        .groupBy("high")
        .count()
        .where(f"count > {range_rows}")
        .select("high", F.ceil(F.col("count") / range_rows).alias("parts"))
    )
    width = F.lit(float(1 << KEY_BITS)) / F.col("parts")
    placed = placed.join(F.broadcast(heavy), "high", "left").withColumns(
        {
            "alone": F.when(F.col("parts").isNull(), F.lit(-1).cast("bigint")).otherwise(F.col("high")),
            "part": F.coalesce(F.floor(F.col("low") / width), F.lit(0)),
        }
    )
    run = ["shard", "cell", "alone", "part"]
    before = Window.partitionBy("shard").orderBy("cell", "alone", "part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy(*run).count().select(*run, F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first"))
    place = F.row_number().over(Window.partitionBy(*run).orderBy("high", "low"))
    return (
        placed.withColumn("place", place)
        .join(offsets, run)
        .withColumn("slot", F.col("first") + F.col("place") - 1)
        .drop("cell", "alone", "part", "parts", "first", "place")
    )


def shards(docs: DataFrame, count: int = SHARDS, tolerance: float = TOLERANCE, range_rows: int = RANGE_ROWS) -> DataFrame:
    """``docs`` with ``size, high, low, shard, slot`` (order key and place), exchanged into its shards."""
    # the columns travel by number, so their names cannot clash with those used on the way
    names = [f"in_{i}" for i in range(len(docs.columns))]
    known = {c: F.col(names[docs.columns.index(c)]) for c in ("doc_id", "text")}
    rows = keyed(docs.toDF(*names).withColumns(known)).drop(*known)
    placed = numbered(rows, find_splitters(cut(rows.select("size", "high", "low"), "order"), count, tolerance), range_rows)
    made = ["size", "high", "low", "shard", "slot"]
    carried = [F.col(n).alias(c) for n, c in zip(names, docs.columns) if c not in made]
    return placed.select(*carried, *made)
