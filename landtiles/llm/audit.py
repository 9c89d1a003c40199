"""Audit of filters that interact: what each filter removes, at each place of each order of the filters.

1. A row's failures are a mask of bits, one per filter. Whether its text occurs under a smaller ``doc_id`` is found
   on counts per text and part, so a text that a third of the rows share is a few rows when its copies meet.
2. Rows with one mask and one part are a cell: at most 32 cells a part, whatever the number of rows.
3. Each cell folds across the array of all orders with ``transform`` and ``aggregate``, which gives one struct of
   weighted counts for each step of each order; the arrays of a part's cells are merged by elementwise sums.

Null texts count as empty, null values of the part as the empty string. A row without ``doc_id`` has neither a smaller
id nor a label, and is smaller than none. Repeated rows count each; rows that share an id and a text are no copies
of one another. An id with several labels is good, or toxic, if one of them says so. An empty table gives no rows.
Other columns are not read.
"""

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landtiles.session import cut

GAP = r"[\x20\x09-\x0D]+"
MOST_CAPITALS = 3  # percent of the characters
LEAST_WORDS = 200
LEAST_DISTINCT = 50  # percent of the words
COPY = "E"
FILTERS = "ABCDE"
WEIGHTS = ("rows", "good", "toxic")
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def bit(letter: str) -> int:
    return 1 << FILTERS.index(letter)


def own_failures(text: Column) -> Column:
    """The bits of the filters that look at one text alone."""
    words = F.filter(F.split(text, GAP), lambda w: w != "")

    def failed(n, different):
        capitals = F.octet_length(text) - F.octet_length(F.regexp_replace(text, "[A-Z]+", ""))
        tests = {
            "A": n < LEAST_WORDS,
            "B": 100 * different < LEAST_DISTINCT * n,
            "C": 100 * capitals.cast("bigint") > MOST_CAPITALS * F.char_length(text).cast("bigint"),
            "D": text.rlike(r"[#$%&*|]"),
        }
        return sum((F.when(test, bit(k)).otherwise(0) for k, test in tests.items()), F.lit(0))

    # the list of words is made once: a lambda's variable stands for it in both counts
    once = F.transform(F.array(words), lambda w: failed(F.size(w).cast("bigint"), F.size(F.array_distinct(w)).cast("bigint")))
    return once[0]


def cells(docs: DataFrame, labels: DataFrame, part: str) -> DataFrame:
    """``part, mask, rows, good, toxic`` of the masks that occur in each part."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("content"),
        own_failures(text).alias("own"),
    )
    marks = labels.groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    # rows of one id first become one row per content, so that a repeated row is no hot key of the join
    same = rows.groupBy("content", "part", "own", "doc_id").agg(F.count("*").alias("rows"))
    marked = same.join(marks, "doc_id", "left").select(
        "content", "part", "own", "doc_id", "rows",
        *((F.col("rows") * F.coalesce(c, F.lit(0))).alias(c) for c in ("good", "toxic")),
    )
    # rows without an id are never copies, so they stand beside the row of the smallest id
    known = F.col("doc_id").isNotNull()
    texts = marked.groupBy("content", "part", "own").agg(
        *(F.sum(c).alias(c) for c in WEIGHTS),
        F.min(F.when(known, F.struct("doc_id", *WEIGHTS))).alias("first"),
        F.coalesce(F.sum(F.when(~known, F.col("rows"))), F.lit(0)).alias("unknown"),
    )
    texts = cut(texts, "texts")
    least = texts.groupBy("content").agg(F.min("first.doc_id").alias("least"))
    met = texts.join(least, "content")
    here = F.coalesce(F.col("first.doc_id") == F.col("least"), F.lit(False))
    clean = {c: F.when(here, F.col(f"first.{c}")).otherwise(F.lit(0).cast("bigint")) for c in WEIGHTS}
    clean["rows"] = clean["rows"] + F.col("unknown")
    sides = F.array(
        F.struct(F.col("own").alias("mask"), *(clean[c].alias(c) for c in WEIGHTS)),
        F.struct((F.col("own") + bit(COPY)).alias("mask"), *((F.col(c) - clean[c]).alias(c) for c in WEIGHTS)),
    )
    split = met.select("part", F.inline(sides)).where("rows > 0")
    return split.groupBy("part", "mask").agg(*(F.sum(c).alias(c) for c in WEIGHTS))


def orders(letters: str = FILTERS) -> Column:
    """All orders of the filters, as one constant array that goes to the tasks with the plan."""
    return F.split(F.lit(" ".join("".join(p) for p in permutations(letters))), " ")


def folded(mask: Column, weight: dict[str, Column], letters: str = FILTERS) -> Column:
    """A cell folded across all orders: one struct of counts for each step of each order."""
    none = F.lit(0).cast("bigint")

    def step(order, place, state):
        letter = F.substring(order, place, 1)
        own = F.element_at(F.create_map(*(x for k in letters for x in (F.lit(k), F.lit(bit(k))))), letter)
        fails = mask.bitwiseAND(own) != 0
        here, later = state["alive"] & fails, ~state["alive"] & fails
        counted = F.struct(
            order.alias("filter_order"),
            place.alias("step"),
            F.when(state["alive"] & ~fails, weight["rows"]).otherwise(none).alias("kept"),
            F.when(here, weight["rows"]).otherwise(none).alias("removed"),
            F.when(later, weight["rows"]).otherwise(none).alias("redundant"),
            F.when(mask == own, weight["rows"]).otherwise(none).alias("unique_fails"),
            F.when(here, weight["good"]).otherwise(none).alias("good_lost"),
            F.when(here, weight["toxic"]).otherwise(none).alias("toxic_lost"),
        )
        return F.struct((state["alive"] & ~fails).alias("alive"), F.concat(state["steps"], F.array(counted)).alias("steps"))

    kinds = "filter_order:string,step:int," + ",".join(f"{c}:bigint" for c in COUNTS)
    start = F.struct(F.lit(True).alias("alive"), F.array().cast(f"array<struct<{kinds}>>").alias("steps"))
    places = F.array(*(F.lit(i + 1) for i in range(len(letters))))

    def one(order):
        return F.aggregate(places, start, lambda state, place: step(order, place, state), lambda state: state["steps"])

    return F.flatten(F.transform(orders(letters), one))


def summed(arrays: Column) -> Column:
    """Arrays of equal layout merged by elementwise sums."""

    def both(a, b):
        return F.struct(a["filter_order"].alias("filter_order"), a["step"].alias("step"), *((a[c] + b[c]).alias(c) for c in COUNTS))

    return F.aggregate(F.slice(arrays, 2, 1 << 30), arrays[0], lambda total, one: F.zip_with(total, one, both))


def audit(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """``part, filter_order, step``, the counts after that step, and ``shapley`` of the step's filter."""
    found = cells(docs, labels, part)
    weight = {c: F.col(c) for c in WEIGHTS}
    # a part has at most 32 cells, so what is collected has a fixed bound
    merged = found.select("part", folded(F.col("mask"), weight).alias("steps")).groupBy("part").agg(
        summed(F.collect_list("steps")).alias("steps")
    )

    def everywhere(letter: str) -> Column:
        own = F.filter("steps", lambda s: F.substring(s["filter_order"], s["step"], 1) == letter)
        return F.aggregate(own, F.lit(0).cast("bigint"), lambda total, s: total + s["removed"])

    sums = merged.select("part", "steps", F.create_map(*(x for k in FILTERS for x in (F.lit(k), everywhere(k)))).alias("sums"))
    rows = sums.select("part", "sums", F.inline("steps"))
    letter = F.substring(F.col("filter_order"), F.col("step"), F.lit(1))
    return rows.select("part", "filter_order", "step", *COUNTS, F.element_at("sums", letter).alias("shapley"))
