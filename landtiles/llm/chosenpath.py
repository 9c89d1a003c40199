"""Near duplicates by a chosen-path similarity join on sets of word shingles.

A text's set is that of its 5-word shingles (A-Z in lower case), or its whole word sequence if shorter. Equal sets
are one class from the start. Each class has a signature of minwise tokens. Several independent trees branch the
classes by tokens: the root of tree t sends a class to the node of its t-th token; a node that is small is compared
exhaustively, a larger one branches again, each class following ``BRANCHES`` further tokens. Two classes of Jaccard
similarity s stay together in one tree with probability s at the root and 1 - (1 - s)**2 at each level below, so eight
trees miss a pair at 0.85 with probability below 1e-5 even three levels down. Nodes still large at the last level
are compared in pairs of blocks, so no candidate is dropped.

A small node is first split by signatures into clusters that may hold links; the same cluster in several trees is one.
Each cluster then gets the full sets, whose exact overlaps are one matrix product, and gives as many links as
its components need. The classes of a large node are checked on full sets against one pivot before it branches; nodes
whose classes lie in one component have nothing left to find. So a large group of near copies costs one
check per member and tree, and no step gives more rows than it has members.

Texts without words, null ones included, have empty sets and are linked with nothing. Repeated rows share a class.
Rows without ``doc_id`` take part in a class, but cannot name a component: theirs is that of their class,
or null. Other columns are not read.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from landtiles.llm.common import give_back
from landtiles.llm.components import components
from landtiles.llm.spans import Texts, chunks, mixed, paired
from landtiles.session import cut

SHINGLE_WORDS = 5
PERCENT = 85
POSITIONS = 128  # minwise tokens that a signature keeps one byte of
TOKENS = 24  # of these, so many are kept in 4 bytes, to branch by
TREES = 8
BRANCHES = 2
SMALL_NODE = 2048
LEVELS = 6
COLUMNS = 4096  # shingles of a cluster multiplied at once

_MULTIPLIERS = mixed(np.arange(POSITIONS, dtype=np.uint64), 77) | np.uint64(1)
_MASKS = mixed(np.arange(POSITIONS, dtype=np.uint64), 78)


def shingle_sets(texts: Texts, words: int = SHINGLE_WORDS) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    low = texts.lowered()
    start, end, bounds = low.words()
    word = low.hashes(start, end)
    count = np.diff(bounds)
    run = word
    for size in range(2, words + 1):
        run = paired(run[: max(len(word) - size + 1, 0)], word[size - 1 :], size)
    sets = []
    for i, n in enumerate(count.tolist()):
        at = bounds[i]
        if n >= words:
            sets.append(np.unique(run[at : at + n - words + 1]))
        elif n:
            whole = word[at : at + 1]
            for k in range(1, n):
                whole = paired(whole, word[at + k : at + k + 1], 100 + n)
            sets.append(mixed(whole, 200 + n))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def digest_of(shingles: np.ndarray) -> bytes:
    """128 bits that name a set: two sums of independent hashes of its members."""
    sums = [mixed(shingles, seed).sum(dtype=np.uint64) for seed in (301, 302)]
    return np.array(sums, np.uint64).tobytes()


def signatures(sets: list[np.ndarray]) -> list[bytes]:
    """For each set that is not empty, the smallest values of the hash functions: some whole, then a byte of each."""
    filled = [s for s in sets if len(s)]
    if not filled:
        return []
    every = np.concatenate(filled)
    first = np.append(0, np.cumsum([len(s) for s in filled])[:-1])
    found = np.empty((len(filled), POSITIONS), np.uint32)
    for k in range(POSITIONS):
        values = ((every ^ _MASKS[k]) * _MULTIPLIERS[k]) >> np.uint64(32)
        found[:, k] = np.minimum.reduceat(values, first)
    whole, short = found[:, :TOKENS].copy(), (mixed(found) & np.uint64(255)).astype(np.uint8)
    return [w.tobytes() + b.tobytes() for w, b in zip(whole, short)]


def sketches(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, digest, signature`` of each row; the last two are null for an empty set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, texts in chunks(batch.column("text")):
                sets = shingle_sets(texts)
                rows = iter(signatures(sets))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(first, last - first),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([digest_of(s) if len(s) else None for s in sets], pa.binary()),
                        pa.array([next(rows) if len(s) else None for s in sets], pa.binary()),
                    ],
                    names=["doc_id", "n_shingles", "digest", "signature"],
                )
        give_back()

    return plain(docs).mapInArrow(run, "doc_id bigint, n_shingles bigint, digest binary, signature binary")


def plain(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")


def least_agreeing(percent: int) -> int:
    """Equal positions that a linked pair has but for one case in millions."""
    s = percent / 100
    return int(POSITIONS * s - 5 * (POSITIONS * s * (1 - s)) ** 0.5)


def token(position: int):
    """The minwise token of a position, as a column."""
    return F.substring("signature", 4 * position + 1, 4)


def full_sets(needed: DataFrame, docs: DataFrame) -> DataFrame:
    """``digest, shingles`` of the classes in ``needed``, read again from one text of each."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, texts in chunks(batch.column("text")):
                found = [s for s in shingle_sets(texts) if len(s)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([digest_of(s) for s in found], pa.binary()), pa.array([s.tobytes() for s in found], pa.binary())],
                    names=["digest", "shingles"],
                )

    ids = needed.select(F.col("rep").alias("doc_id")).distinct()
    rows = plain(docs).join(ids, "doc_id", "left_semi").select("text").mapInArrow(sets, "digest binary, shingles binary")
    return cut(rows.groupBy("digest").agg(F.min("shingles").alias("shingles")), "sets")


def confirmed(pairs: DataFrame, classes: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` whose full sets are similar enough."""
    named = classes.select("vid", "digest", "rep")
    for x in "ab":
        pairs = pairs.join(named.select(F.col("vid").alias(x), F.col("digest").alias(f"d{x}"), F.col("rep").alias(f"r{x}")), x)
    pairs = cut(pairs, "pairs")
    full = full_sets(pairs.select(F.col("ra").alias("rep")).union(pairs.select("rb")), docs)
    sides = [full.select(F.col("digest").alias(f"d{x}"), F.col("shingles").alias(f"s{x}")) for x in "ab"]
    joined = pairs.select("a", "b", "da", "db").join(sides[0], "da").join(sides[1], "db")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for one, two in zip(batch.column("sa").to_pylist(), batch.column("sb").to_pylist()):
                x, y = np.frombuffer(one, np.uint64), np.frombuffer(two, np.uint64)
                shared = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * shared >= percent * (len(x) + len(y) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return joined.select("a", "b", "sa", "sb").mapInArrow(compare, "a bigint, b bigint")


def spanning(count: int, near) -> list[tuple[int, np.ndarray]]:
    """A walk through the components of a graph: each vertex with the new ones met from it.

    ``near(i)`` tells for all vertices whether they are adjacent to ``i``. A component's first vertex comes with itself.
    """
    left, walk = np.ones(count, bool), []
    for i in range(count):
        if not left[i]:
            continue
        left[i] = False
        walk.append((i, np.array([i])))
        waiting = [i]
        while waiting and left.any():
            j = waiting.pop()
            fresh = np.flatnonzero(near(j) & left)
            left[fresh] = False
            if len(fresh):
                walk.append((j, fresh))
                waiting += fresh.tolist()
    return walk


def clustered(members: pd.DataFrame, least: int) -> pd.DataFrame:
    """The classes of a node, split where signatures exclude a link; clusters of one component are left out.

    A cluster is named by its members.
    """
    members = members.sort_values("vid")
    vid, label = members["vid"].to_numpy(), members["label"].to_numpy()
    short = np.array([np.frombuffer(s, np.uint8)[4 * TOKENS :] for s in members["signature"]])
    name = np.zeros(len(vid), np.int64)
    for i, fresh in spanning(len(vid), lambda j: np.count_nonzero(short == short[j], axis=1) >= least):
        name[fresh] = i if i in fresh else name[i]
    found = []
    order = np.argsort(name, kind="stable")
    for run in np.split(order, np.flatnonzero(np.diff(name[order])) + 1):
        if len(set(label[run])) > 1:
            key = mixed(vid[run].astype(np.uint64), 401).sum(dtype=np.uint64)
            found.append(pd.DataFrame({"cluster": key.astype(np.int64), "vid": vid[run]}))
    return pd.concat(found) if found else pd.DataFrame({"cluster": np.zeros(0, np.int64), "vid": np.zeros(0, np.int64)})


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """How many members each two sets share, as products of blocks of the membership matrix."""
    sizes = [len(s) for s in sets]
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row, shared = np.repeat(np.arange(len(sets)), sizes), count > 1
    dense = np.cumsum(shared) - 1
    keep = shared[column]
    row, column = row[keep], dense[column[keep]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    total = np.zeros((len(sets), len(sets)), np.float32)
    width = int(dense[-1]) + 1
    for first in range(0, width, COLUMNS):
        at, to = np.searchsorted(column, [first, first + COLUMNS])
        block = np.zeros((len(sets), min(COLUMNS, width - first)), np.float32)
        block[row[at:to], column[at:to] - first] = 1.0
        total += block @ block.T
    return total


def linked(members: pd.DataFrame, percent: int) -> pd.DataFrame:
    """Links that join the classes of a cluster as their full sets do, one fewer than classes for each component."""
    vid = members["vid"].to_numpy()
    sets = [np.frombuffer(s, np.uint64) for s in members["shingles"]]
    size = np.array([len(s) for s in sets], np.float64)
    both = overlaps(sets)
    near = lambda i: 100.0 * both[i] >= percent * (size + size[i] - both[i])
    links = [(vid[i], v) for i, fresh in spanning(len(vid), near) for v in vid[fresh] if v != vid[i]]
    return pd.DataFrame(links, columns=["a", "b"]).astype(np.int64)


def mixed_nodes(members: DataFrame) -> DataFrame:
    """``node, n`` of the nodes whose classes lie in more than one component."""
    found = members.groupBy("node").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("n"))
    return found.where("low < high").select("node", "n")


def link_classes(classes: DataFrame, docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``vid, label`` of the classes that are linked with another one."""
    least, signed = least_agreeing(percent), classes.select("vid", "signature")
    roots = F.explode(F.array(*(F.struct(F.lit(t).alias("tree"), F.xxhash64(F.lit(t), token(t)).alias("node")) for t in range(TREES))))
    members = classes.select("vid", roots.alias("at")).select("at.node", "at.tree", "vid")
    nodes = members.groupBy("node").agg(F.count("*").alias("n")).where("n > 1")
    now = members.join(nodes, "node").withColumn("label", F.col("vid"))
    now = cut(now, "level")
    links, clusters, level = None, [], 0
    while True:
        small = now.where(f"n <= {SMALL_NODE}").select("node", "vid", "label").join(signed, "vid")
        clusters.append(small.groupBy("node").applyInPandas(lambda m: clustered(m, least), "cluster bigint, vid bigint"))
        large = now.where(f"n > {SMALL_NODE}")
        if large.isEmpty():
            break
        if level == LEVELS:
            blocks = F.ceil(F.col("n") / (SMALL_NODE // 2)).cast("int")
            own = F.pmod(F.xxhash64("vid"), blocks).cast("int")
            split = large.withColumns({"own": own, "other": F.explode(F.sequence(F.lit(0), blocks - 1))})
            pair = F.xxhash64("node", F.least("own", "other"), F.greatest("own", "other"))
            both = split.select(pair.alias("node"), "vid", "label").join(signed, "vid")
            clusters.append(both.groupBy("node").applyInPandas(lambda m: clustered(m, least), "cluster bigint, vid bigint"))
            break
        # link with a pivot what can be, leave nodes of one component, branch the others
        pivots = large.groupBy("node").agg(F.min_by("vid", F.xxhash64("vid", "tree")).alias("pivot"))
        star = large.join(pivots, "node").where("vid != pivot")
        star = star.select(F.least("vid", "pivot").alias("a"), F.greatest("vid", "pivot").alias("b")).distinct()
        fresh = cut(confirmed(star, classes, docs, percent), "links")
        links = fresh if links is None else links.union(fresh)
        labels = components(links)
        steps = []
        for branch in range(BRANCHES):
            at = F.pmod(F.xxhash64(F.lit(level), F.lit(branch), "tree"), F.lit(TOKENS)).cast("int")
            value = F.expr("substring(signature, 4 * position + 1, 4)")
            step = large.join(signed, "vid").withColumn("position", at)
            steps.append(step.select(F.xxhash64("node", "position", value).alias("node"), "tree", "vid"))
        children = steps[0]
        for step in steps[1:]:
            children = children.union(step)
        children = children.join(labels, "vid", "left").withColumn("label", F.coalesce("label", "vid"))
        now = cut(children.join(mixed_nodes(children), "node"), "level")
        level += 1
    every = clusters[0]
    for part in clusters[1:]:
        every = every.union(part)
    every = cut(every.distinct().join(classes.select("vid", "digest", "rep"), "vid"), "clusters")
    sets = full_sets(every, docs)
    groups = every.select("cluster", "vid", "digest").join(sets, "digest").select("cluster", "vid", "shingles")
    fresh = cut(groups.groupBy("cluster").applyInPandas(lambda m: linked(m, percent), "a bigint, b bigint"), "links")
    return components(fresh if links is None else links.union(fresh))


def near_groups(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_shingles, component_id, kept``."""
    return grouped_rows(docs, percent).drop("digest")


def grouped_rows(docs: DataFrame, percent: int) -> DataFrame:
    """The same with ``digest``, which names the row's set."""
    rows = cut(sketches(docs), "sketches")
    classes = rows.where("digest is not null").groupBy("digest").agg(
        F.min("doc_id").alias("rep"), F.min("signature").alias("signature")
    )
    classes = cut(classes.withColumn("vid", F.monotonically_increasing_id()), "classes")
    labels = link_classes(classes.where("rep is not null"), docs, percent)
    named = classes.select("digest", "vid", "rep").join(labels, "vid")
    heads = named.groupBy("label").agg(F.min("rep").alias("head"))
    linked = cut(named.join(heads, "label").select("digest", "head"), "heads")
    classes = cut(classes.select("digest", "rep").join(linked, "digest", "left").select("digest", F.coalesce("head", "rep").alias("head")), "heads")
    found = rows.select("doc_id", "n_shingles", "digest").join(classes, "digest", "left")
    component = F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("head"))
    return found.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(component == F.col("doc_id"), component.isNull()).alias("kept"), "digest",
    )


def with_digests(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with the name of each row's set; ``docs`` has columns ``doc_id`` and ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests = [
                digest_of(s) if len(s) else None for _, _, texts in chunks(batch.column("text")) for s in shingle_sets(texts)
            ]
            yield batch.append_column(name, pa.array(digests, pa.binary()))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, f"{schema}, {name} binary")


def without_near_copies(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that name their group, columns unchanged: one row of each group, and all rows without words.

    Where several rows share an id, or have none, each goes by its own set, and of those with one id and set
    the row with the smallest text stays.
    """
    names = [f"c{i}" for i in range(len(docs.columns))]
    plain_names = docs.toDF(*names).withColumns(
        {c: F.col(names[docs.columns.index(c)]).cast(t) for c, t in (("doc_id", "bigint"), ("text", "string"))}
    )
    found = cut(grouped_rows(docs, percent), "grouped")
    ids = found.groupBy("doc_id").agg(F.count("*").alias("n"), F.bool_and("kept").alias("kept"), F.bool_or(F.col("digest").isNotNull()).alias("filled"))
    several = (F.col("n") > 1) | F.col("doc_id").isNull()
    ids = cut(ids.withColumn("several", several & F.col("filled")).where("several or not kept"), "changed")
    alone = plain_names.join(ids, plain_names["doc_id"].eqNullSafe(ids["doc_id"]), "left_anti").select(*names)
    shared = ids.where("several").select("doc_id")
    if shared.isEmpty():
        return alone.toDF(*docs.columns)
    rows = with_digests(plain_names.join(shared, plain_names["doc_id"].eqNullSafe(shared["doc_id"]), "left_semi"), "digest")
    kept = found.where("kept and digest is not null").select("doc_id", "digest").distinct()
    same = rows["doc_id"].eqNullSafe(kept["doc_id"]) & (rows["digest"] == kept["digest"])
    first = F.row_number().over(Window.partitionBy("doc_id", "digest").orderBy("text"))
    chosen = rows.join(kept, same, "left_semi").withColumn("first", first).where("first = 1").select(*names)
    wordless = rows.where("digest is null").select(*names)
    return alone.union(chosen).union(wordless).toDF(*docs.columns)
