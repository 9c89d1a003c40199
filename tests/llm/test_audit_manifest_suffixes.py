import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from landtiles.llm import audit, merkle, suffixes
from llm.conftest import edited_copies, prose, table

# ---- filter audit


def mask_of(doc_id, text, least):
    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    fails = [
        len(words) < 200,
        100 * len(set(words)) < 50 * len(words),
        100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
        bool(re.search(r"[#$%&*|]", text)),
        doc_id is not None and least.get(text, doc_id) < doc_id,
    ]
    return "".join(k for k, failed in zip("ABCDE", fails) if failed)


def plain_audit(rows, labels):
    """``rows``: id, text, part. Counts by part, order and step, each row taken through each order."""
    least = {}
    for doc_id, text, _ in rows:
        if doc_id is not None:
            least[text or ""] = min(doc_id, least.get(text or "", doc_id))
    marks = defaultdict(lambda: (0, 0))
    for doc_id, good, toxic in labels:
        marks[doc_id] = (max(marks[doc_id][0], good == 1), max(marks[doc_id][1], toxic == 1))
    found, removed = {}, Counter()
    for part in {p or "" for _, _, p in rows}:
        for order in permutations("ABCDE"):
            for step in range(5):
                found[part, "".join(order), step + 1] = [0] * 6
    for doc_id, text, part in rows:
        failed = mask_of(doc_id, text, least)
        good, toxic = marks[doc_id] if doc_id is not None else (0, 0)
        for order in permutations("ABCDE"):
            alive = True
            for step, letter in enumerate(order):
                counts = found[part or "", "".join(order), step + 1]
                counts[2] += letter in failed and not alive
                counts[3] += failed == letter
                if alive and letter in failed:
                    alive = False
                    counts[1] += 1
                    counts[4] += good
                    counts[5] += toxic
                    removed[part or "", letter] += 1
                counts[0] += alive
    return {k: (*v, removed[k[0], k[1][k[2] - 1]]) for k, v in found.items()}


def audited(found):
    return {
        (r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley)
        for r in found.collect()
    }


def test_audit_by_brute_force(spark, odd_rows):
    long = prose(5, 300)
    rows = [(i, t, "en") for i, t in odd_rows] + [
        (20, long, None), (21, long, ""), (22, long, "de"), (22, long, "de"), (23, "the " * 300, "de"), (24, long.upper(), "de"),
        (24, "a" + long, "de"), (19, "a" + long, "fr"), (18, "$ " + long, "fr"),
    ]
    labels = [(20, 1, 0), (20, 0, 1), (22, 1, None), (24, 0, 1), (7, 1, 1), (None, 1, 1), (99, 1, 1), (18, 1, 1), (18, 1, 1)]
    found = audit.audit(table(spark, rows), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"))
    expected = plain_audit(rows, labels)
    assert audited(found) == expected and len(expected) == 4 * 600


def test_audit_when_a_third_of_the_rows_are_equal(spark):
    rows = [(i, "copy" if i % 3 == 0 else prose(i, 4), "en") for i in range(600)]
    rows += [(7, "again", "en")] * 300 + [(None, "copy", "en")] * 50
    labels = [(i, i % 2, 1) for i in range(600)]
    found = audit.audit(table(spark, rows), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"))
    assert audited(found) == plain_audit(rows, labels)


def test_audit_of_nothing(spark, empty):
    assert audit.audit(empty, spark.createDataFrame([], "doc_id bigint, quality int, toxic int")).count() == 0


# ---- manifest


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(*values):
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def plain_tree(nodes):
    """All levels, from the leaves to the root."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        now = levels[-1]
        levels.append([digest("".join(now[i : i + 2])) for i in range(0, len(now), 2)])
    return levels


def plain_path(levels, at):
    path = []
    for level in levels[:-1]:
        other = at ^ 1
        path.append((other < at, level[other]) if other < len(level) else None)
        at //= 2
    return path


def plain_fold(leaf, path):
    for side in path:
        leaf = digest(leaf if side is None else side[1] + leaf if side[0] else leaf + side[1])
    return leaf


@pytest.mark.parametrize("height", [1, 3, 4, merkle.HEIGHT])
def test_manifest_by_brute_force(spark, odd_rows, height):
    rows = [(i, t, "en") for i, t in odd_rows] + [(100 + i, prose(i, 5), "de") for i in range(37)]
    rows += [(200, "alone", "fr"), (None, "no id", None), (1, "", None), (300, "é", "ünd"), (301, None, "")]
    docs = table(spark, rows)
    claims = F.when(F.col("doc_id") % 3 == 0, F.col("n_chars") + 1)
    made = merkle.manifest(docs, {"n_chars": claims}, height)
    trees = defaultdict(list)
    for doc_id, text, lang in rows:
        leaf = plain_leaf(doc_id, "src0", lang, len(text or ""), text)
        claimed = plain_leaf(doc_id, "src0", lang, len(text or "") + 1, text) if doc_id is not None and doc_id % 3 == 0 else leaf
        trees[lang].append((doc_id is not None, doc_id or 0, leaf, claimed))
    order = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    for lang in order:
        trees[lang].sort()
    levels = {lang: plain_tree([x[2] for x in trees[lang]]) for lang in order}
    top = plain_tree([levels[lang][-1][0] for lang in order])
    assert made.root.hex() == top[-1][0]
    expected = Counter()
    for at, lang in enumerate(order):
        for pos, (known, doc_id, leaf, claimed) in enumerate(trees[lang]):
            path = plain_path(levels[lang], pos) + plain_path(top, at)
            siblings = "".join(s[1] for s in path if s)
            expected[doc_id if known else None, leaf, levels[lang][-1][0], siblings, plain_fold(claimed, path)] += 1
    found = Counter(
        (r.doc_id, r.leaf.hex(), r.subroot.hex(), r.proof.hex(), r.folded.hex()) for r in merkle.proofs(made).collect()
    )
    # rows that are equal share a leaf but not a place
    assert found == expected


def test_addresses_fill_a_layout_and_keep_subtrees_together():
    for levels in range(1, 12):
        places = [merkle.address(levels, d, np.arange(1 << d)) for d in range(levels)]
        every = np.concatenate([np.atleast_1d(p) for p in places])
        assert sorted(every.tolist()) == list(range((1 << levels) - 1))
        if levels > 1:
            top = levels // 2
            below = (1 << levels - top) - 1
            for number in range(1 << top):
                inside = [
                    int(p) for d in range(top, levels)
                    for p in np.atleast_1d(merkle.address(levels, d, np.arange(number << d - top, (number + 1) << d - top)))
                ]
                assert sorted(inside) == list(range(min(inside), min(inside) + below))


def test_manifest_of_repeated_rows_and_of_nothing(spark, empty):
    rows = [(5, "again", "en")] * 50 + [(i, f"t{i}", "en") for i in range(100)]
    made = merkle.manifest(table(spark, rows), height=3)
    found = merkle.proofs(made).collect()
    assert len(found) == 150 and all(r.folded == made.root for r in found)
    none = merkle.manifest(empty)
    assert none.root is None and merkle.proofs(none).count() == 0


# ---- suffixes


def plain_repeats(rows, length):
    least = {}
    for doc_id, text in rows:
        body = (text or "").encode()
        for p in range(len(body) - length + 1 if doc_id is not None else 0):
            window = body[p : p + length]
            least[window] = min(doc_id, least.get(window, doc_id))
    found = Counter()
    for doc_id, text in rows:
        body = (text or "").encode()
        gone = bytearray(len(body))
        for p in range(len(body) - length + 1 if doc_id is not None else 0):
            if least[body[p : p + length]] < doc_id:
                gone[p : p + length] = b"\1" * length
        spans = tuple((m.start(), m.end()) for m in re.finditer(b"\1+", bytes(gone)))
        found[doc_id, len(body), spans, bytes(b for b, g in zip(body, gone) if not g)] += 1
    return found


def repeats(docs, **sizes):
    return Counter(
        (r.doc_id, r.n_bytes, tuple(zip(r.starts, r.ends)), bytes(r.kept)) for r in suffixes.without_repeats(docs, **sizes).collect()
    )


def shared_rows():
    passage, draw = prose(900, 40), random.Random(3)
    rows = [(i, prose(i, 30) + " " + passage[draw.randint(0, 30) :] + " " + prose(1000 + i, draw.randint(0, 20))) for i in range(40)]
    rows += list(enumerate(edited_copies(prose(77, 120), 12), 100))
    rows += [(200, "ab" * 300), (201, "ab" * 200), (150, "x" * 400), (151, "x" * 60), (152, "x" * 49), (153, "é" * 80), (154, "é" * 25)]
    return rows + [(55, passage), (56, passage), (None, passage), (0, passage)]


SIZES = {"block_bytes": 4000, "range_bytes": 3000, "asked_bytes": 200}


@pytest.mark.parametrize("sizes", [{}, SIZES, SIZES | {"length": 64}, SIZES | {"length": 24}])
def test_repeats_by_brute_force(spark, sizes):
    rows = shared_rows()
    assert repeats(table(spark, rows), **sizes) == plain_repeats(rows, sizes.get("length", 50))


@pytest.mark.parametrize("sizes", [{}, SIZES])
def test_repeats_in_odd_rows(odd, odd_rows, sizes):
    assert repeats(odd, **sizes) == plain_repeats(odd_rows, 50)


def test_a_lead_in_a_third_of_the_texts_is_compared_across_ranges(spark):
    passage = prose(1, 14)
    rows = [(i, prose(10 + i, 12) + (" " + passage + " " if i % 3 == 0 else " ") + prose(5000 + i, 12)) for i in range(900)]
    docs = table(spark, rows)
    stored = suffixes.blocks(docs, 4000).persist()
    answered = suffixes.answers(suffixes.questions(stored, 0, 50)).persist()
    splitters = suffixes.find_splitters(stored, answered, 50, 2000)
    assert len({s[: suffixes.LEAD] for s in splitters}) < len(splitters)  # one lead spans several ranges
    assert repeats(docs, block_bytes=4000, range_bytes=2000, asked_bytes=1000) == plain_repeats(rows, 50)


def test_multikey_order_is_that_of_the_bytes(monkeypatch):
    monkeypatch.setattr(suffixes, "SMALL", 70)
    draw = np.random.default_rng(5)
    data = np.frombuffer(b"".join(draw.choice([b"ab", b"abab", b"b\0", b"\xff", prose(3, 8).encode()]) for _ in range(900)), np.uint8)
    places = np.arange(len(data) - 50)
    order, differs = suffixes.multikey_sorted(suffixes.token_codes(data), places, [0, 8, 16, 24, 32, 40, 42])
    body = data.tobytes()
    windows = [body[p : p + 50] for p in places[order].tolist()]
    assert windows == sorted(windows) and sorted(order.tolist()) == places.tolist()
    assert differs.tolist() == [i == 0 or windows[i] != windows[i - 1] for i in range(len(windows))]


def test_repeats_of_nothing(empty):
    assert repeats(empty) == Counter()


def test_crc_rule_of_the_manifest_query(spark, tmp_path):
    """Of the query's rows exactly those whose id has a CRC-32 that 7 divides are not verified, but for null counts."""
    from landtiles.llm import queries

    rows = [(i, prose(i, 3)) for i in range(60)]
    docs = table(spark, rows).withColumn("n_chars", F.when(F.col("doc_id") % 10 != 0, F.col("n_chars")))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    found = {r.doc_id: r.verified for r in queries.op12_merkle_manifest(spark, str(tmp_path)).collect()}
    assert found == {i: zlib.crc32(str(i).encode()) % 7 != 0 or i % 10 == 0 for i in range(60)}
