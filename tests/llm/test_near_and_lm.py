import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from landtiles.llm import chosenpath, interpolation
from landtiles.llm.components import components
from llm.conftest import prose, table

LOWER = {c: c + 32 for c in range(65, 91)}


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def shingles(text):
    words = words_of(text)
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def reachable(links, vertices):
    near = defaultdict(set)
    for a, b in links:
        near[a].add(b)
        near[b].add(a)
    label = {}
    for v in sorted(vertices):
        if v in label:
            continue
        label[v], waiting = v, [v]
        while waiting:
            for other in near[waiting.pop()]:
                if other not in label:
                    label[other] = v
                    waiting.append(other)
    return label


def brute_components(rows, percent):
    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    links = [
        (a, b)
        for k, (a, x) in enumerate(sets)
        for b, y in sets[:k]
        if x and y and 100 * len(x & y) >= percent * len(x | y)
    ]
    return reachable(links, {i for i, _ in sets})


def edited(text, seed, edits):
    draw, words = random.Random(seed), text.split(" ")
    for _ in range(edits):
        words[draw.randrange(len(words))] = f"new{draw.randrange(10**6)}"
    return " ".join(words)


def near_rows():
    rows, shared = [], prose(77, 60)
    for base in range(12):
        text = prose(100 + base, 120)
        for copy in range(8):
            rows.append((len(rows) * 3 % 1009, edited(text, base * 50 + copy, copy % 6)))
    hot = prose(55, 150)
    rows += [(2000 + i, edited(hot, 900 + i, i % 4)) for i in range(120)]
    rows += [(3000 + i, prose(400 + i, 30) + " " + shared) for i in range(40)]
    return rows


@pytest.mark.parametrize("percent", [80, 85])
@pytest.mark.parametrize("small,levels", [(2048, 6), (16, 6), (16, 1)])
def test_components_by_brute_force(spark, monkeypatch, percent, small, levels):
    monkeypatch.setattr(chosenpath, "SMALL_NODE", small)
    monkeypatch.setattr(chosenpath, "LEVELS", levels)
    monkeypatch.setattr(chosenpath, "COLUMNS", 50)
    rows = near_rows()
    expected = brute_components(rows, percent)
    assert 1 < len(set(expected.values())) < len(rows)
    for r in chosenpath.near_groups(table(spark, rows), percent).collect():
        assert (r.component_id, r.kept) == (expected[r.doc_id], expected[r.doc_id] == r.doc_id)


def test_odd_rows(odd, odd_rows):
    found = chosenpath.near_groups(odd).collect()
    assert len(found) == len(odd_rows)
    expected = brute_components(odd_rows, 85)
    sizes = defaultdict(set)
    for doc_id, text in odd_rows:
        sizes[doc_id].add(len(shingles(text)))
    for r in found:
        assert r.n_shingles in sizes[r.doc_id]
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert r.component_id == expected[r.doc_id]


def test_near_copies_leave_one_row_of_each_group(spark):
    rows = near_rows()
    docs = table(spark, rows)
    kept = chosenpath.without_near_copies(docs, 80)
    assert kept.schema == docs.schema
    assert {r.doc_id for r in kept.collect()} == set(brute_components(rows, 80).values())


def test_no_rows(empty):
    assert chosenpath.near_groups(empty).collect() == []
    assert interpolation.scores(empty).collect() == []


def test_components_of_chains_and_stars(spark):
    draw = random.Random(9)
    links = [(i, i + 1) for i in range(100, 160)] + [(500, 600 + i) for i in range(200)]
    links += [(draw.randrange(1000, 1100), draw.randrange(1000, 1100)) for _ in range(80)]
    found = components(spark.createDataFrame(links, "a bigint, b bigint"))
    expected = reachable(links, {v for a, b in links if a != b for v in (a, b)})
    assert {r.vid: r.label for r in found.collect()} == expected


# ---- language model


def test_counts_and_base_scores_by_plain_counting(odd, odd_rows):
    found = interpolation.scores(odd, block_bytes=100_000).collect()
    tokens = [(i, [*words_of(t), "</s> "]) for i, t in odd_rows]
    held = {i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in tokens}
    count = Counter()
    for i, words in tokens:
        if not held[i]:
            count.update(words)
    total, distinct = sum(count.values()), len(count)
    expected = sorted(
        (i or -1, len(w), sum(count[x] > 0 for x in w), round(sum(math.log10((count[x] + 1) / (total + distinct + 1)) for x in w), 4))
        for i, w in tokens
    )
    assert sorted((r.doc_id or -1, r.n_tokens, r.n_known, round(r.base_score, 4)) for r in found) == expected
    assert {r.train_tokens for r in found} == {total}
    assert all(r.held_out == held[r.doc_id] and r.score < 0 for r in found)


def test_scores_do_not_depend_on_blocks(spark):
    docs = table(spark, [(i, prose(i % 20, 30 + i % 7)) for i in range(60)])
    one, many = ({r.doc_id: r.score for r in interpolation.scores(docs, b).collect()} for b in (1 << 24, 2000))
    assert one.keys() == many.keys()
    assert all(abs(one[k] - many[k]) < 1e-9 * abs(one[k]) for k in one)


def test_copies_of_one_row_lie_in_many_blocks(spark, tmp_path):
    rows = [(7, "again and again " * 4)] * 600 + [(i, prose(i, 10)) for i in range(100, 700)]
    table(spark, rows).write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    blocks, count = interpolation.with_blocks(docs, 8000)
    sizes = [r["count"] for r in blocks.groupBy("block").count().collect()]
    assert count > 10 and sum(sizes) == 1200 and max(sizes) < 2 * 1200 / count
    whole, cut_up = (sorted(map(tuple, interpolation.scores(docs, b).select("doc_id", "base_score").collect())) for b in (1 << 23, 8000))
    assert np.allclose(whole, cut_up) and len(whole) == 1200


def test_scores_by_plain_interpolation(spark):
    rows = [(i, prose(i % 9, 25)) for i in range(40)]
    docs = table(spark, rows)
    counted = interpolation.counted_tokens(docs).cache()
    totals = counted.agg({"tokens": "sum", "distinct": "sum"}).first()
    uni, pair, train = Counter(), Counter(), 0
    for i, text in rows:
        if zlib.crc32(str(i).encode()) % 7 != 2:
            words = ["<s>", *words_of(text), "</s>"]
            uni.update(words[1:])
            pair.update(zip(words, words[1:]))
            train += 1
    tokens, distinct = sum(uni.values()), len(uni)
    assert {totals[0], totals[1]} == {tokens, distinct}
    cells = [tuple(r) for r in interpolation.histogram(counted, tokens, train).collect()]
    assert sum(n for _, n in cells) == tokens
    weights = interpolation.mixture(cells, distinct)
    assert np.allclose(weights.sum(axis=1), 1.0)
    found = {r.doc_id: r.score for r in interpolation.scores(docs).collect()}
    for i, text in rows:
        total, words = 0.0, ["<s>", *words_of(text), "</s>"]
        for before, word in zip(words, words[1:]):
            context = train if before == "<s>" else uni[before]
            mix = weights[min(context.bit_length(), interpolation.BUCKETS - 1)]
            p = mix[0] * pair[before, word] / max(context, 1) + mix[1] * uni[word] / tokens + mix[2] / (distinct + 1)
            total += math.log10(p)
        assert abs(found[i] - total) < 1e-6 * abs(total)


def test_expectation_maximisation_finds_the_better_estimate():
    def cell(bucket, second, first):
        code = [round(-interpolation.STEPS * math.log2(p)) + 1 if p else 0 for p in (second, first)]
        return (bucket << 32) + (code[0] << 16) + code[1]

    weights = interpolation.mixture([(cell(3, 0.5, 0.01), 1000), (cell(5, 0, 0.25), 1000)], 1000)
    assert weights[3][0] > 0.95 and weights[5][1] > 0.95


def test_number_arrays_survive():
    values = np.sort(np.random.default_rng(1).integers(0, 2**63, 1000).astype(np.uint64))
    assert (interpolation.restored_sorted(interpolation.squeezed_sorted(values)) == values).all()
    assert len(interpolation.restored(interpolation.squeezed(np.zeros(0, np.uint32)), np.uint32)) == 0
