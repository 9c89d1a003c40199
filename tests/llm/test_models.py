import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from landtiles.llm import language, pieces, quality, rules, toxicity
from landtiles.llm.spans import Lookup, Texts, mixed, parts_of
from llm.conftest import prose, table


def texts_of(rows):
    return Texts([(t or "").encode() for t in rows])


@pytest.fixture(scope="session")
def marked(spark):
    """Prose; toxic texts hold one of three words; bad texts repeat themselves or shout."""
    rows, marks = [], []
    for i in range(900):
        text, toxic, good = prose(i, 60 + i % 40), i % 6 == 0, i % 5 != 0
        if toxic:
            words = text.split()
            words[i % len(words)] = ("grubber", "snotling", "oaf")[i // 6 % 3]
            text = " ".join(words)
        if not good:
            text = " ".join(f"{w}***" for w in text.split()) if i % 2 else f"{text[:40]} " * 20
        rows.append((i, text))
        if i % 10 != 9:
            marks.append((i, int(good), int(toxic)))
    return table(spark, rows), spark.createDataFrame(marks, "doc_id bigint, quality int, toxic int")


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id bigint, quality int, toxic int")


def accuracy(found, labels, mark, threshold):
    from landtiles.llm.common import fold

    rows = found.join(labels, "doc_id").where(fold("doc_id", 5) == 0).select("score", mark).collect()
    assert len(rows) > 100
    return sum((r[0] >= threshold) == bool(r[1]) for r in rows) / len(rows)


def test_toxicity_on_held_out_rows(marked):
    docs, labels = marked
    model = toxicity.fit_toxicity(docs, labels)
    assert 0 < len(model.at) < 2000
    assert accuracy(toxicity.toxicity(docs, model), labels, "toxic", 0.5) > 0.97


def test_quality_on_held_out_rows(marked):
    docs, labels = marked
    model = quality.fit_quality(docs, labels)
    assert accuracy(quality.rank(docs, model), labels, "quality", quality.KEEP_SCORE) > 0.97
    kept = quality.of_good_quality(docs, model)
    assert kept.schema == docs.schema
    scores = {r.doc_id: r.score for r in quality.rank(docs, model).collect()}
    assert {r.doc_id for r in kept.collect()} == {i for i, s in scores.items() if s >= quality.KEEP_SCORE}


def test_rules_on_held_out_rows(marked):
    docs, labels = marked
    model = rules.fit_rules(docs, labels)
    verdicts = rules.apply_rules(docs, model).select("doc_id", F.col("kept").cast("double").alias("score"))
    assert accuracy(verdicts, labels, "quality", 0.5) > 0.95


def test_ftrl_by_a_plain_version():
    draw, model = random.Random(3), toxicity.Ftrl(6, rate=0.3, l1=0.2)
    z, n = defaultdict(float), defaultdict(float)
    weight = lambda i: 0.0 if abs(z[i]) <= (0.0 if i == 6 else 0.2) else ((0.0 if i == 6 else 0.2) * (1 if z[i] > 0 else -1) - z[i]) / ((1 + math.sqrt(n[i])) / 0.3 + toxicity.L2)
    for _ in range(200):
        at, mark = sorted(draw.sample(range(6), 3)), draw.randint(0, 1)
        model.learn(np.array(at), mark)
        at.append(6)
        slope = 1 / (1 + math.exp(-sum(map(weight, at)))) - mark
        for i, w in [(i, weight(i)) for i in at]:
            z[i] += slope - (math.sqrt(n[i] + slope**2) - math.sqrt(n[i])) / 0.3 * w
            n[i] += slope**2
    assert np.allclose(model.weights(np.arange(7)), [weight(i) for i in range(7)])


def test_odd_rows_are_scored(odd, odd_rows, marked, no_labels):
    docs, labels = marked
    for found in (
        toxicity.toxicity(odd, toxicity.fit_toxicity(docs, labels)),
        toxicity.toxicity(odd, toxicity.fit_toxicity(odd, no_labels)),
        quality.rank(odd, quality.fit_quality(docs, labels)),
        quality.rank(odd, quality.fit_quality(odd, no_labels)),
        rules.apply_rules(odd, rules.fit_rules(docs, labels)),
        rules.apply_rules(odd, rules.fit_rules(odd, no_labels)),
    ):
        rows = found.collect()
        assert sorted(r.doc_id or -1 for r in rows) == sorted(i or -1 for i, _ in odd_rows)
        assert all(0.0 <= r.score <= 1.0 for r in rows)


def test_no_rows(empty, no_labels):
    assert toxicity.toxicity(empty, toxicity.fit_toxicity(empty, no_labels)).collect() == []
    assert rules.apply_rules(empty, rules.fit_rules(empty, no_labels)).collect() == []
    assert quality.of_good_quality(empty, quality.fit_quality(empty, no_labels)).collect() == []
    assert language.identify(empty, language.fit_languages(empty)).collect() == []
    assert language.with_known_language(empty, language.fit_languages(empty)).collect() == []
    assert pieces.decoded(pieces.encoded(empty)).collect() == []


def plain_measures(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    repeated = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated))


def test_measures_by_plain_counting(odd_rows):
    texts = [t or "" for _, t in odd_rows] + [prose(i % 4, 12) + "\n" + prose(i, 9) + "\n" + prose(i % 4, 12) for i in range(30)]
    found = rules.measures(texts_of(texts))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    for i, text in enumerate(texts):
        assert tuple(int(found[n][i]) for n in names) == plain_measures(text), text[:80]


def test_calibration_recovers_a_logistic_curve():
    draw = np.random.default_rng(1)
    raw = draw.normal(size=20000)
    marks = (draw.random(20000) < 1 / (1 + np.exp(-(3 * raw - 1)))).astype(int)
    slope, shift = rules.calibrate(raw, marks)
    assert abs(slope - 3) < 0.2 and abs(shift + 1) < 0.1


# ---- language


def plain_code_length(sample, text, order, alphabet):
    """Escape method C without exclusion, one context at a time."""
    counts = defaultdict(Counter)
    for doc in sample:
        doc = b"\n" * order + doc
        for i in range(order, len(doc)):
            for k in range(order + 1):
                counts[doc[i - k : i]][doc[i]] += 1
    bits, text = 0.0, b"\n" * order + text
    for i in range(order, len(text)):
        for k in range(order, -1, -1):
            seen = counts.get(text[i - k : i])
            if seen is None:
                continue
            total = sum(seen.values()) + len(seen)
            if text[i] in seen:
                bits -= math.log2(seen[text[i]] / total)
                break
            bits -= math.log2(len(seen) / total)
        else:
            bits += 8
    return bits


def test_code_lengths_by_a_plain_version():
    samples = {"aa": [b"abracadabra", b"an apple a day"], "bb": [b"brbrbr brown", "über".encode()]}
    trees = language.build_trees(samples, 3)
    texts = [b"abra", b"", b"brown apple", "ü漢z".encode(), b"abracadabra" * 3]
    found = language.code_lengths(trees, Texts(texts, 3))
    for i, text in enumerate(texts):
        for j, name in enumerate(trees.languages):
            assert abs(found[i, j] - plain_code_length(samples[name], text, 3, 256)) < 1e-3


def test_languages_on_held_out_rows(spark):
    parts = {"en": ["the", "ing", "th", "er", "and"], "de": ["sch", "ich", "ung", "ein", "der"], "fr": ["que", "eau", "les", "ment", "oi"]}
    draw, rows = random.Random(1), []
    for i in range(300):
        lang = draw.choice(list(parts))
        rows.append((i, " ".join("".join(draw.choices(parts[lang], k=2)) for _ in range(12)), lang))
    docs = table(spark, [*rows, (1000, None, None), (1001, "12 34 !!", "en"), (1002, "", "de"), (None, "theing ander", None)])
    trees = language.fit_languages(docs)
    found = {r.doc_id: (r.lang_pred, r.score) for r in language.identify(docs, trees).collect()}
    assert sum(found[i][0] == lang for i, _, lang in rows) > 295
    assert [found[i] for i in (1000, 1001, 1002)] == [("und", 0.0)] * 3
    assert found[None][0] == "en"
    kept = language.with_known_language(docs, trees)
    assert kept.schema == docs.schema
    assert not {r.doc_id for r in kept.collect()} & {1000, 1001, 1002}


def test_without_labels_every_language_is_undetermined(odd, odd_rows):
    unlabelled = odd.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language.identify(unlabelled, language.fit_languages(unlabelled)).collect()} == {"und"}


# ---- pieces


def test_segmentations_are_lossless_and_repeatable(odd, odd_rows):
    rows = pieces.decoded(pieces.encoded(odd)).collect()
    assert sorted((r.doc_id or -1, r.decoded) for r in rows) == sorted((i or -1, t or "") for i, t in odd_rows)
    again = pieces.encoded(odd.repartition(7), decode=True).collect()
    assert sorted((r.doc_id or -1, r.decoded) for r in again) == sorted((i or -1, t or "") for i, t in odd_rows)
    keyed = lambda rs: sorted((r.doc_id or -1, bytes(r.ids)) for r in rs)
    assert keyed(rows) == keyed(again)


def test_strings_of_one_hash_stay_apart():
    """Thue-Morse strings, whose polynomial hashes modulo a power of two agree whatever the base is."""
    one, two = b"a", b"b"
    for _ in range(10):
        one, two = one + two, two + one
    texts = Texts([one, two, two, one])
    assert len(set(texts.hashes(texts.starts, texts.ends).tolist())) == 1 and one != two
    own = pieces.make_pieces([b"a", b"b", one, *(bytes([i]) for i in range(256))], np.full(259, -5.0), np.arange(3, 259))
    for model in (pieces.pieces_of(pieces.MODEL), own):  # in the second model one of the strings is a piece
        ids, bounds = pieces.sampled_ids(model, texts, mixed(np.arange(4, dtype=np.uint64)))
        blobs = [ids[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])]
        assert pieces.spelled(model, blobs).to_pylist() == [t.decode() for t in (one, two, two, one)]


def test_samples_follow_the_path_probabilities():
    strings = [b"a", b"b", b"c", b"ab", b"bc", b"abc", b" a", b" ab", b" "] + [bytes([i]) for i in range(256)]
    weight = np.append(np.log([0.2, 0.1, 0.1, 0.3, 0.2, 0.1, 0.2, 0.1, 0.05]), np.full(256, -9.0))
    model = pieces.make_pieces(strings, weight, np.arange(9, 265))
    word, n = b" abc", 30000
    ids, bounds = pieces.sampled_ids(model, Texts([word] * n), mixed(np.arange(n, dtype=np.uint64)))
    seen = Counter(tuple(ids[bounds[i] : bounds[i + 1]].tolist()) for i in range(n))
    known = {s: (i, w) for i, (s, w) in enumerate(zip(strings[:9], weight))}

    def paths(at):
        if at == len(word):
            yield (), 1.0
        for to in range(at + 1, len(word) + 1):
            if word[at:to] in known:
                piece, w = known[word[at:to]]
                for rest, p in paths(to):
                    yield (piece, *rest), p * math.exp(w)

    expected = dict(paths(0))
    total = sum(expected.values())
    for path, p in expected.items():
        assert abs(seen[path] / n - p / total) < 0.015


# ---- spans


def test_lookup_and_hashes():
    keys = np.unique(np.random.default_rng(0).integers(0, 2**63, 5000).astype(np.uint64))
    table_ = Lookup(keys)
    assert (table_.find(keys) == np.arange(len(keys))).all()
    assert (table_.find(keys + np.uint64(1)) == -1).sum() > len(keys) - 5
    texts = Texts([b"same word", b"word same", b""])
    start, end, bounds = texts.words()
    hashed = texts.hashes(start, end)
    assert hashed[0] == hashed[3] and hashed[1] == hashed[2] and hashed[0] != hashed[1]
    assert bounds.tolist() == [0, 2, 4, 4]


def test_parts_of_sliced_columns_with_nulls():
    column = pa.array(["a", None, "ccc", "", "é"]).slice(1, 4)
    assert [bytes(p) for p in parts_of(column)] == [b"", b"ccc", b"", "é".encode()]
