"""The pipeline against plain Python: each stage's decisions from its operator's rows or from the texts."""

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from landtiles.llm import chosenpath, language, packing, quality
from llm.conftest import edited_copies, prose, table
from llm.test_near_and_lm import brute_components


FOREIGN = [
    "Съешь же ещё этих мягких французских булок, да выпей чаю. " * 4, "いろはにほへとちりぬるをわかよたれそつねならむ" * 5,
    "qzxkjv wvbmqp zxcvlkj qwrtpsdf ghjklmb " * 6, "xq7ZkW9vJq2Yp0LmQz8BxKvWw" * 8,
]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rows, marks = [], []
    for i in range(120):
        text = prose(i, 60 + i % 30)
        if i % 6 == 0:
            text = f"{text[:30]} " * 15
        rows.append((i, text, "en"))
        marks.append((i, int(i % 6 != 0), 0))
    rows += [(200 + i, rows[i % 7 + 1][1], "en") for i in range(30)]
    rows += [(300 + i, t, "en") for i, t in enumerate(edited_copies(rows[1][1], 12))]
    rows += [(400, None, None), (401, "", "en"), (402, "12 34 !!", "en"), (None, "no id here", None), (50, rows[50][1], "en")]
    rows += [(500 + i, t, None) for i, t in enumerate(FOREIGN)]
    path = str(tmp_path_factory.mktemp("tables"))
    table(spark, rows).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(marks, "doc_id bigint, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def pairs(docs):
    return sorted(((r.doc_id, r.text) for r in docs.collect()), key=repr)


def test_stages_and_their_sum(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    stages, columns = corpus_pipeline.STAGES, docs.columns

    trees = language.fit_languages(docs)
    told = {(r.doc_id, r.score, r.lang_pred) for r in language.identify(docs, trees).collect()}
    names = {i for i, score, name in told if name != "und" and score >= language.KEEP_SCORE} - {500, 501, 502, 503}
    kept = stages[0][1](spark, docs, folder).cache()
    assert pairs(kept) == sorted((p for p in pairs(docs) if p[0] in names), key=repr)
    assert not names & {400, 401, 402}

    ranked = quality.rank(kept, quality.fit_quality(kept, labels)).collect()
    good = {r.doc_id for r in ranked if r.score >= quality.KEEP_SCORE}
    better = stages[1][1](spark, kept, folder).cache()
    assert pairs(better) == sorted((p for p in pairs(kept) if p[0] in good), key=repr)
    assert not good & set(range(0, 120, 6)) and len(good & set(range(120))) > 95

    largest = {}
    for doc_id, text in pairs(better):
        largest[text] = max(largest.get(text, -1), -1 if doc_id is None else doc_id)
    single = stages[2][1](spark, better, folder).cache()
    assert sorted((-1 if i is None else i, t) for i, t in pairs(single)) == sorted((i, t) for t, i in largest.items())

    component = brute_components(pairs(single), corpus_pipeline.NEAR_PERCENT)
    apart = stages[3][1](spark, single, folder).cache()
    assert pairs(apart) == sorted((p for p in pairs(single) if p[0] is None or component[p[0]] == p[0]), key=repr)
    assert len(pairs(apart)) < len(pairs(single))
    assert apart.columns == single.columns == better.columns == kept.columns == columns

    tokenizer = Tokenizer.from_file(packing.TOKENIZER)
    expected = sorted((-1 if i is None else i, [*tokenizer.encode(t, add_special_tokens=False).ids, packing.END_ID]) for i, t in pairs(apart))
    found = corpus_pipeline.run(spark, folder).collect()
    whole = {}
    for r in sorted(found, key=lambda r: (r.doc_id is None, r.doc_id or 0, r.start)):
        whole.setdefault(-1 if r.doc_id is None else r.doc_id, []).extend(np.frombuffer(r.ids, "<u4").tolist())
    assert sorted(whole.items()) == expected


def test_stages_of_nothing_and_of_long_texts(spark, tmp_path, empty):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    for name, docs in (("none", empty), ("long", table(spark, [(i, prose(i, 40_000), "en") for i in range(3)]))):
        folder = str(tmp_path / name)
        docs.write.parquet(f"{folder}/documents.parquet")
        labels.write.parquet(f"{folder}/labels.parquet")
        rows = docs.count()
        found = corpus_pipeline.run(spark, folder)
        assert found.select("doc_id").distinct().count() == rows
        assert rows == 0 or found.groupBy("doc_id").agg({"length": "sum", "doc_tokens": "max"}).where("`sum(length)` != `max(doc_tokens)`").count() == 0


def test_near_copies_go_by_row(spark):
    """Rows that share an id, or have none, stay or go by their own texts."""
    a, b, c = prose(1, 60), prose(2, 60), prose(3, 60)
    near = edited_copies(a, 4)
    rows = [(3, a), (5, near[1]), (5, b), (6, near[2]), (7, c), (7, c + " "), (None, near[2] + " "), (None, near[3]), (None, "few words"), (8, ""), (8, b + " x"), (9, None)]
    docs = table(spark, rows)
    kept = chosenpath.without_near_copies(docs, 80)
    assert kept.columns == docs.columns
    assert pairs(kept) == sorted(
        [(3, a), (5, b), (7, c), (None, near[3]), (None, "few words"), (8, ""), (9, None)], key=repr
    )
    few = [(1, a), (None, ""), (2, near[1])]
    assert pairs(chosenpath.without_near_copies(table(spark, few), 80)) == sorted([(1, a), (None, "")], key=repr)


def test_a_third_of_the_labelled_rows_share_an_id(spark):
    rows = [(1, prose(1, 50))] * 400 + [(i, prose(i, 50) if i % 2 else "junk " * 40) for i in range(2, 200)]
    marks = [(i, i % 2, 0) for i in range(1, 200)] + [(1, 0, 0), (3, None, 0)]
    labels = spark.createDataFrame(marks, "doc_id bigint, quality int, toxic int")
    sample = quality.labelled_sample(table(spark, rows), labels, "quality", 4000).collect()
    assert len({r.doc_id for r in sample}) == len(sample)
    assert {r.doc_id: r.mark for r in sample}.get(1, 0) == 0  # the smallest of two marks
    assert quality.fit_quality(table(spark, rows), labels) is not None
