"""Every value is learned, however many there are and however long its texts are."""

from collections import Counter
from zlib import crc32

from landtiles.llm import language
from landtiles.llm.common import bounded_sample
from llm.conftest import table

LEARNED = [i for i in range(2000) if crc32(str(i).encode()) % 5]


def test_more_than_256_languages_and_one_of_long_texts(spark):
    rows = [(i, f"some {i} text", f"x{i:04d}") for i in LEARNED[:300]]
    rows += [(i, "long words " * 7000, "longest") for i in LEARNED[300:303]]
    trees = language.fit_languages(table(spark, rows), order=1)
    assert trees.languages == sorted({lang for _, _, lang in rows})


def test_samples_are_bounded_in_rows_and_bytes(spark):
    rows = [(i, ("many", "few", "long")[0 if i % 10 else 1 + i // 10 % 2], 10) for i in range(20000)]
    rows = [(i, value, 50_000_000 if value == "long" else size) for i, value, size in rows]
    docs = spark.createDataFrame(rows, "doc_id bigint, value string, size bigint")
    drawn = bounded_sample(docs, "value", 2000).collect()
    count, total = Counter(r["value"] for r in drawn), Counter(r[1] for r in rows)
    assert count["few"] == 1000 and 1800 < count["many"] < 2200
    assert 0 < count["long"] < 20
    assert all(r.total == total[r["value"]] for r in drawn)
