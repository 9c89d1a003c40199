import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from landtiles.llm import grace, packing, sharding
from landtiles.llm.spans import Texts
from llm.conftest import prose, table


def by_text(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[text or ""].append(doc_id)
    return groups


@pytest.mark.parametrize("table_bytes", [200, grace.TABLE_BYTES])
def test_exact_groups_by_brute_force(odd, odd_rows, table_bytes):
    found = grace.exact_groups(odd, table_bytes).collect()
    groups = by_text(odd_rows)
    shas = {hashlib.sha256(t.encode()).digest(): t for t in groups}
    assert len(found) == len(odd_rows)
    kept = defaultdict(int)
    for r in found:
        ids = groups[shas[bytes(r.sha)]]
        assert r.group_size == len(ids)
        assert r.keep_id == max((i for i in ids if i is not None), default=None)
        assert not r.kept or r.doc_id == r.keep_id
        kept[bytes(r.sha)] += r.kept
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in found) == sorted((i is None, i or 0) for i, _ in odd_rows)
    assert set(kept.values()) == {1}


@pytest.mark.parametrize("table_bytes", [200, grace.TABLE_BYTES])
def test_without_copies_keeps_rows_whole(odd, odd_rows, table_bytes):
    kept = grace.without_copies(odd, table_bytes)
    assert kept.schema == odd.schema
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    groups = by_text(odd_rows)
    assert len(rows) == len(groups)
    for doc_id, text in rows:
        assert doc_id == max((i for i in groups[text or ""] if i is not None), default=None)


def test_many_copies_over_many_partitions(spark):
    rows = [(i, "copy" if i % 3 else f"text {i % 50}") for i in range(3000)]
    found = grace.exact_groups(table(spark, rows).repartition(40), 4000)
    sizes = {r.keep_id: r.group_size for r in found.where("kept").collect()}
    expected = {max(ids): len(ids) for ids in by_text(rows).values()}
    assert sizes == expected


def test_smallest_ids_next_to_none(spark):
    least = -(1 << 63)
    rows = [(least, "a"), (None, "a"), (least, "a"), (least + 1, "b"), (least, "b"), (None, "b"), (None, "c")]
    found = grace.exact_groups(table(spark, rows).repartition(7)).where("kept").collect()
    assert sorted((r.keep_id or 0, r.doc_id or 0, r.group_size) for r in found) == [(least, least, 3), (least + 1, least + 1, 3), (0, 0, 1)]


def test_a_table_compares_contents_of_one_hash():
    held = grace.ContentTable()
    found = [held.entry(5, b"%d" % i) for i in range(200)]
    assert [at for at, _ in found] == list(range(200)) and all(new for _, new in found)
    assert held.entry(5, b"150") == (150, False)


def test_exact_on_no_rows(empty):
    assert grace.exact_groups(empty).count() == 0
    assert grace.without_copies(empty).collect() == []


# ---- packing


def test_ids_are_those_of_the_tokenizer(odd_rows):
    tokenizer = Tokenizer.from_file(packing.TOKENIZER)
    draw = random.Random(4)
    alphabet = ["a", "B", " ", "  ", "\n", "\t", "é", "ß", " ", " ", "漢", "'s", "12", "!", "🙂", "\x1f", "\x85", "<|endoftext|>"]
    texts = [t or "" for _, t in odd_rows] + ["".join(draw.choices(alphabet, k=draw.randint(0, 30))) for _ in range(800)]
    ids, bounds = packing.encoder(packing.TOKENIZER).ids(Texts([t.encode() for t in texts]))
    for i, text in enumerate(texts):
        expected = [*tokenizer.encode(text, add_special_tokens=False).ids, packing.END_ID]
        assert ids[bounds[i] : bounds[i + 1]].tolist() == expected, text


def test_first_fit_decreasing_by_plain_search():
    draw = random.Random(2)
    lengths = sorted((draw.randint(1, 50) for _ in range(300)), reverse=True)
    filled, expected = [0] * 300, []
    for size in lengths:
        at = next(i for i, used in enumerate(filled) if used + size <= 50)
        expected.append((at, filled[at]))
        filled[at] += size
    assert packing.first_fit_decreasing(lengths, 50) == expected


def test_every_id_lies_in_one_piece(odd, odd_rows):
    found = packing.assign_sequences(packing.token_pieces(odd, 64), 2, 64).collect()
    tokenizer = Tokenizer.from_file(packing.TOKENIZER)
    whole = defaultdict(list)
    for doc_id, text in odd_rows:
        whole[doc_id].append([*tokenizer.encode(text or "", add_special_tokens=False).ids, packing.END_ID])
    pieces = defaultdict(list)
    for r in found:
        assert r.length <= 64 and len(r.ids) == 4 * r.length
        pieces[r.doc_id].append((r.start, np.frombuffer(r.ids, "<u4").tolist(), r.doc_tokens))
    for doc_id, docs in whole.items():
        expected = sorted((at, ids[at : at + 64], len(ids)) for ids in docs for at in range(0, len(ids), 64))
        assert sorted(pieces[doc_id]) == expected
    sequences = defaultdict(list)
    for r in found:
        sequences[r.sequence_id].append((r.offset, r.length))
    for placed in sequences.values():
        end = 0
        for offset, length in sorted(placed):
            assert offset == end
            end += length
        assert end <= 64


def test_packing_wastes_little(spark):
    docs = table(spark, [(i, prose(i, 20 + 7 * (i % 60))) for i in range(400)])
    found = packing.packed_ids(docs, 512).groupBy("sequence_id").agg(F.sum("length").alias("n"))
    assert found.agg(F.avg("n")).first()[0] > 0.97 * 512


def test_packing_no_rows(empty):
    assert packing.packed_ids(empty).collect() == []


# ---- sharding


def checked_shards(docs, rows, count, **limits):
    found = sharding.shards(docs, count, **limits).select("doc_id", "text", "size", "shard", "slot").collect()
    assert sorted((r.doc_id or -1, r.text or "") for r in found) == sorted((i or -1, t or "") for i, t in rows)
    for r in found:
        assert r.size == len((r.text or "").encode()) + 1
    total = [0] * count
    for shard in range(count):
        own = [r for r in found if r.shard == shard]
        assert sorted(r.slot for r in own) == list(range(len(own)))
        total[shard] = sum(r.size for r in own)
    return total


def test_shards_number_every_row(odd, odd_rows):
    checked_shards(odd, odd_rows, 4)


def test_shards_are_even_though_a_third_is_one_text(spark):
    rows = [(i, "the same text" if i % 3 == 0 else prose(i, 1 + i % 17)) for i in range(6000)]
    total = checked_shards(table(spark, rows), rows, 8, range_rows=300)
    assert max(total) - min(total) < 0.01 * sum(total) / 8 + 2 * 400


def test_shards_of_repeated_rows(spark):
    rows = [(7, "again")] * 2000
    total = checked_shards(table(spark, rows), rows, 4, range_rows=100)
    assert max(total) - min(total) <= 12 * 6


def test_shards_carry_columns_of_any_name(spark):
    inner = ["part", "cell", "place", "alone", "parts", "first", "in_0", "low", "shard"]
    docs = spark.createDataFrame([(i, f"text {i % 9}", *[f"v{i}"] * 9) for i in range(40)], ["doc_id", "text", *inner])
    found = sharding.shards(docs, 2, range_rows=5)
    assert found.columns == ["doc_id", "text", *inner[:7], "size", "high", "low", "shard", "slot"]
    assert all(r[c] == f"v{r.doc_id}" for r in found.collect() for c in inner[:7])
    assert sorted(r.doc_id for r in found.collect()) == list(range(40))


def test_shards_of_no_rows(empty):
    assert sharding.shards(empty).collect() == []


def test_digests_of_the_query(spark, tmp_path, odd_rows):
    from landtiles.llm.queries import QUERIES

    table(spark, odd_rows).write.parquet(f"{tmp_path}/documents.parquet")
    found = QUERIES["op3_sharding"](spark, str(tmp_path)).collect()
    expected = sorted((i or -1, zlib.crc32((t or "").encode())) for i, t in odd_rows)
    assert sorted((r.doc_id or -1, r.text_crc32) for r in found) == expected


def test_segments_with_one_hash_keep_their_own_ids():
    """Thue-Morse strings, whose polynomial hashes modulo a power of two agree whatever the base is."""
    one, two = "a", "b"
    for _ in range(10):
        one, two = one + two, two + one
    texts = Texts([x.encode() for x in (one, two, two, one)])
    assert len(set(texts.hashes(texts.starts, texts.ends).tolist())) == 1 and one != two
    tokenizer = Tokenizer.from_file(packing.TOKENIZER)
    ids, bounds = packing.encoder(packing.TOKENIZER).ids(texts)
    for i, text in enumerate((one, two, two, one)):
        assert ids[bounds[i] : bounds[i + 1]].tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, packing.END_ID]


def test_what_an_encoder_keeps_has_a_bound(monkeypatch):
    monkeypatch.setattr(packing, "CACHE_BYTES", 1 << 16)
    encoder = packing.Encoder(packing.TOKENIZER)
    for seed in range(5):
        encoder.ids(Texts([prose(seed, 2000).encode()]))
        assert encoder.held <= 1 << 16
        assert encoder.held == sum(packing.ENTRY_BYTES + len(k) + len(v) for k, v in encoder.known.items())
