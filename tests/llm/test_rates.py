import random
import zlib

import numpy as np

from landtiles.llm import language
from landtiles.llm.spans import Texts
from tests.llm.conftest import prose, table


def test_usual_rates_are_medians_of_all_held_out_texts(spark):
    draw = random.Random(1)
    rows = [(i, prose(i, 12) + " " + "".join(chr(draw.randint(97, 122)) for _ in range(i % 90)), "ab"[i % 2]) for i in range(4000)]
    docs = table(spark, rows)
    trees = language.fit_languages(docs, 40)
    found = language.usual_rates(docs, trees)
    for j, lang in enumerate(trees.languages):
        held = [text.encode() for i, text, own in rows if own == lang and zlib.crc32(str(i).encode()) % 5 == 0]
        bits = language.code_lengths(trees, Texts(held, trees.order))[:, j]
        assert len(held) > 2 * language.RATE_STEPS // 4096 + 300
        assert abs(found[j] - np.median(bits / [len(t) for t in held])) <= 1 / language.RATE_STEPS
