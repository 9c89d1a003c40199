"""Quality rules: counted measures with fixed limits, and a calibrated n-gram model with a fixed threshold.

The model is a logistic regression on hashed word n-grams and byte n-grams of a text, each kind as relative
frequencies, fitted on labelled texts and calibrated by a logistic curve on labelled texts kept out of the fit.

Null and empty texts have no words, so they fail the base limits. Repeated rows get the same row. Without
labels of both kinds the base limits decide alone.
"""

from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landtiles.llm.common import natural_weights, scored, sigmoid
from landtiles.llm.quality import labelled_sample
from landtiles.llm.spans import IS_SPACE, Texts, chunks, mixed, occurrences, owners, paired, sums_within

SAMPLE = 2000  # labelled texts of each mark for fit and calibration together
BITS = 18
WORD_GRAMS, BYTE_GRAMS = (1, 2), (3, 5)
EPOCHS, RATE = 4, 0.5
LEAST_WORDS = 50
MOST_REPEATED = 50  # percent of the words
THRESHOLD = 0.5  # calibrated probability of quality 1
IS_SYMBOL = np.isin(np.arange(256), [ord(c) for c in "#*$%&|<>"])
STARTS_CHARACTER = (np.arange(256) & 0xC0) != 0x80


def within(texts: Texts, flags: np.ndarray) -> np.ndarray:
    """How many flagged bytes each text has."""
    total = np.append(0, np.cumsum(flags))
    return total[texts.ends] - total[texts.starts]


def measures(texts: Texts) -> dict[str, np.ndarray]:
    """Whole counts per text; words are runs of anything but the six ASCII blanks, lines end at line feeds."""
    start, end, bounds = texts.words()
    of, word = owners(bounds), texts.hashes(start, end)
    repeated = np.zeros(len(word), bool)
    if len(word) > 2:
        grams = paired(paired(word[:-2], word[1:-1]), word[2:])
        inside = of[2:] == of[:-2]
        again = np.zeros(len(grams), bool)
        again[inside] = occurrences(grams[inside], of[:-2][inside]) > 1
        for shift in range(3):
            repeated[shift : len(word) - 2 + shift] |= again
    line_start, line_end, line_bounds = texts.lines()
    total = np.append(0, np.cumsum(~IS_SPACE[texts.data]))
    real = total[line_end] > total[line_start]
    line_hash, line_of = texts.hashes(line_start, line_end)[real], owners(line_bounds)[real]
    distinct = np.unique(paired(line_hash, line_of.astype(np.uint64)), return_index=True)[1]
    n = len(texts)
    return {
        "n_words": np.diff(bounds),
        "word_chars": within(texts, STARTS_CHARACTER[texts.data] & ~IS_SPACE[texts.data]),
        "n_symbols": within(texts, IS_SYMBOL[texts.data]),
        "n_dup_lines": np.bincount(line_of, minlength=n) - np.bincount(line_of[distinct], minlength=n),
        "n_repeat_words": sums_within(repeated, bounds),
    }


def fails_base(found: dict[str, np.ndarray]) -> np.ndarray:
    return (found["n_words"] < LEAST_WORDS) | (100 * found["n_repeat_words"] > MOST_REPEATED * found["n_words"])


def gram_kinds(texts: Texts, bits: int = BITS) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each kind of n-gram, buckets (a range of their own per kind) and bounds per text."""
    start, end, bounds = texts.words()
    of, word = owners(bounds), texts.hashes(start, end)
    kinds, run = [], word
    for size in WORD_GRAMS:
        if size > 1:
            run = paired(run[:-1], word[size - 1 :], size)
        inside = of[size - 1 :] == of[: len(of) - size + 1]
        kinds.append((mixed(run, 40 + size)[inside], of[: len(inside)][inside]))
    sizes = texts.ends - texts.starts
    for size in BYTE_GRAMS:
        whole = np.maximum(sizes - size + 1, 0)
        of_gram = np.repeat(np.arange(len(texts)), whole)
        first = np.repeat(texts.starts - np.append(0, np.cumsum(whole)[:-1]), whole) + np.arange(len(of_gram))
        packed = np.zeros(len(of_gram), np.uint64)
        for k in range(size):
            packed = (packed << np.uint64(8)) | texts.data[first + k].astype(np.uint64)
        kinds.append((mixed(packed, 60 + size), of_gram))
    made = []
    for number, (hashed, owner) in enumerate(kinds):
        bucket = (hashed >> np.uint64(64 - bits)).astype(np.int64) + (number << bits)
        made.append((bucket, np.searchsorted(owner, np.arange(len(texts) + 1))))
    return made


@dataclass
class Linear:
    weight: np.ndarray
    bias: float
    slope: float = 1.0
    shift: float = 0.0

    def raw(self, texts: Texts) -> np.ndarray:
        total = np.full(len(texts), self.bias)
        for bucket, bounds in gram_kinds(texts):
            total += sums_within(self.weight[bucket], bounds) / np.maximum(np.diff(bounds), 1)
        return total

    def score(self, texts: Texts) -> np.ndarray:
        return sigmoid(self.slope * self.raw(texts) + self.shift)


def fit_linear(runs: Iterable[Texts], marks: np.ndarray, epochs: int = EPOCHS, seed: int = 5) -> Linear:
    """Stochastic gradient steps with a rate per weight that shrinks with the gradients it has seen."""
    size = (len(WORD_GRAMS) + len(BYTE_GRAMS)) << BITS
    weight, seen, bias, bias_seen = np.zeros(size), np.full(size, 1e-8), 0.0, 1e-8
    draw = np.random.default_rng(seed)
    balance = {m: len(marks) / (2 * max((marks == m).sum(), 1)) for m in (0, 1)}
    rows = []
    for texts in runs:
        kinds = gram_kinds(texts)
        for i in range(len(texts)):
            parts = [np.unique(b[bounds[i] : bounds[i + 1]], return_counts=True) for b, bounds in kinds]
            share = np.concatenate([c / max(c.sum(), 1) for _, c in parts])
            rows.append((np.concatenate([b for b, _ in parts]).astype(np.int32), share.astype(np.float32)))
    for _ in range(epochs):
        for i in draw.permutation(len(rows)):
            at, value = rows[i]
            wrong = (sigmoid(bias + weight[at] @ value) - marks[i]) * balance[marks[i]]
            slope = wrong * value
            seen[at] += slope * slope
            weight[at] -= RATE * slope / np.sqrt(seen[at])
            bias_seen += wrong * wrong
            bias -= RATE * wrong / np.sqrt(bias_seen)
    return Linear(weight.astype(np.float32), bias)


def calibrate(raw: np.ndarray, marks: np.ndarray, weight: np.ndarray | None = None, steps: int = 50) -> tuple[float, float]:
    """Slope and shift of the logistic curve from raw scores to marks, with the usual smoothed targets.

    ``weight`` is how much each row counts, all alike if not given.
    """
    counts = np.ones(len(marks)) if weight is None else weight
    target = np.where(marks == 1, ((marks == 1).sum() + 1) / ((marks == 1).sum() + 2), 1 / ((marks == 0).sum() + 2))
    scale = max(raw.std(), 1e-9)
    x = np.column_stack([raw / scale, np.ones(len(raw))])
    w = np.zeros(2)
    for _ in range(steps):
        p = sigmoid(x @ w)
        curve = (x * (counts * p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(curve, x.T @ (counts * (target - p)))
        w += step * min(1.0, 2.0 / (np.linalg.norm(step) + 1e-12))
    return float(w[0] / scale), float(w[1])


def fit_rules(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> Linear | None:
    """A calibrated model from at most about ``most`` texts of each mark, outside the held-out fold.

    Every fourth sampled text is for calibration. The sample is bounded and met in one task. Calibration weighs its
    texts by the counts of the marks over all training rows, so scores do not follow the bound.
    """
    rows = labelled_sample(docs, labels, "quality", most)

    def train(batches):
        batches = list(batches)
        if not sum(map(len, batches)):
            return
        table = pa.Table.from_batches(batches).combine_chunks()
        marks, totals = table.column("mark").to_numpy(), table.column("total").to_numpy()
        apart = np.arange(len(marks)) % 4 == 3
        if len(set(marks[apart])) < 2 or len(set(marks[~apart])) < 2:
            return
        text = table.column("text").combine_chunks()
        runs = lambda where: (texts for _, _, texts in chunks(text.filter(pa.array(where))))
        model = fit_linear(runs(~apart), marks[~apart])
        raw = np.concatenate([model.raw(texts) for texts in runs(apart)])
        slope, shift = calibrate(raw, marks[apart], natural_weights(marks[apart], totals[apart]))
        at = np.flatnonzero(model.weight)
        yield pa.RecordBatch.from_arrays(
            [pa.array([at.astype(np.int32).tobytes()]), pa.array([model.weight[at].tobytes()]), pa.array([model.bias]), pa.array([slope]), pa.array([shift])],
            names=["at", "weight", "bias", "slope", "shift"],
        )

    ordered = rows.select("doc_id", "text", F.col("mark").cast("int"), "total").repartition(1).sortWithinPartitions("doc_id")
    found = ordered.mapInArrow(train, "at binary, weight binary, bias double, slope double, shift double").collect()
    if not found:
        return None
    weight = np.zeros((len(WORD_GRAMS) + len(BYTE_GRAMS)) << BITS, np.float32)
    weight[np.frombuffer(found[0].at, np.int32)] = np.frombuffer(found[0].weight, np.float32)
    return Linear(weight, found[0].bias, found[0].slope, found[0].shift)


def apply_rules(docs: DataFrame, model: Linear | None, threshold: float = THRESHOLD) -> DataFrame:
    """Per row of ``docs`` its ``doc_id``, measures, ``base_failed``, calibrated ``score`` and ``kept``."""
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

    def judge(m, texts):
        found = measures(texts)
        failed = fails_base(found)
        score = np.ones(len(texts)) if m is None else m.score(texts)
        return [*(found[c].astype(np.int64) for c in counts), failed, score, ~failed & (score >= threshold)]

    columns = {c: "bigint" for c in counts} | {"base_failed": "boolean", "score": "double", "kept": "boolean"}
    return scored(docs, columns, judge, model=model)
