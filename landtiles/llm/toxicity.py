"""Toxicity by logistic regression, fitted with FTRL-proximal on hashed word n-grams and skip-grams.

Features of a text are the distinct buckets of its words (letters, digits and bytes above 127, A-Z in lower
case), word pairs, and pairs with one or two words between. Each weight has its own learning rate and an L1
threshold below which it is exactly zero, so what is sent to the executors is a short list.

Null and empty texts get the score of the bias alone. Repeated rows are scored alike, labels of a repeated id count
once. Without labels every score is 0.
"""

from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landtiles.llm.common import natural_weights, scored, sigmoid
from landtiles.llm.quality import labelled_sample
from landtiles.llm.spans import Texts, chunks, mixed, owners, paired

SAMPLE = 3000  # labelled texts of each mark that are learned from
BITS = 20
RATE, SMOOTH, L1, L2, EPOCHS = 0.5, 1.0, 8.0, 1.0, 4
SKIPS = (1, 2, 3)  # distance of the two words of a pair

_code = np.arange(256)
NOT_WORD = ~(
    ((_code >= 48) & (_code < 58)) | ((_code >= 65) & (_code < 91)) | ((_code >= 97) & (_code < 123)) | (_code > 127)
)


def buckets(texts: Texts, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of each text without repeats, and the text each belongs to."""
    low = texts.lowered()
    start, end, bounds = low.words(NOT_WORD)
    of, word = owners(bounds), low.hashes(start, end)
    grams, owner = [mixed(word, 11)], [of]
    for skip in SKIPS:
        inside = of[skip:] == of[:-skip]
        grams.append(paired(word[:-skip], word[skip:], 20 + skip)[inside])
        owner.append(of[skip:][inside])
    bucket = np.concatenate(grams) >> np.uint64(64 - bits)
    key = np.unique((np.concatenate(owner).astype(np.uint64) << np.uint64(bits)) | bucket)
    return (key & np.uint64((1 << bits) - 1)).astype(np.int64), (key >> np.uint64(bits)).astype(np.int64)


@dataclass
class SparseWeights:
    at: np.ndarray  # buckets with a weight that is not zero, sorted
    weight: np.ndarray
    bias: float
    bits: int = BITS

    def score(self, texts: Texts) -> np.ndarray:
        bucket, owner = buckets(texts, self.bits)
        if not hasattr(self, "_dense"):
            self._dense = np.zeros(1 << self.bits, np.float32)
            self._dense[self.at] = self.weight
        return sigmoid(self.bias + np.bincount(owner, self._dense[bucket], len(texts)))


class Ftrl:
    """Per-coordinate FTRL-proximal for logistic loss; the last coordinate is the bias, without L1."""

    def __init__(self, size: int, rate=RATE, smooth=SMOOTH, l1=L1, l2=L2):
        self.z, self.n = np.zeros(size + 1), np.zeros(size + 1)
        self.rate, self.smooth, self.l1, self.l2 = rate, smooth, l1, l2

    def weights(self, at) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        pull = np.where(at == len(self.z) - 1, 0.0, self.l1)
        step = (self.smooth + np.sqrt(n)) / self.rate + self.l2
        return np.where(np.abs(z) <= pull, 0.0, (np.sign(z) * pull - z) / step)

    def learn(self, at: np.ndarray, mark: int, weight: float = 1.0) -> None:
        at = np.append(at, len(self.z) - 1)
        w = self.weights(at)
        slope = weight * (sigmoid(w.sum()) - mark)
        n = self.n[at]
        self.z[at] += slope - (np.sqrt(n + slope * slope) - np.sqrt(n)) / self.rate * w
        self.n[at] = n + slope * slope


def learn_weights(
    runs: Iterable[Texts], marks: np.ndarray, weight: np.ndarray | None = None, epochs: int = EPOCHS, seed: int = 3
) -> SparseWeights:
    """Weights from texts, given in runs, their marks, and how much each text counts (all alike if not given)."""
    counts = np.ones(len(marks)) if weight is None else weight
    rows = []
    for texts in runs:
        bucket, owner = buckets(texts)
        rows += np.split(bucket.astype(np.int32), np.searchsorted(owner, np.arange(1, len(texts))))
    model, draw = Ftrl(1 << BITS), np.random.default_rng(seed)
    for _ in range(epochs):
        for i in draw.permutation(len(rows)):
            model.learn(rows[i], marks[i], counts[i])
    every = model.weights(np.arange((1 << BITS) + 1))
    at = np.flatnonzero(every[:-1])
    return SparseWeights(at, every[at].astype(np.float32), float(every[-1]))


def fit_toxicity(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> SparseWeights | None:
    """Weights from at most about ``most`` texts of each mark, outside the held-out fold.

    FTRL goes through its examples one after the other, so the sample, which is bounded, meets in one task. Its
    texts are weighed by the counts of the marks over all training rows, so the bias does not follow the bound.
    """
    rows = labelled_sample(docs, labels, "toxic", most)

    def train(batches):
        batches = list(batches)
        if not sum(map(len, batches)):
            return
        table = pa.Table.from_batches(batches).combine_chunks()
        text = table.column("text").combine_chunks()
        marks = table.column("mark").to_numpy()
        weight = natural_weights(marks, table.column("total").to_numpy())
        model = learn_weights((texts for _, _, texts in chunks(text)), marks, weight)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([model.at.tolist()], pa.list_(pa.int64())),
                pa.array([model.weight.tolist()], pa.list_(pa.float32())),
                pa.array([model.bias]),
            ],
            names=["at", "weight", "bias"],
        )

    ordered = rows.select("doc_id", "text", F.col("mark").cast("int"), "total").repartition(1).sortWithinPartitions("doc_id")
    found = ordered.mapInArrow(train, "at array<bigint>, weight array<float>, bias double").collect()
    return SparseWeights(np.array(found[0].at, np.int64), np.array(found[0].weight, np.float32), found[0].bias) if found else None


def toxicity(docs: DataFrame, model: SparseWeights | None) -> DataFrame:
    """``doc_id, score`` of each row of ``docs``; other columns are not read."""
    return scored(
        docs, {"score": "double"}, lambda m, texts: [np.zeros(len(texts)) if m is None else m.score(texts)], model=model
    )
