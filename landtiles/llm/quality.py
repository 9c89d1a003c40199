"""Document quality by Bradley-Terry ranking of labelled pairs, cut at a quantile of the scores.

From each preference pair (a text marked 1, a text marked 0) the weights learn by logistic loss on the
difference of their features, so a document's score is a weighted sum of its own features. The cut is the
quantile of the training scores that leaves the marked share of 0 below it; scores are mapped to 0..1 so that
the cut falls on ``KEEP_SCORE``.

Null and empty texts have all features at zero and are scored like any text. Repeated rows are scored alike.
Without labels of both kinds every score is 1.
"""

from dataclasses import dataclass, replace

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landtiles.llm.common import bounded_sample, fold, kept_where, scored, sigmoid
from landtiles.llm.spans import Texts, occurrences, owners, paired, sums_within
from landtiles.session import cut

SAMPLE = 4000  # labelled texts of each mark whose features are fitted
PAIRS_PER_TEXT = 4
RANK_ACCURACY = 100_000  # the cut's rank is off by one row in so many at most
KEEP_SCORE = 0.3
_UPPER, _DIGIT, _SYMBOL, _STOP, _LOUD, _OTHER_MARK, _HIGH, _LETTER, _GAP = range(9)


def _byte_classes() -> np.ndarray:
    kind = np.full(256, _OTHER_MARK, np.uint8)
    for first, last, name in (
        ("a", "z", _LETTER), ("A", "Z", _UPPER), ("0", "9", _DIGIT)
    ):
        kind[ord(first) : ord(last) + 1] = name
    for marks, name in (("#*$%&|<>", _SYMBOL), (".,;:'\"-", _STOP), ("!?", _LOUD)):
        kind[[ord(c) for c in marks]] = name
    kind[128:] = _HIGH
    kind[:33] = _GAP
    return kind


BYTE_CLASS = _byte_classes()


def features(texts: Texts) -> np.ndarray:
    """One row of plain measures per text: shares of characters, of repeated words and lines, lengths."""
    n = len(texts)
    sizes = texts.ends - texts.starts
    owner = np.repeat(np.arange(n), sizes)
    place = np.arange(len(owner)) + np.repeat(texts.starts - np.append(0, np.cumsum(sizes)[:-1]), sizes)
    kinds = np.bincount(owner * 9 + BYTE_CLASS[texts.data[place]], minlength=n * 9).reshape(n, 9)
    shares = kinds / np.maximum(sizes, 1)[:, None]

    start, end, bounds = texts.words()
    words = np.diff(bounds)
    of = owners(bounds)
    hashed = texts.hashes(start, end)
    same = np.zeros(len(hashed), bool)
    same[1:] = (hashed[1:] == hashed[:-1]) & (of[1:] == of[:-1])
    first = occurrences(hashed, of)
    distinct = sums_within(1.0 / first, bounds) if len(first) else np.zeros(n)
    triple = np.zeros(len(hashed), bool)
    if len(hashed) > 2:
        inside = of[2:] == of[:-2]
        grams = paired(paired(hashed[:-2], hashed[1:-1]), hashed[2:])
        again = (occurrences(grams, of[:-2]) > 1) & inside
        for shift in range(3):
            triple[shift : len(triple) - 2 + shift] |= again

    line_start, line_end, line_bounds = texts.lines()
    line_of = owners(line_bounds)
    times = occurrences(texts.hashes(line_start, line_end), line_of)
    lines = np.diff(line_bounds)
    line_distinct = sums_within(1.0 / times, line_bounds)

    per_word = lambda x: sums_within(x, bounds) / np.maximum(words, 1)
    rates = np.column_stack(
        [
            shares,
            per_word(same.astype(float)),
            distinct / np.maximum(words, 1),
            per_word(triple.astype(float)),
            1.0 - line_distinct / np.maximum(lines, 1),
            per_word(((end - start) > 18).astype(float)),
            per_word(((end - start) < 3).astype(float)),
        ]
    )
    lengths = np.column_stack(
        [np.log1p(words), np.log1p(sizes / np.maximum(words, 1)), np.log1p(lines), np.log1p(words / np.maximum(lines, 1))]
    )
    return np.column_stack([rates, np.sqrt(np.maximum(rates, 0)), lengths, lengths**2])


@dataclass
class Ranker:
    weights: np.ndarray
    center: np.ndarray
    scale: np.ndarray
    cut: float
    spread: float

    def raw(self, rows: np.ndarray) -> np.ndarray:
        return ((rows - self.center) / self.scale) @ self.weights

    def score(self, rows: np.ndarray) -> np.ndarray:
        return sigmoid((self.raw(rows) - self.cut) / self.spread + np.log(KEEP_SCORE / (1 - KEEP_SCORE)))


def fit_ranker(rows: np.ndarray, marks: np.ndarray, share: float, ridge: float = 1e-3, seed: int = 7) -> Ranker | None:
    """Weights from preference pairs by Newton steps, and the cut at the quantile ``share`` of all rows.

    ``share`` is the part of texts marked 0 before the sample was drawn, so the two kinds are weighed back.
    """
    good, bad = np.flatnonzero(marks == 1), np.flatnonzero(marks == 0)
    if not len(good) or not len(bad):
        return None
    center, scale = rows.mean(axis=0), rows.std(axis=0)
    scale = np.where(scale > 1e-9, scale, 1.0)
    x = (rows - center) / scale
    draw = np.random.default_rng(seed)
    pairs = PAIRS_PER_TEXT * (len(good) + len(bad))
    gap = x[draw.choice(good, pairs)] - x[draw.choice(bad, pairs)]
    weights = np.zeros(x.shape[1])
    for _ in range(12):
        wrong = sigmoid(-(gap @ weights))
        slope = gap.T @ wrong / pairs - ridge * weights
        curve = (gap * (wrong * (1 - wrong))[:, None]).T @ gap / pairs + ridge * np.eye(len(weights))
        step = np.linalg.solve(curve, slope)
        weights += step * min(1.0, 5.0 / (np.linalg.norm(step) + 1e-12))
    raw = x @ weights
    order = np.argsort(raw, kind="stable")
    mass = np.where(marks == 1, (1 - share) / len(good), share / len(bad))[order].cumsum()
    # between the last row inside the quantile and the next one
    inside = min(np.searchsorted(mass, share - 1e-9), len(raw) - 2)
    cut = raw[order][inside : inside + 2].mean()
    return Ranker(weights, center, scale, float(cut), float(max(raw.std() / 4, 1e-6)))


def labelled(docs: DataFrame, labels: DataFrame, mark: str) -> DataFrame:
    """``doc_id, text, mark`` of the rows one may learn from; of several marks of an id the smallest holds."""
    marks = labels.where((fold("doc_id", 5) != 0) & F.col(mark).isin(0, 1)).groupBy("doc_id").agg(F.min(mark).alias("mark"))
    return docs.select("doc_id", "text").join(marks, "doc_id")


def labelled_sample(docs: DataFrame, labels: DataFrame, mark: str, most: int) -> DataFrame:
    """``doc_id, text, mark, total`` of a bounded sample of ``labelled``; texts that are not drawn are not shuffled.

    An id gives one row, however often it is repeated: its smallest text.
    """
    sizes = docs.select("doc_id", F.octet_length("text").alias("text"))
    rows = labelled(sizes, labels, mark).groupBy("doc_id", "mark").agg(F.min("text").alias("size"))
    drawn = cut(bounded_sample(cut(rows, "labelled"), "mark", most).select("doc_id", "mark", "total"), "drawn")
    return docs.select("doc_id", "text").join(drawn, "doc_id").groupBy("doc_id", "mark", "total").agg(F.min("text").alias("text"))


def feature_rows(docs: DataFrame, carried: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id``, the ``carried`` columns and the array of features of each row."""
    return scored(docs, {"features": "array<double>"}, lambda _, texts: [list(features(texts))], carried=carried)


def fit_quality(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> Ranker | None:
    """A ranker from at most about ``most`` texts of each mark, outside the held-out fold.

    The cut is the quantile of the scores of all labelled rows outside that fold at the share of those marked 0.
    """
    ids = docs.select("doc_id", F.lit(None).alias("text"))
    sample = feature_rows(labelled_sample(docs, labels, "quality", most), ("mark",))
    found = sorted(sample.select("doc_id", "mark", "features").collect())
    counts = dict(labelled(ids, labels, "quality").groupBy("mark").count().collect()) if found else {}
    share = counts.get(0, 0) / max(sum(counts.values()), 1)
    model = found and fit_ranker(np.array([r.features for r in found]), np.array([r.mark for r in found]), share)
    if not model:
        return None
    # every text is scored where it lies; only ids and scores meet the labels
    every = scored(docs, {"text": "double"}, lambda m, texts: [m.raw(features(texts))], model=model)
    raw = cut(labelled(every, labels, "quality").select(F.col("text").alias("raw")), "scores")
    # between the last row inside the quantile and the next one
    inside = raw.agg(F.percentile_approx("raw", share, RANK_ACCURACY)).first()[0]
    after = raw.where(F.col("raw") > inside).agg(F.min("raw")).first()[0]
    return replace(model, cut=float(inside if after is None else (inside + after) / 2))


def _scores(model: Ranker | None, texts: Texts) -> np.ndarray:
    return np.ones(len(texts)) if model is None else model.score(features(texts))


def rank(docs: DataFrame, model: Ranker | None) -> DataFrame:
    """``doc_id, score`` of each row of ``docs``; other columns are not read."""
    return scored(docs, {"score": "double"}, lambda m, texts: [_scores(m, texts)], model=model)


def of_good_quality(docs: DataFrame, model: Ranker | None, least: float = KEEP_SCORE) -> DataFrame:
    """The rows of ``docs`` at or above the cut, columns unchanged."""
    return kept_where(docs, lambda m, texts: _scores(m, texts) >= least, model=model)
