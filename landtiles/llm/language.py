"""Language identification by prediction by partial matching: frozen byte context trees per language.

A text's code length in a language is the sum over its bytes of -log2 of the escape and symbol
probabilities (method C, no exclusion) of the deepest known context of at most ``ORDER`` bytes. The language
with the shortest code wins.

Empty and null texts, and texts without a letter, are ``und`` with score 0. Ties go to the language name
that sorts first. Repeated rows are scored alike; without any labelled text every row is ``und``.
"""

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landtiles.llm.common import bounded_sample, fold, kept_where, scored
from landtiles.llm.spans import Lookup, Texts

ORDER = 4  # bytes of context
SAMPLE = 300  # labelled texts per language that the trees are built from
UNDETERMINED = "und"
KEEP_SCORE = 0.3  # the pipeline rejects texts without a letter, and those below this score
RATE_LIMIT = 3.0  # the pipeline rejects texts that take so many times the bits of a language's usual text
RATE_STEPS = 4096  # to a bit, in which rates are counted
FREE_BITS = 64  # that a text of any length may take beyond that
HAS_LETTER = r"\p{L}"


@dataclass
class Trees:
    """Per order, known strings of context and symbol with their code lengths, and contexts with their escapes."""

    languages: list[str]
    grams: list[Lookup]
    codes: list[np.ndarray]  # bits, one column per language
    contexts: list[Lookup]
    escapes: list[np.ndarray]
    unknown: np.ndarray  # bits of a byte seen in no language

    @property
    def order(self) -> int:
        return len(self.grams) - 1


def packed(texts: Texts, order: int) -> tuple[np.ndarray, np.ndarray]:
    """The last ``order + 1`` bytes at each byte of the texts as one number, and the bytes' owners."""
    data = texts.data.astype(np.uint64)
    key = np.zeros(len(data), np.uint64)
    for back in range(order + 1):
        key[back:] |= data[: len(data) - back] << np.uint64(8 * back)
    sizes = texts.ends - texts.starts
    owner = np.repeat(np.arange(len(texts)), sizes)
    place = np.arange(len(owner)) + np.repeat(texts.starts - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes)
    return key[place], owner


def low_bytes(keys: np.ndarray, count: int) -> np.ndarray:
    return keys & np.uint64((1 << (8 * count)) - 1)


def build_trees(samples: dict[str, list[bytes]], order: int = ORDER) -> Trees:
    languages = sorted(samples)
    keys = [packed(Texts(samples[x], order), order)[0] for x in languages]
    trees = Trees(languages, [], [], [], [], np.zeros(len(languages)))
    for k in range(order + 1):
        counted = [np.unique(low_bytes(x, k + 1), return_counts=True) for x in keys]
        union = np.unique(np.concatenate([c[0] for c in counted]))
        above = np.unique(union >> np.uint64(8))
        escape = np.zeros((len(above), len(languages)))
        if k == 0:
            codes = np.full((len(union), len(languages)), 8.0)
        else:
            codes = trees.codes[-1][trees.grams[-1].find(low_bytes(union, k))].astype(float)
        for j, (known, count) in enumerate(counted):
            parent = np.searchsorted(above, known >> np.uint64(8))
            total = np.bincount(parent, count, len(above)) + np.bincount(parent, minlength=len(above))
            seen = total > 0
            distinct = np.bincount(parent, minlength=len(above))
            escape[seen, j] = np.log2(total[seen] / distinct[seen])
            codes[:, j] += escape[np.searchsorted(above, union >> np.uint64(8)), j]
            codes[np.searchsorted(union, known), j] = np.log2(total[parent] / count)
        trees.grams.append(Lookup(union))
        trees.codes.append(codes.astype(np.float32))
        trees.contexts.append(Lookup(above))
        trees.escapes.append(escape.astype(np.float32))
    trees.unknown = 8.0 + trees.escapes[0][0] if len(trees.escapes[0]) else np.full(len(languages), 8.0)
    return trees


def code_lengths(trees: Trees, texts: Texts) -> np.ndarray:
    """Bits of each text in each language."""
    key, owner = packed(texts, trees.order)
    bits = np.zeros((len(key), len(trees.languages)), np.float32)
    left = np.arange(len(key))
    for k in range(trees.order, -1, -1):
        part = low_bytes(key[left], k + 1)
        found = trees.grams[k].find(part)
        known = found >= 0
        bits[left[known]] += trees.codes[k][found[known]]
        left, part = left[~known], part[~known]
        if not len(left):
            break
        context = trees.contexts[k].find(part >> np.uint64(8))
        known = context >= 0
        if k:
            bits[left[known]] += trees.escapes[k][context[known]]
        else:
            bits[left] += trees.unknown.astype(np.float32)
    return np.stack([np.bincount(owner, bits[:, j], len(texts)) for j in range(bits.shape[1])], axis=1)


def best_language(trees: Trees, texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of the language with the shortest code, its share under equal priors, and its bits."""
    bits = code_lengths(trees, texts)
    best, least = bits.argmin(axis=1), bits.min(axis=1)
    return best, 1.0 / np.exp2(-np.minimum(bits - least[:, None], 900)).sum(axis=1), least


def fit_languages(docs: DataFrame, per_language: int = SAMPLE, order: int = ORDER) -> Trees | None:
    """Trees from at most about ``per_language`` labelled texts of each language, outside the held-out fold.

    Every value of ``lang`` with a lettered text in the sample gets a tree. The sample and the trees, a column per
    language, lie on the driver.
    """
    learned = docs.where(fold("doc_id", 5) != 0).select("doc_id", "text", "lang", F.octet_length("text").alias("size"))
    rows = bounded_sample(learned, "lang", per_language)
    samples: dict[str, list[bytes]] = {}
    for text, lang in sorted(rows.where(F.col("text").rlike(HAS_LETTER)).select("text", "lang").collect()):
        samples.setdefault(lang, []).append(text.encode())
    return build_trees(samples, order) if samples else None


def identify(docs: DataFrame, trees: Trees | None) -> DataFrame:
    """``doc_id, lang_pred, score`` for each row of ``docs``; other columns are not read."""
    lettered = docs.select(
        "doc_id", F.when(F.col("text").rlike(HAS_LETTER), F.col("text")).alias("text")
    )
    if trees is None:
        return lettered.select("doc_id", F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"))

    def score(model, texts):
        best, share, _ = best_language(model, texts)
        blank = texts.ends == texts.starts
        names = np.array([*model.languages, UNDETERMINED], dtype=object)
        return names[np.where(blank, len(model.languages), best)], np.where(blank, 0.0, share)

    return scored(lettered, {"lang_pred": "string", "score": "double"}, score, trees.order, trees)


def usual_rates(docs: DataFrame, trees: Trees | None) -> np.ndarray | None:
    """Median bits per byte of the held-out texts of each language in its own trees, of all of them.

    Rates are counted in steps of 1 / ``RATE_STEPS`` bit, so any number of texts takes the room of few counts.
    A language without held-out texts gets the largest median of the others, or 8.
    """
    if trees is None:
        return None
    kept = docs.where((fold("doc_id", 5) == 0) & F.col("doc_id").isNotNull()).select("doc_id", "text", "lang")
    rows = kept.where(F.col("lang").isin(trees.languages) & F.col("text").rlike(HAS_LETTER))

    def rate(model, texts):
        sizes = np.maximum(texts.ends - texts.starts, 1)
        return [(code_lengths(model, texts) / sizes[:, None]).tolist()]

    rates = scored(rows, {"rates": "array<double>"}, rate, trees.order, trees, ("lang",))
    own = F.get("rates", F.array_position(F.array(*map(F.lit, trees.languages)), F.col("lang")).cast("int") - 1)
    counts = rates.groupBy("lang", F.round(own * RATE_STEPS).cast("bigint").alias("steps")).count()
    found = dict(counts.groupBy("lang").agg(F.percentile("steps", 0.5, F.col("count")) / RATE_STEPS).collect())
    most = max(found.values(), default=8.0)
    return np.array([found.get(x, most) for x in trees.languages])


def with_known_language(
    docs: DataFrame, trees: Trees | None, rates: np.ndarray | None = None, least: float = KEEP_SCORE
) -> DataFrame:
    """The rows of ``docs`` whose text has a letter and a language of at least the given score.

    With ``rates`` the best language must also fit: a text of n bytes may take ``RATE_LIMIT`` times the usual bits
    of n bytes of that language, and ``FREE_BITS`` more. Texts in a language or script without a tree go by that.
    """
    lettered = docs.where(F.col("text").rlike(HAS_LETTER))
    if trees is None:
        return lettered.limit(0)

    def keep(model, texts):
        best, share, bits = best_language(model, texts)
        if rates is None:
            return share >= least
        return (share >= least) & (bits <= RATE_LIMIT * rates[best] * (texts.ends - texts.starts) + FREE_BITS)

    return kept_where(lettered, keep, trees.order, trees)
