"""What several operators on documents share: folds, bounded samples of labelled rows, per-text scoring."""

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landtiles.llm.spans import chunks
from landtiles.session import cut

LEAST = 8  # rows drawn of a value of any size, if it has as many


def fold(doc_id: Column | str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id falls in fold 0, as a row nobody learns from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")), F.lit(0)) % folds


def documents(spark, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def bounded_sample(rows: DataFrame, strata: str, most: int, longest: int = 1 << 16) -> DataFrame:
    """About ``most`` rows of each value of ``strata``, chosen by a hash of ``doc_id``; all rows where there are fewer.

    ``size`` is the bytes of a row's text. All rows of a value have the same chance, however long they are. Where a
    value's rows have more than ``longest`` bytes on average, the chance is smaller, so that about ``most * longest``
    bytes are drawn, but not below that of about ``LEAST`` rows. There may be any number of values: their counts are
    a stored table, joined to the rows. Column ``total`` is the number of all rows with the row's value.
    """
    rows = rows.where(F.col(strata).isNotNull() & F.col("doc_id").isNotNull())
    counts = rows.groupBy(strata).agg(F.count(F.lit(1)).alias("total"), F.sum(F.coalesce("size", F.lit(0))).alias("bytes"))
    within = F.least(F.lit(float(most)), F.lit(float(most) * longest) * F.col("total") / F.greatest("bytes", F.lit(1)))
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) / float(1 << 20)
    chosen = draw < F.greatest(within, F.lit(float(min(LEAST, most)))) / F.col("total")
    return rows.join(cut(counts, "strata"), strata).where(chosen).drop("bytes")


def natural_weights(marks: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """Weights of sampled rows, 1 on average, that give each mark its share of the rows the sample was drawn from."""
    sampled = np.unique(marks, return_inverse=True, return_counts=True)
    weight = totals / sampled[2][sampled[1]]
    return weight / weight.mean()


def give_back() -> None:
    """Return memory that a task has freed to the system; Python workers live on and serve further stages."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library than glibc
        pass


def scored(
    docs: DataFrame, columns: dict[str, str], score: Callable, pad: int = 1, model=None, carried: tuple[str, ...] = ()
) -> DataFrame:
    """``doc_id``, the ``carried`` columns and new ones that ``score(model, texts)`` gives for each run of whole texts.

    ``score`` returns one array per new column. One pass over the rows, no shuffle.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    names = list(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, texts in chunks(batch.column("text"), pad):
                made = score(sent.value, texts)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).slice(first, last - first) for c in ("doc_id", *carried)), *map(pa.array, made)],
                    names=["doc_id", *carried, *names],
                )
        give_back()

    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    schema = ", ".join(["doc_id bigint", *(f"{c} {kinds[c]}" for c in carried), *(f"{n} {t}" for n, t in columns.items())])
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), *carried, "text").mapInArrow(run, schema)


def kept_where(docs: DataFrame, keep: Callable, pad: int = 1, model=None) -> DataFrame:
    """The rows of ``docs``, columns unchanged, for whose texts ``keep(model, texts)`` is true."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flags = [keep(sent.value, texts) for _, _, texts in chunks(batch.column("text"), pad)]
            if flags:
                yield batch.filter(pa.array(np.concatenate(flags)))
        give_back()

    return docs.mapInArrow(run, docs.schema)


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))
