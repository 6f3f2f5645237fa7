"""What the operators share: tables, durable intermediate tables, bounded slices of Arrow batches."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inflecta.session import checkpoint_folder

#: Texts are worked on in slices of so many rows or bytes, whichever comes first (one row at least).
SLICE_ROWS, SLICE_BYTES = 256, 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``; unset, it is refused but in a local session."""
    return checkpoint_folder(spark).rstrip("/")


class Scratch:
    """Tables written to the shared folder: they cut lineage and survive lost executors.

    ``drop`` removes a table once all that derives from it is written. What a returned DataFrame still
    reads must stay: ``keep`` makes it a checkpoint, which Spark removes with the DataFrame where
    ``spark.cleaner.referenceTracking.cleanCheckpoints`` is set.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folder = f"{shared_folder(spark)}/tables-{uuid.uuid4().hex}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.folder}/{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            self._remove(f"{self.folder}/{name}")

    def drop_all(self) -> None:
        self._remove(self.folder)

    def keep(self, df: DataFrame) -> DataFrame:
        context = self.spark.sparkContext
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(shared_folder(self.spark))
        return df.checkpoint(eager=True)

    def _remove(self, path: str) -> None:
        jvm = self.spark._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def slices(
    batches: Iterable[pa.RecordBatch], sized: str, most_rows: int = SLICE_ROWS, most_bytes: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in order, in slices bounded by rows and by the bytes of column ``sized``."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(sized))
        start, size = 0, 0
        lengths = pa.compute.binary_length(column).fill_null(0).to_pylist() if batch.num_rows else []
        for row, length in enumerate(lengths):
            if row > start and (row - start >= most_rows or size + length > most_bytes):
                yield batch.slice(start, row - start)
                start, size = row, 0
            size += length
        if start < batch.num_rows:
            yield batch.slice(start)


def refuse(columns: Iterable[str], *names: str) -> None:
    """Refuse an input that has a column of one of the output ``names``; Spark does not tell upper from lower case."""
    taken = {c.lower() for c in columns} & {n.lower() for n in names}
    if taken:
        raise ValueError(f"the input already has columns named {sorted(taken)}")


def fold_of(doc_id: str | Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; NULL for a NULL id."""
    return F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")) % folds


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, per_class: int, skip: int = 0, text: str = "text", folds: int = 5
) -> DataFrame:
    """(doc_id, text, label) of a bounded sample: ``per_class`` labelled documents of each class 0 and 1.

    They are those of least hash outside the held-out fold (remainder 0), after the first ``skip``; the same in
    every run. They are chosen from the labels alone: at most ``2 * per_class`` ids are broadcast, and of the rows of
    one id the greatest text counts, so the sample has at most ``2 * per_class`` rows, whatever repeats.
    A document with several labels has the greatest.
    """
    ranked = training_labels(labels, label, folds).select(label, "doc_id", F.xxhash64("doc_id").alias("_h"))
    chosen = None
    for one in (0, 1):
        top = ranked.where(F.col(label) == one).orderBy("_h", "doc_id").offset(skip).limit(per_class)
        chosen = top if chosen is None else chosen.unionByName(top)
    rows = docs.select("doc_id", text).join(F.broadcast(chosen.drop("_h")), "doc_id")
    return spread(rows.groupBy("doc_id", label).agg(F.max(text).alias(text)).select("doc_id", text, label))


def spread(sample: DataFrame) -> DataFrame:
    """The rows of a bounded sample, dealt over as many tasks as run at once: they are few bytes, but much work."""
    return sample.repartition(min(64, sample.sparkSession.sparkContext.defaultParallelism), "doc_id")


def training_labels(labels: DataFrame, label: str, folds: int = 5) -> DataFrame:
    """(doc_id, label) of all documents labelled 0 or 1 outside the held-out fold."""
    known = labels.where(F.col(label).isin(0, 1) & (fold_of("doc_id", folds) != 0))
    return known.groupBy("doc_id").agg(F.max(label).cast("int").alias(label))


def class_sizes(labels: DataFrame, label: str) -> tuple[int, int]:
    """Labelled documents of class 0 and 1 in the training folds."""
    sizes = {r[0]: r[1] for r in training_labels(labels, label).groupBy(label).count().collect()}
    return sizes.get(0, 0), sizes.get(1, 0)


def sample_of_classes(rows: DataFrame, column: str, per_class: int) -> DataFrame:
    """At most ``per_class`` rows of each value of ``column`` (few values), those of least hash of doc_id; ids are broadcast."""
    keyed = rows.select(F.col(column).alias("_c"), F.xxhash64("doc_id").alias("_h"), F.col("doc_id").alias("_d"))
    chosen = None
    for (one,) in keyed.select("_c").distinct().orderBy("_c").collect():  # a row for each class
        top = keyed.where(F.col("_c") == F.lit(one)).orderBy("_h", "_d").limit(per_class).select("_d")
        chosen = top if chosen is None else chosen.unionByName(top)
    if chosen is None:
        return rows.limit(0)
    return rows.join(F.broadcast(chosen.distinct()), F.col("doc_id") == F.col("_d"), "left_semi")
