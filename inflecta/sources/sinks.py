"""Writers and the text forms they write."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inflecta.functions.text import unit_key
from inflecta.operators.merging import latest_per_key
from inflecta.session import durable
from inflecta.sources.files import STORE_TYPE


def upsert_store(store: DataFrame, new: DataFrame) -> DataFrame:
    """Store records with ``new`` ones replacing those of the same verb.

    Write the result to a new path: it reads the old one.
    """
    aged = store.select("verb", "data", F.lit(0).alias("age")).unionByName(new.select("verb", "data", F.lit(1).alias("age")))
    return latest_per_key(aged, ["verb"], "age", "data").select("verb", "data")


#: Hex digits of a verb's md5 that name its bucket: 256 buckets.
BUCKET_DIGITS = 2


def bucket_of(verb: Column) -> Column:
    """The part of a stored table that holds a verb."""
    return F.substring(F.md5(verb), 1, BUCKET_DIGITS)


def _by_bucket(records: DataFrame) -> DataFrame:
    placed = records.select("verb", "data", bucket_of(F.col("verb")).alias("bucket"))
    return placed.repartition("bucket").sortWithinPartitions("bucket", "verb")


def write_store(records: DataFrame, path: str) -> None:
    """Write a store from scratch, one folder for each bucket."""
    _by_bucket(records).write.mode("overwrite").partitionBy("bucket").parquet(path)


def upsert_into(spark: SparkSession, path: str, new: DataFrame) -> list[str]:
    """Put ``new`` records (verb, data) into the store at ``path``; the buckets that were written, others are not touched.

    The buckets of the new records are read, merged and saved, then put in place of the old ones by one
    job, which Spark commits at its end. Where that commit is cut off, the same call mends it.
    """
    new = durable(new.select("verb", "data"))
    # At most 16 ** BUCKET_DIGITS rows.
    touched = sorted(r[0] for r in new.select(bucket_of(F.col("verb"))).distinct().collect())
    if touched:
        old = spark.read.schema(STORE_TYPE).parquet(path).where(F.col("bucket").isin(touched))
        merged = durable(upsert_store(old, new))
        _by_bucket(merged).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path)
    return touched


def document_lines(store: DataFrame) -> DataFrame:
    """(verb, line): lines that, one below the other in order of the verb, are one JSON document.

    Save the store first: it is read for its first and last verb and for its lines.
    """
    member = F.col("data").substr(F.lit(2), F.length("data") - 2)
    ends = store.agg(F.min("verb").alias("first"), F.max("verb").alias("last"))
    first, last = ends.select("first").scalar(), ends.select("last").scalar()
    opening = F.when(F.col("verb") == first, "{").otherwise("")
    closing = F.when(F.col("verb") == last, "}").otherwise(",")
    return store.select("verb", F.concat(opening, member, closing).alias("line"))


def write_document(store: DataFrame, path: str) -> None:
    """Write a document as text files in order; joined in order of their names they are the document."""
    document_lines(store).orderBy("verb").select("line").write.mode("overwrite").text(path)


def headword_lines(headwords: DataFrame) -> DataFrame:
    """``verb:id`` lines."""
    return headwords.select(F.concat_ws(":", "verb", "verb_id").alias("value"))


def write_headwords(headwords: DataFrame, path: str) -> None:
    """Write the list by letter and name, homonyms of a name by their entry id."""
    headword_lines(headwords.orderBy("letter", "rank_verb", "verb_id")).write.mode("overwrite").text(path)


def _or_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def log_lines(log: DataFrame) -> DataFrame:
    """JSON lines of audit records; empty notes are left out."""
    flags = F.transform("flags", lambda f: F.struct(f["person"].alias("person"), _or_null(f["note"]).alias("note")))
    record = F.struct(
        "verb", "voice", "mood", "tense", "status", "auditor", "ts", flags.alias("flags"), _or_null(F.col("note")).alias("note")
    )
    return log.select(unit_key(*[F.col(c) for c in ("verb", "voice", "mood", "tense")]).alias("key"), F.to_json(record).alias("value"))


def write_log(log: DataFrame, path: str) -> None:
    log_lines(log).select("value").write.mode("overwrite").text(path)


def flagged_report(log: DataFrame) -> DataFrame:
    """Flagged records, flagged persons in one column."""
    return (
        log.where("status = 'flagged'")
        .select(
            "verb", "voice", "mood", "tense",
            F.array_join(F.col("flags.person"), "; ").alias("flagged_persons"),
            "note", "auditor", F.col("ts").alias("timestamp"),
        )
        .orderBy("verb", "voice", "mood", "tense")
    )


def write_flagged_report(log: DataFrame, path: str) -> None:
    flagged_report(log).write.mode("overwrite").csv(
        path, header=True, escape='"', emptyValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )
