"""Readers of the raw inputs. Parsing is separate from reading, so any table of lines will do."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inflecta.functions.text import last_segment, plain_apostrophe, strip

LOG_TYPE = (
    "verb string, voice string, mood string, tense string, status string, auditor string, ts string, "
    "flags array<struct<person:string,note:string>>, note string"
)
#: Buckets are names, not numbers: the type keeps their leading zeros.
STORE_TYPE = "verb string, data string, bucket string"
SEARCH_TYPE = "struct<result:array<struct<nature:string,label:string,url:string>>>"


def parse_page_files(files: DataFrame) -> DataFrame:
    """(verb, html) of page files (path, content) named ``<verb>.html``; other files are no pages."""
    pages = files.where(F.endswith("path", F.lit(".html")))
    return pages.select(F.regexp_extract("path", r"([^/]*)\.html$", 1).alias("verb"), F.decode("content", "UTF-8").alias("html"))


def scan_pages(spark: SparkSession, path: str) -> DataFrame:
    """(verb, html) of a folder of ``<verb>.html`` files."""
    return parse_page_files(spark.read.format("binaryFile").option("pathGlobFilter", "*.html").load(path))


def pages_of_headwords(pages: DataFrame, headwords: DataFrame) -> DataFrame:
    """(verb, verb_id, html) of all headwords; html is NULL where there is no page, which parsing reports."""
    return headwords.select("verb", "verb_id").join(pages.select("verb", "html"), "verb", "left")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line_no, value); ``line_no`` rises by file name and place in the file, however Spark orders its tasks.

    It is a struct of the file's path, the offset of the split that was read and the row in it.
    """
    place = F.struct(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("row")
    )
    return spark.read.text(path).select(place.alias("line_no"), "value")


def parse_headwords(lines: DataFrame) -> DataFrame:
    """``verb:id`` or ``verb`` lines to (verb, verb_id); blank lines are skipped."""
    text = strip(F.col("value"))
    parts = F.split(text, ":", 2)
    return lines.where(text != "").select(strip(F.get(parts, 0)).alias("verb"), strip(F.get(parts, 1)).alias("verb_id"))


def _entries(lines: DataFrame) -> DataFrame:
    """Lines that are neither blank nor comments, split at the first colon."""
    text = strip(F.col("value"))
    kept = lines.where((text != "") & ~text.startswith("#"))
    parts = F.split(text, ":", 2)
    return kept.withColumn("verb", strip(F.get(parts, 0))).withColumn("rest", strip(F.get(parts, 1)))


def parse_exclusions(lines: DataFrame) -> DataFrame:
    """Distinct verbs of an exclusion list; what follows the colon is documentation."""
    return _entries(lines).where("verb <> ''").select("verb").distinct()


def parse_remaps(lines: DataFrame) -> DataFrame:
    """(verb, verb_id) of a remap list; a trailing ``*`` is dropped and the last line of a verb counts."""
    pairs = _entries(lines).withColumn("verb_id", F.rtrim("rest", F.lit("*"))).where("verb <> '' AND verb_id <> ''")
    return pairs.groupBy("verb").agg(F.max_by("verb_id", "line_no").alias("verb_id"))


def count_lines(lines: DataFrame) -> DataFrame:
    """All lines, and those with text."""
    return lines.agg(F.count("*").alias("lines"), F.count_if(strip(F.col("value")) != "").alias("with_text"))


def search_candidates(responses: DataFrame, column: str = "response") -> DataFrame:
    """(verb, pos, nature, label, url) of search responses, in response order."""
    results = F.from_json(column, SEARCH_TYPE)["result"]
    rows = responses.select("verb", F.posexplode(results).alias("pos", "r"))
    return rows.select("verb", "pos", *[F.coalesce(f"r.{c}", F.lit("")).alias(c) for c in ("nature", "label")], "r.url")


def resolve_entries(candidates: DataFrame) -> DataFrame:
    """(verb, verb_id): the first candidate whose label is the verb, not defective ones first."""
    label = plain_apostrophe(F.col("label"))
    label = F.replace(F.replace(label, F.lit(" (s')"), F.lit("")), F.lit(" (se)"), F.lit(""))
    matches = candidates.where(F.col("nature").contains("v.") & (label == F.col("verb")))
    defective = F.lower("nature").contains("défectif")
    best = matches.groupBy("verb").agg(F.min_by("url", F.struct(defective, "pos")).alias("url"))
    return best.select("verb", last_segment(F.col("url")).alias("verb_id"))


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """Stored records (verb, data) in order of the verb."""
    return stored_records(spark, path).orderBy("verb")


def stored_records(spark: SparkSession, path: str) -> DataFrame:
    """Stored records (verb, data), of a store in buckets or of one table."""
    return spark.read.schema(STORE_TYPE).parquet(path).select("verb", "data")


def parse_document(lines: DataFrame, column: str = "value") -> DataFrame:
    """(verb, entry) of document lines as ``document_lines`` makes them: one member a line.

    The brace and comma around a member are cut off, so each line is an object of its own.
    """
    member = F.regexp_replace(F.regexp_replace(strip(F.col(column)), r"^\{", ""), r"[,}]$", "")
    objects = lines.where(member != "").select(F.concat(F.lit("{"), member, F.lit("}")).alias("object"))
    return objects.select(F.explode(F.from_json("object", "map<string,string>")).alias("verb", "entry"))


def read_document(spark: SparkSession, path: str) -> DataFrame:
    """(verb, entry) of a document written by ``write_document``, read by lines."""
    return parse_document(spark.read.text(path))


def parse_log(lines: DataFrame, column: str = "value") -> DataFrame:
    """Audit records of JSON lines; missing texts are empty, missing flags an empty list."""
    record = lines.where(strip(F.col(column)) != "").select(
        *[c for c in lines.columns if c != column], F.from_json(column, LOG_TYPE).alias("r")
    )
    rows = record.select(*[c for c in record.columns if c != "r"], "r.*")
    none = F.array().cast("array<struct<person:string,note:string>>")
    flags = F.transform(
        F.coalesce("flags", none), lambda f: F.struct(f["person"].alias("person"), F.coalesce(f["note"], F.lit("")).alias("note"))
    )
    texts = {c: F.coalesce(c, F.lit("")) for c in ("auditor", "ts", "note")}
    return rows.withColumns({**texts, "flags": flags})


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """Audit records with ``seq``, the line order."""
    lines = read_lines(spark, path).withColumnRenamed("line_no", "seq")
    return parse_log(lines)
