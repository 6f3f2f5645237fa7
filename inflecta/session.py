"""Session settings, the one way this library cuts lineage, and small files beside its tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def get_session(master: str | None = None, app: str = "inflecta", **conf: str) -> SparkSession:
    """A session with the settings the jobs are tuned for; ``conf`` adds or overrides settings."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Pages are large strings: bound Arrow batches by rows as well as by bytes.
        "spark.sql.execution.arrow.maxRecordsPerBatch": "512",
        "spark.sql.execution.arrow.maxBytesPerBatch": str(64 << 20),
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_folder(spark: SparkSession) -> str:
    """The folder all executors share, named by ``spark.checkpoint.dir``.

    Only a local session, whose executors are the driver, may leave it unset: then a folder beside the warehouse.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "-checkpoints"


def durable(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back from there.

    With ``spark.cleaner.referenceTracking.cleanCheckpoints`` (set by ``get_session``) Spark removes it when the
    DataFrame is no longer referenced.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(checkpoint_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def _place(spark: SparkSession, path: str):
    """``path`` and its file system, as Spark's readers and writers see them."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def remove(spark: SparkSession, path: str) -> None:
    """Remove a file or folder; one that is not there is no error."""
    place, files = _place(spark, path)
    files.delete(place, True)


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """Put a small text in place of a file at once: readers see the old text or the new one."""
    fresh, files = _place(spark, f"{path}.{uuid.uuid4().hex}")
    out = files.create(fresh)
    out.write(bytearray(text.encode()))
    out.close()
    jvm = spark._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fresh.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    context.rename(files.makeQualified(fresh), files.makeQualified(jvm.org.apache.hadoop.fs.Path(path)), how)


def get_text(spark: SparkSession, path: str) -> str:
    """The text of a small file, empty if there is none."""
    place, files = _place(spark, path)
    if not files.exists(place):
        return ""
    stream = files.open(place)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()
