"""What the operators share: written intermediate tables, words and null handling."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlens.sources.sinks import checkpoint_folder

#: The characters that separate words, and words as what lies between.
SPACES = (" ", "\t", "\n", "\x0b", "\f", "\r")
SPACE_PATTERN = "[\\x20\\x09-\\x0D]"
WORD_PATTERN = "[^\\x20\\x09-\\x0D]+"
#: So many rows of ids (32 MB) are broadcast at most.
BROADCAST_ROWS = 2_000_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def materialise(df: DataFrame, codec: str = "zstd") -> DataFrame:
    """Write ``df`` as Parquet to the shared checkpoint folder and read it back.

    The table replaces the lineage, survives lost executors, and keeps column pruning.
    Its folder is deleted when the session ends.
    """
    spark = df.sparkSession
    path = f"{checkpoint_folder(spark)}/table-{uuid.uuid4().hex}"
    df.write.option("compression", codec).parquet(path)
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    return spark.read.schema(df.schema).parquet(path)


def discard(stored: DataFrame) -> None:
    """Delete the folder of a table of ``materialise`` that nothing reads any more."""
    jvm, conf = stored.sparkSession._jvm, stored.sparkSession._jsc.hadoopConfiguration()
    for folder in {file.rsplit("/", 1)[0] for file in stored.inputFiles()}:
        place = jvm.org.apache.hadoop.fs.Path(folder)
        place.getFileSystem(conf).delete(place, True)


def broadcast_if_small(ids: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark a stored table of a few numbers per row for broadcast if it has few rows.

    A larger one is left to a shuffle join.
    """
    return F.broadcast(ids) if ids.count() <= rows else ids


def ship_package(spark: SparkSession) -> None:
    """Give this package's code to the executors, once per application."""
    context = spark.sparkContext
    if getattr(context, "_basketlens_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="basketlens-code-")) / "basketlens_code.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._basketlens_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(text: str | Column) -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def without_spaces(text: Column) -> Column:
    """Delete the space characters; one linear pass per character."""
    for space in SPACES:
        text = F.replace(text, F.lit(space), F.lit(""))
    return text


def word_count(text: Column) -> Column:
    return F.regexp_count(text_or_empty(text), F.lit(WORD_PATTERN)).cast("long")


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; null for a null id."""
    return F.crc32(doc_id.cast("string")) % divisor
