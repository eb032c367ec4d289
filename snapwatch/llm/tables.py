"""Reading the given tables, words as every operator takes them, and Arrow batches of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapwatch.session import work_dir

# What separates words, as a pattern and as single characters.
SPACE = r"[\x20\x09-\x0D]"
SPACES = SPACE + "+"
SPACE_CHARS = "\x20\x09\x0a\x0b\x0c\x0d"

# Texts of about so many characters are worked on at a time; a longer text is worked on alone.
SLICE_CHARS = 2_000_000


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def text_or_empty(text: str | Column) -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def words_of(text: Column) -> Column:
    """The words of a text that is not NULL, in order."""
    return F.array_remove(F.split(text, SPACES), "")


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", most: int = SLICE_CHARS) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, so that what is built from the texts stays small."""
    for batch in batches:
        lengths = pc.fill_null(pc.utf8_length(batch.column(text)), 0).to_pylist()
        start, held = 0, 0
        for row, length in enumerate(lengths):
            if held and held + length > most:
                yield batch.slice(start, row - start)
                start, held = row, 0
            held += length
        if start < batch.num_rows:
            yield batch.slice(start)


def cut(df: DataFrame) -> DataFrame:
    """The same rows read back from the shared checkpoint folder, so that a lost executor costs no recomputation.

    The folder is the one in ``spark.checkpoint.dir``; only a local master without it gets one of its own.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if not spark.conf.get("spark.checkpoint.dir", None) and context.getCheckpointDir() is None:
        context.setCheckpointDir(work_dir(spark, "checkpoints"))
    return df.checkpoint()


class Tables:
    """Tables of one run in the shared folder, so that a lost executor costs no more than one step."""

    def __init__(self, spark: SparkSession, purpose: str):
        self.spark, self.folder, self.count = spark, work_dir(spark, purpose), 0

    def keep(self, df: DataFrame) -> DataFrame:
        """The rows as they were written, once for all that reads them."""
        path = f"{self.folder}/{self.count}"
        self.count += 1
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)
