"""Column expressions the text operators share."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# The six characters that end a word.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"


def whole(text: Column) -> Column:
    """The text, or an empty one for null."""
    return F.coalesce(text.cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    """Words of a text that is not null; an empty array for none."""
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_RUN))


def crc_mod(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo a number; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % divisor


def table(spark: SparkSession, sf_dir: str, name: str):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
