"""Column helpers that the text operators share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space that divides words.
SPACE = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """Array of the runs of characters other than SPACE; null counts as empty."""
    t = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE))
    return F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, SPACE_RUN, -1))


def n_words(text: Column) -> Column:
    t = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE))
    return F.when(t == "", F.lit(0)).otherwise(F.size(F.split(t, SPACE_RUN, -1))).cast("long")


def count_chars(text: Column, chars: str) -> Column:
    """How many characters of the text are among chars."""
    return (F.length(text) - F.length(F.translate(text, chars, ""))).cast("long")


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once, even where body names it inside lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))
