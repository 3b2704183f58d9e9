from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.functions import java_split


def words(df: DataFrame, text: str = "value") -> DataFrame:
    """One row per word. Words are split at single spaces, so neighbouring spaces enclose an
    empty word; spaces at the end of the text do not."""
    only_spaces = (F.rtrim(text) == "") & (F.col(text) != "")
    return df.where(~only_spaces).select(F.explode(java_split(text, " ")).alias("word"))


def word_count(df: DataFrame, text: str = "value") -> DataFrame:
    return words(df, text).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
