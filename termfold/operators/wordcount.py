"""Word count over text lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def word_count(lines: DataFrame, column: str = "value") -> DataFrame:
    """``(word, count)`` of white-space separated words, case-sensitive."""
    return (
        lines.select(F.explode(F.split(column, r"\s+")).alias("word"))
        .filter(F.col("word") != "")
        .groupBy("word")
        .agg(F.count("*").alias("count"))
    )


def write_counts(counted: DataFrame, path: str) -> None:
    """Text files of ``word<TAB>count`` lines."""
    line = F.concat_ws("\t", "word", F.col("count").cast("string"))
    counted.select(line.alias("value")).write.mode("overwrite").text(path)
