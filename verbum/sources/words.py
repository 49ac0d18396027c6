"""Stop-word lists (one word per line)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, functions as F

BUNDLED_STOP_WORDS = os.path.join(os.path.dirname(__file__), "data", "stop_words.txt")


def stop_words(spark: SparkSession, path: str = BUNDLED_STOP_WORDS) -> DataFrame:
    """Read a stop-word file into ``(word)``; blank lines are skipped."""
    if path == BUNDLED_STOP_WORDS:          # a file beside this package, which only the driver has
        return spark.createDataFrame([(w,) for w in stop_words_local(path)], "word string")
    return (spark.read.text(path).select(F.trim("value").alias("word"))
            .filter(F.length("word") > 0).distinct())


def stop_words_local(path: str = BUNDLED_STOP_WORDS) -> list[str]:
    """The same list as plain strings (for building oracle SQL)."""
    with open(path, encoding="utf-8") as fh:
        return sorted({w.strip() for w in fh if w.strip()})
