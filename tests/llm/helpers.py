"""Rows that every operator has to bear."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
LONG = " ".join(f"word{i % 977}" for i in range(60_000))


def documents(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """(doc_id, text, lang) rows, with columns whose names an operator might use."""
    return spark.createDataFrame(rows, "doc_id long, text string, lang string").select(
        "*", *(F.lit("x").alias(c) for c in (
            "id", "fp", "key", "score", "n_words", "line", "first", "row_key", "words", "row", "runs", "own", "learn", "__lang", "__runs",
            "__all", "__lines", "__deleted", "__text_key", "__row_key", "__id", "__t", "__score")))


def nasty(spark: SparkSession) -> DataFrame:
    prose = "the quick brown fox jumps over the lazy dog again and again until the sun goes down behind the hills"
    return documents(spark, [
        (1, None, "en"), (2, "", "en"), (3, " \t\n\x0b ", None), (4, prose, "en"), (5, prose, "en"), (5, prose, "en"),
        (6, prose.replace("lazy", "idle"), "en"), (None, prose, "en"), (None, None, None), (7, "...!? 123", "en"),
        (8, LONG, "en"), (9, "één À la carte \U0001f600 ﬁn", "fr"), (10, "\\### Assistant: </turn> <turn:> ok", None),
        (11, "\n".join([prose] * 3), "en"), (11, "other text under the same id", "en")])


def empty(spark: SparkSession) -> DataFrame:
    return documents(spark, [])
