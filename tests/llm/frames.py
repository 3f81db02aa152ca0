"""Edge rows shared by the operator tests: nulls, empty and long texts, ties,
repeated rows, and extra columns whose names clash with results."""

from pyspark.sql import functions as F

PASSAGE = "the quick brown fox jumps over the lazy dog while seven wizards quietly mix potions for the village fair "
TEXTS = [
    (1, PASSAGE * 3 + "tail one"),
    (2, PASSAGE * 3 + "tail one"),
    (3, PASSAGE * 3 + "tail two"),
    (4, None),
    (5, ""),
    (6, "word"),
    (7, "word"),
    (8, "ñandú é ü — ¿qué? 中文字 " * 40),
    (9, "x" * 30000),
    (10, " \t\n  "),
    (11, PASSAGE.upper()),
    (12, "abc " * 5000 + PASSAGE),
]


def edge_documents(spark):
    """TEXTS with repeated rows and clashing extra columns."""
    rows = [(i, t, "en", "s", len(t or ""), "x") for i, t in TEXTS]
    rows += [rows[0], rows[3]]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, component_id string") \
        .withColumn("kept", F.lit(1)).withColumn("shard", F.lit("s")).withColumn("n_bytes", F.lit(2.5))


def empty_documents(spark):
    return edge_documents(spark).limit(0)
