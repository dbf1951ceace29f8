"""Small frames for the tests of the training-data operators."""

from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])

ODD_TEXTS = [None, "", " \t\n\x0b ", "one", "One two", "a\u00a0b\x1cc", "ÉCOLE Straße ΣΑΣ İ",
             "漢字 🙂 \U0001F468‍\U0001F469", "x" * 120_000, "word " * 25_000, "tab\there\r\nend ",
             "  two  blanks  ", "nul\0byte", "don't we'll <|endoftext|> it", "é́́ combining"]


def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS)


def odd_docs(spark):
    """Odd texts, one of them twice under one id, one under a null id."""
    rows = list(enumerate(ODD_TEXTS))
    return docs(spark, [*rows, (3, "one"), (None, "one"), (None, None)])
