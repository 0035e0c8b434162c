from pyspark.sql import types as T

DOCUMENTS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


def docs(spark, rows):
    """Documents of (doc_id, text) pairs, or longer tuples."""
    full = [(*r, *("en", "s", len(r[1] or ""))[len(r) - 2 :]) for r in rows]
    return spark.createDataFrame(full, DOCUMENTS)


ODD = [(1, None), (2, ""), (3, "One. two, THREE dog dog's don't"), (3, "One. two, THREE dog dog's don't"), (None, "no id"), (5, " \t\n\x0b\x0c "), (6, "é́ İ Σας <|endoftext|>x a.. b!, ½ ٣"), (7, "word " * 5000), (8, "x" * 20000), (9, "tie"), (9, "tie too")]
