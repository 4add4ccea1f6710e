"""Tables with every odd case, shared by the tests here."""

LONG = "word " * 30_000 + "end"

#: doc_id, text, and columns whose names the operators use for results or inside.
ODD = [
    (1, "The quick brown fox jumps over the lazy dog today.", "a", 5, "x"),
    (2, "The quick  brown\tfox jumps over the\nlazy dog today.", "a", None, None),
    (2, "The quick  brown\tfox jumps over the\nlazy dog today.", "a", None, None),
    (3, None, None, 7, "y"),
    (4, "", "b", 7, "y"),
    (5, "   \n\t ", "b", 1, "z"),
    (6, LONG, "c", 1, "z"),
    (7, "one two", None, 2, ""),
    (None, "a row without a number but with words in it", "a", 2, "n"),
    (8, "ünï çödé <|endoftext|> 中文 😀 </s>", "é", 3, "s"),
    (9, "x" * 50_000, "c", 3, "s"),
]
SCHEMA = "doc_id long, text string, source string, size long, shard string"
OTHERS = ["score double", "kept boolean", "position double", "slot int", "ids string", "class int", "n int"]


def odd(spark):
    """The rows above, with more columns of clashing names."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(ODD, SCHEMA)
    for spec in OTHERS:
        name, kind = spec.split()
        df = df.withColumn(name, F.lit(None).cast(kind))
    return df


def empty(spark):
    return odd(spark).where("false")
