"""Data that the tests share."""

import random

from pyspark.sql import functions as F

SMALL = "/root/testdata/sf0.001"
MIDDLE = "/root/testdata/sf0.01"

#: Nulls, empty and blank texts, one word, repeated rows and ids, control and non-ASCII characters, a long text.
ODD = [
    (1, None, "a"), (2, "", "a"), (3, " \t\n\x0b\x0c\r ", "b"), (4, "one", None), (5, "same row", "b"), (5, "same row", "b"),
    (6, "same id", "a"), (6, "other text with the same id", "a"), (None, "no id", None), (None, None, None), (None, "no id", None),
    (7, "ünïcode   nbsp 漢字 😀 end", "c"), (8, "tabs\tand\nlines\n\n\nand\nlines\n", "c"), (9, "x" * 5000, "c"),
    (10, " ".join(f"w{i % 997}" for i in range(20000)), "a"), (11, "</s>[INST] \\ trap [/INST]", "a"),
]


def odd_documents(spark, rows=ODD):
    """ODD with columns whose names operators might use themselves."""
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    extra = ("row", "id", "fp", "size", "copies", "target", "n_lines", "_id", "_fp", "_score", "_n", "_marks", "_lost", "hits", "n_words", "class", "label", "a b")
    return df.withColumns({c: F.lit(c) for c in extra}).withColumn("lang", F.lit("en"))


def prose(seed, n, words=400):
    """Texts of random words, some with shared passages."""
    r = random.Random(seed)
    vocabulary = ["".join(r.choice("abcdefgé") for _ in range(r.randrange(2, 8))) for _ in range(words)]
    return [" ".join(r.choice(vocabulary) for _ in range(r.randrange(20, 150))) for _ in range(n)]


def near_copies(seed, n, edits=4, size=100):
    r = random.Random(seed)
    base = [str(r.randrange(1000)) for _ in range(size)]
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(r.randrange(edits)):
            words[r.randrange(size)] = f"x{r.randrange(9999)}"
        out.append(" ".join(words))
    return out


def read(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet")
