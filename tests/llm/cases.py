"""Small documents with edge cases, and plain twins of the rules."""

import random

from pyspark.sql import functions as F
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


def prose(rng, n, vocabulary=400):
    return " ".join(rng.choice("the of and on in to".split()) if rng.random() < 0.3 else f"w{rng.randrange(vocabulary)}é"[: rng.randrange(2, 7)] for _ in range(n))


def frame(spark, texts, first=0):
    rows = [(first + i, t, "en", None if i % 3 else "hot", None if t is None else len(t)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def edge_texts(seed=1):
    """Nulls, empty, white space, one very long, copies, near copies, shared passages."""
    rng = random.Random(seed)
    base = [prose(rng, rng.randrange(5, 200)) for _ in range(25)]
    passage = prose(rng, 60)
    out = [None, "", " \t\n", "a", "A", "é", "x" * 300, "word " * 3000, passage]
    out += base + base[:5] + [b + " tail" for b in base[5:10]] + [b.replace(" ", "\n", 3) for b in base[10:14]]
    out += [prose(rng, 30) + " " + passage + " " + prose(rng, 30) for _ in range(12)]
    for b in base[14:20]:
        words = b.split(" ")
        for _ in range(6):
            copy = list(words)
            copy[rng.randrange(len(copy))] = "edit" + str(rng.randrange(100))
            out.append(" ".join(copy))
    return out


def clashing(df):
    """The same rows with extra columns whose names clash with those of results."""
    names = ("id", "row", "kept", "keep_id", "score", "piece", "hash", "bucket", "label", "count", "text_sha256")
    return df.withColumns({n: F.lit("x") for n in names})
