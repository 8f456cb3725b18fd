"""Small tables with the awkward cases every operator has to define."""
import random

from pyspark.sql import types as t

DOCS = t.StructType([
    t.StructField("doc_id", t.LongType()), t.StructField("text", t.StringType()),
    t.StructField("lang", t.StringType()), t.StructField("source", t.StringType()),
    t.StructField("n_chars", t.LongType()),
    # names that operators use inside
    t.StructField("key", t.StringType()), t.StructField("kept", t.StringType()),
    t.StructField("n", t.LongType()), t.StructField("cid", t.StringType()), t.StructField("_id", t.StringType()),
    t.StructField("_key", t.StringType()), t.StructField("id", t.StringType()), t.StructField("kh", t.StringType())])


def frame(spark, texts, ids=None):
    """A documents table with extra columns, from texts."""
    ids = list(range(len(texts))) if ids is None else ids
    rows = [(i, x, None if k % 5 == 0 else "en", None if k % 7 == 0 else f"src{k % 3}",
             None if x is None else len(x), "k", None, k, "c", "u", "v", "w", "x") for k, (i, x) in enumerate(zip(ids, texts, strict=True))]
    return spark.createDataFrame(rows, DOCS)


def prose(n, seed=1, vocabulary=3000):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" + ("." if rng.random() < 0.1 else "") for _ in range(n))


ODD = [None, "", " ", "\n\n", "one", "É é É", "a　b c", "x" * 3000, "tab\tand\x0bvt\x0cff\rcr",
       "emoji \U0001f600 end", "a. b! c?", "end."]
