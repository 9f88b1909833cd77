import hashlib
import random

import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


@pytest.fixture(scope="session")
def texts():
    """Random prose with copies, near copies, shared passages, repeats, empty, null and very long texts."""
    rng = random.Random(3)
    vocabulary = ["".join(rng.choice("abcdeéfgh") for _ in range(rng.randint(1, 7))) for _ in range(400)]
    prose = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    passage = prose(60)
    out = {i: prose(rng.randint(1, 120)) for i in range(60)}
    for i in range(60, 70):
        out[i] = out[rng.randrange(60)]
    for i in range(70, 90):
        words = out[rng.randrange(60)].split()
        words[rng.randrange(len(words))] = "changed"
        out[i] = " ".join(words)
    for i in range(90, 110):
        out[i] = prose(20) + "\n" + passage + " " + prose(rng.randint(0, 9))
    out |= {110: "", 111: None, 112: "one", 113: "a a " * 400, 114: "x" * 3000, 115: prose(30000), 116: "one", 117: "\t \n"}
    return out


@pytest.fixture(scope="session")
def docs(spark, texts):
    """With a clashing extra column."""
    rows = [(i, t, ("en", "de", None)[i % 3], f"src{i % 4}" if i % 7 else None, len(t or "")) for i, t in texts.items()]
    from pyspark.sql import functions as F
    return spark.createDataFrame(rows, DOCS).withColumn("score", F.lit("clash")).withColumn("bucket", F.lit(1)).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
