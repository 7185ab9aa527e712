import random

import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # names that operators use themselves
        *[T.StructField(c, T.StringType()) for c in "fp score shard ids words at w key fraction text_key".split()],
    ]
)
WORDS = {
    "en": "the of and reader mountain without river because house thinking window early".split(),
    "de": "der und nicht schön über Straße zwischen heißt Wälder Öfen fröhlich ging".split(),
}


def prose(rng, lang="en", n=80):
    return " ".join(rng.choice(WORDS[lang]) + rng.choice(["", "", "", ",", ".", ".\n"]) for _ in range(n))


def rows():
    rng = random.Random(5)
    out = []
    for i in range(60):
        lang = "de" if i % 3 == 0 else "en"
        text = prose(rng, lang, 30 + i)
        if i % 7 == 0:
            text += " stupid idiot trash"
        out.append((i, text, lang, f"s{i % 4}" if i % 9 else None, len(text)))
    out += [(100, out[10][1], "en", "s0", None), (101, out[10][1] + " more", "en", "s0", 3)]  # copy, near copy
    out += [(102, None, None, None, None), (103, "", "en", "s1", 0), (104, " \n\t ", "en", "s1", 4), (105, "12 + 3!", "en", "s1", 7)]
    out += [(None, "a text without an id", "en", "s2", 20), (None, None, None, None, None)]
    out += [(106, "twice", "en", "s3", 5), (106, "twice", "en", "s3", 5), (106, "other text", "en", "s3", 10)]
    out += [(107, "x" * 50_000 + " tail", "en", "s3", 50_005), (108, prose(rng, "en", 20_000), "en", "s3", 1)]
    out += [(109, "Ünïcode ▁   é中文 😀 \x00 end", "en", "s3", 1), (-5, "negative id", "de", "s3", 11)]
    return out


@pytest.fixture(scope="session")
def doc_rows():
    return rows()


@pytest.fixture(scope="session")
def docs(spark, doc_rows):
    return spark.createDataFrame([(*r, *["clash"] * 10) for r in doc_rows], SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark, doc_rows):
    marks = [(r[0], int("idiot" not in (r[1] or "")), int("idiot" in (r[1] or ""))) for r in doc_rows[:60]]
    marks += [(3, None, None), (None, 1, 1), (999, 0, 1)]
    return spark.createDataFrame(marks, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def benchmark(spark, doc_rows):
    own = doc_rows[20][1].split()
    items = [(1, " ".join(own[5:25])), (2, "mountain, WINDOW early"), (3, None), (4, "..."), (5, " ".join(own[5:25]))]
    return spark.createDataFrame([(*i, "clash") for i in items], "item_id long, text string, words string")
