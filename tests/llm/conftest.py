import random

import pytest
from llm_helpers import COLUMNS, documents
from pyspark.sql import functions as F

@pytest.fixture(scope="session")
def words():
    rng = random.Random(5)
    return ["".join(rng.choice("abcdefghijklmnoprstuvéöñ") for _ in range(rng.randint(2, 9))) for _ in range(900)]


@pytest.fixture(scope="session")
def edge_texts(words):
    """Null, empty, blank, white space of all kinds, repeats, ties, one very long text."""
    rng = random.Random(6)
    some = lambda n: " ".join(rng.choice(words) for _ in range(n))
    base = some(200)
    return [None, "", " ", "\n\n", "a", "a b", "a b a b a b a b", "\t tab\x0bv\x0cf\r\nend ", "  two  spaces ", "x y z",
            "emoji 😀 ünïcode   sep", "\x1c odd \x1f", base, base, base.upper(), base + " tail", some(30) + "\n" + base,
            "line one\nline two\nline three\n" * 3, some(20000), "q" * 5000, "# $ % & | < > *", some(60) + "\n\n" + some(60)]


@pytest.fixture(scope="session")
def edge_docs(spark, edge_texts):
    """Edge texts under increasing ids, with null columns and a column named like an internal one."""
    df = documents(spark, edge_texts)
    return df.withColumns({"id": F.lit("clash"), "h": F.lit(None).cast("string"), "size": F.lit(-1),
                           "key": F.lit("k"), "block": F.lit(0)})


@pytest.fixture(scope="session")
def empty_docs(spark):
    return spark.createDataFrame([], COLUMNS)


@pytest.fixture(scope="session")
def small(spark):
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def small_docs(spark, small):
    return spark.read.parquet(f"{small}/documents.parquet")
