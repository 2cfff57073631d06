import random

import pytest
from pyspark.sql import functions as F

#: Names that operators use inside; an input may have columns of these names.
CLASHING = ("id digest row rows key fp part place anchor body label labelled_id score kept words terms "
            "bucket features host salt length start starts sequence_id component_id").split()
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def words(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice("abcdeéß") for _ in range(rng.randint(2, 7))) for _ in range(n))


@pytest.fixture(scope="session")
def edge_rows():
    """NULLs in every column, empty, blank and long texts, ties, repeats and near copies."""
    rng = random.Random(5)
    passage = words(rng, 70)
    base = words(rng, 300)
    near = base.split()
    near[150] = "changed"
    rows = [(1, base, "en", "a", 1), (2, " ".join(near), "en", "a", None), (3, base, None, None, None),
            (4, None, "en", "a", 0), (5, "", "en", "a", 0), (6, " \n\t ", "en", "a", 4),
            (7, "one", "en", "b", 3), (8, "one two", "en", "b", 7), (None, words(rng, 60), "en", "b", 9),
            (None, None, None, None, None), (9, words(rng, 20_000), "de", "c", 5),
            (10, "x" * 70_000, "de", "c", 5), (11, ("again and again " * 400), "de", "c", 5),
            (12, words(rng, 40) + "\n" + passage + "\n" + words(rng, 30), "fr", "d", 1),
            (13, passage + " " + words(rng, 90), "fr", "d", 1), (14, "é" * 500 + passage, "fr", "d", 1),
            (15, words(rng, 80), "es", "e", 1), (15, words(rng, 80), "es", "e", 1),
            (16, "repeated row " + words(rng, 50), "es", "e", 1)]
    rows.append(rows[-1])
    rows += [(100 + k, words(rng, rng.randint(1, 120)), "en", f"s{k % 3}", 1) for k in range(30)]
    return rows


@pytest.fixture(scope="session")
def edge_docs(spark, edge_rows):
    docs = spark.createDataFrame(edge_rows, SCHEMA).repartition(3, "text")
    return docs.withColumns({c: F.lit("clash") for c in CLASHING}).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
