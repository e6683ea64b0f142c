import random

import pytest

#: Extra columns with names that the operators use themselves.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key long, sig long, size long, copy long, node long, score double, media string, count long"


def make_docs(spark, rows):
    """rows: (doc_id, text, source)."""
    return spark.createDataFrame([(i, t, "en", s, None if t is None else len(t), 7, 7, 7, 7, 7, 0.5, "m", 1) for i, t, s in rows], SCHEMA)


def prose(rng, words):
    return " ".join("".join(rng.choices("abcdeéñ", k=rng.randint(1, 7))) for _ in range(words))


@pytest.fixture(scope="session")
def odd_rows():
    """Null and empty texts, null ids and sources, ties, repeated rows, near copies, shared passages, a very long text."""
    rng = random.Random(4)
    base, passage = prose(rng, 120), prose(rng, 140)
    near = base.split()
    near[60] = "changed"
    rows = [(1, base, "a"), (2, base, "b"), (2, base, "b"), (3, " ".join(near), "a"), (4, None, None), (5, "", "a"), (6, " \n\t ", None), (None, prose(rng, 30), "b"), (8, "one two three", "c"), (9, "ONE two Three", "c"), (10, "a" * 1500, "a")]
    rows += [(20 + k, f"{prose(rng, 90)} {passage} {prose(rng, 60)}", "b") for k in range(4)]
    rows += [(40 + k, prose(rng, 50), f"s{k % 5}") for k in range(25)]
    rows += [(90, prose(rng, 20_000), "a")]
    return rows


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    return make_docs(spark, odd_rows).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return make_docs(spark, [])
