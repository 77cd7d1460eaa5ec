import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

WORDS = ("alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omikron pi rho sigma tau "
         "upsilon phi chi psi omega").split()


def prose(seed, n):
    """``n`` words, the same for the same seed."""
    import random

    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + str(rng.randrange(50)) for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """Rows that every operator on documents must take: nulls, empty and long texts, repeats, ties."""
    long = prose("long", 6000)
    a = prose("a", 80)
    return [(1, a), (2, a), (2, a), (3, None), (4, ""), (None, prose("b", 40)), (None, None), (5, long), (6, long + " end"),
            (7, "  \n\t "), (8, "one two"), (9, "x" * 20000), (10, "über 日本 \U0001f600 \x00 é ▁ �"), (None, a)]


@pytest.fixture
def odd(spark, odd_rows):
    """The odd rows, with extra columns whose names operators also use inside."""
    rows = [(i, t, k % 3, "n", float(k), [k], "s") for k, (i, t) in enumerate(odd_rows)]
    return spark.createDataFrame(rows, "doc_id long, text string, n int, node string, score double, bands array<int>, source string")


@pytest.fixture
def empty(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def tables(spark, sf):
    return lambda name: spark.read.parquet(f"{sf}/{name}.parquet")
