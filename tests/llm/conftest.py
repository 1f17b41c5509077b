from __future__ import annotations

import random

import pytest

WORDS = ["alpha", "Beta", "gamma", "delta", "épsilon", "zeta", "eta", "theta", "iota", "kappa", "été", "λ", "mu,", "nu.", "xi"]


def prose(rng: random.Random, n: int, words=WORDS) -> str:
    return rng.choice(["", " "]) + "".join(rng.choice(words) + rng.choice([" ", " ", "  ", "\n", "\t"]) for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """Null and empty texts, white space, one word, a very long text, repeated rows and ids, a null id, shared passages."""
    rng = random.Random(11)
    passage = " ".join(f"w{rng.randint(0, 10**6)}" for _ in range(70))
    line = " ".join(f"l{k}" for k in range(20))
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "One"), (6, prose(rng, 30_000, [f"v{k}" for k in range(5000)]))]
    rows += [(k, prose(rng, rng.randint(1, 120))) for k in range(10, 40)]
    rows += [(k, f"{prose(rng, 15)}{passage} {prose(rng, 15)}") for k in range(40, 46)]
    rows += [(k, f"{prose(rng, 9)}{line}\n{prose(rng, 40)}") for k in range(46, 52)]
    rows += [(60, "again " * 90), (61, "again " * 89 + "again"), (62, passage), (62, passage), (63, passage.replace(" ", "  ")), (62, "another text")]
    rows += [(None, "without id"), (None, passage), (70, "漢字かな交じり文。" * 40), (71, "x" * 5000), (72, "a\x00b \U0001F600")]
    return rows


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    """The odd rows, with extra columns whose names the operators use themselves."""
    rows = [(i, t, "en" if k % 3 else None, k, "z", k % 2 == 0) for k, (i, t) in enumerate(odd_rows)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, row int, found string, kept boolean")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")
