import random

import pytest

#: doc_id, text, lang, source and clashing extra columns
EXTRA = "doc_id long, text string, lang string, source string, n_chars long, id long, no string, row int, key string, spans int, start int"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon é ü".split()


def prose(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + str(rng.randint(0, 400)) for _ in range(n))


def corpus(seed: int = 1) -> list[tuple]:
    """Documents with copies, near copies, shared passages, ties, empty, null
    and very long texts; ids out of order."""
    rng = random.Random(seed)
    base = [prose(rng, rng.randint(60, 200)) for _ in range(25)]
    passage = prose(rng, 55)
    out = list(base) + [base[0]] * 7 + [base[1]] * 2
    for k in (2, 3, 3, 4):
        words = base[k].split(" ")
        words[rng.randrange(len(words))] = "changed"
        out.append(" ".join(words))
    out += [f"{prose(rng, 30)}\n{passage}\n{prose(rng, 30)}" for _ in range(12)]
    out += [passage, passage + " more", "", "   \n\t ", None, "one", "one two", "A b A b " * 30, prose(rng, 20000), "x" * 50000,
            "** ## $$ " * 40, "same line here\n" * 20]
    rng.shuffle(out)
    ids = rng.sample(range(10, 900), len(out))
    return [(i, t, rng.choice(["en", "de", None]), rng.choice(["s0", "s0", "s1", None])) for i, t in zip(ids, out)]


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows):
    full = [(i, t, a, b, len(t or ""), 5, "x", 3, "k", 1, 2) for i, t, a, b in rows]
    return spark.createDataFrame(full, EXTRA).repartition(5)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], EXTRA)
