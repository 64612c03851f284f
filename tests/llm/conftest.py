import pytest

from mercato.llm.shared import ship

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def llm(spark):
    return ship(spark)


@pytest.fixture
def documents(llm):
    """Documents from (id, text) or (id, text, source); with columns whose names could clash."""

    def make(*rows, extra="size long, cls long, row long"):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", 0, 1, 2, 3) for r in rows]
        return llm.createDataFrame(full, f"{DOCUMENTS}, {extra}").repartition(2)

    return make


WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu".split()


def prose(n, seed):
    import random

    draw = random.Random(seed)
    return " ".join(draw.choice(WORDS) + str(draw.randrange(400)) for _ in range(n))


# Null and empty texts, white space, repeated rows, a null id, a very long text.
def awkward():
    long_text = prose(20_000, 1)
    return [
        (1, None), (2, ""), (3, " \n\t "), (4, "one two"), (4, "one two"), (None, prose(90, 2)),
        (5, prose(90, 2)), (6, long_text), (7, long_text), (8, prose(300, 3)), (9, "x" * 5000),
        (10, "x" * 5000 + " y"), (11, "é ß 漢 \u2581 <s> <|endoftext|>  end "), (12, prose(300, 3) + " more"),
    ]
