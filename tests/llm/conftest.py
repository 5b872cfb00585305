import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def phrase(seed: int, words: int) -> str:
    pick = random.Random(seed)
    return " ".join("".join(pick.choice("abcdefgé") for _ in range(pick.randint(1, 6))) for _ in range(words))


def edge_rows() -> list[tuple]:
    """NULLs in every column, empty and blank texts, one very long text, repeated rows, ties of ids,
    near copies, shared passages, and short texts."""
    base, passage = phrase(1, 200), phrase(2, 60)
    words = base.split()
    near = " ".join([*words[:100], "changed", *words[101:]])
    texts = [
        base, base, near, near.upper(), " ".join(words[:150]), phrase(3, 50) + " " + passage, phrase(4, 90) + "\n" + passage + "\t" + phrase(5, 20),
        passage, None, "", " \n\t ", "one", "one two", "ONE  two", "a b a b a b a b a b a b a b a b a b a b a b a b a b a b",
        phrase(6, 30000), "é è " * 40, "x\x1cy\x85z " * 30, "#### $$$ | <b> & %\n" * 30, "LOUD!! " + "WORDS!! " * 60,
        phrase(7, 120), phrase(8, 120), phrase(9, 25),
    ]
    rows = [(i, t, "en", f"s{i % 4}", None if t is None else len(t)) for i, t in enumerate(texts)]
    rows += [rows[0], rows[0], (None, base, None, None, None), (None, phrase(10, 40), None, None, 1), (None, None, None, None, None)]
    rows += [(5, phrase(11, 80), "de", None, 3), (7, near, "fr", "", 4)]
    return rows


@pytest.fixture(scope="session")
def edges(spark):
    return spark.createDataFrame(edge_rows(), DOCS).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCS)
