import random

import pytest

from lexispark.llm.shared import ready

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_lines string, kept string, label string, rep long, s1 long"
BENCH = [(1, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda"), (2, "Short, phrase here"), (3, None), (4, ""), (2, "short phrase here"), (None, "no id at all")]


def words(seed: int, n: int, size: int = 400) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choices("abcdeéß", k=rng.randint(2, 7))) for _ in range(size)][:size] and rng.choices([f"w{rng.randint(0, size)}x" for _ in range(size)], k=n)


def near(text: str, seed: int, edits: int) -> str:
    rng, w = random.Random(seed), text.split(" ")
    for _ in range(edits):
        w[rng.randrange(len(w))] = f"new{rng.randint(0, 10**6)}"
    return " ".join(w)


@pytest.fixture(scope="session")
def texts() -> list[tuple]:
    """(doc_id, text) with nulls, empties, ties, copies, near copies, shared lines and long texts."""
    base, shared = " ".join(words(1, 260)), "This very line stands in many of the documents."
    rows = [(i, " ".join(words(100 + i, 30 + 7 * i))) for i in range(12)]
    rows += [(20, base), (21, base), (22, base)] + [(30 + i, near(base, i, i % 9)) for i in range(24)]
    rows += [(60 + i, f"head {i} of its own text\n  {shared.upper() if i % 2 else shared}\t\nfoot {i}\n\nfoot {i}") for i in range(6)]
    rows += [(70, None), (71, ""), (72, "   \n\t "), (73, "one"), (74, "one two three"), (75, "ONE two three"), (76, "!!! ###"), (77, "日本語テキスト 🙂 été")]
    rows += [(80, "pre Alpha, beta gamma DELTA epsilon zeta eta theta iota kappa post"), (81, "x short phrase. here y short PHRASE here"), (82, "ab " * 9000), (83, "q" * 3000), (84, base + " " + base)]
    rows += [(5, " ".join(words(105, 65))), (90, "<|endoftext|> a special<|endoftext|>\x00 string")]
    return rows


def frame(spark, rows):
    ready(spark)
    return spark.createDataFrame([(d, t, "en", "s", 0, "a", "b", "c", 7, 8) for d, t in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def docs(spark, texts):
    return frame(spark, texts)


@pytest.fixture(scope="session")
def empty(spark):
    ready(spark)
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def bench(spark):
    return spark.createDataFrame(BENCH, "item_id long, text string")
