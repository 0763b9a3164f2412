import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, _batch string, cut string, size int, key string"


def prose(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice(["th", "er", "an", "in", "ou", "le", "de", "é"]) for _ in range(rng.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="session")
def corpus():
    """Texts with copies, near copies, shared lines, nulls, empty, one-word and very long ones: [(doc_id, text, source)]."""
    rng = random.Random(4)
    base = [prose(rng, rng.randint(1, 160)) for _ in range(60)]
    shared = prose(rng, 70)
    texts = list(base)
    texts += [base[3]] * 5 + [base[5].replace("th", "er", 1), base[5] + " end", shared + "\n" + base[7], base[8] + "\n" + shared + "\n" + base[9], shared]
    for _ in range(50):
        words = base[10].split() + base[11].split()
        words[rng.randrange(len(words))] = "zz"
        texts.append(" ".join(words))
    texts += [None, "", " \n\t ", "one", "one two three", "abc" * 2000, "\n".join([base[1]] * 4), prose(rng, 30_000), "é" * 120, "日本語テキスト" * 20, "x\x00y " * 40]
    rng.shuffle(texts)
    return [(i, t, rng.choice(["a", "a", "a", "b", "c", None])) for i, t in enumerate(texts)]


@pytest.fixture(scope="session")
def docs(spark, corpus):
    """The corpus with columns whose names operators might use themselves."""
    rows = [(i, t, None if i % 7 == 0 else "en", s, None if t is None else len(t), "b", "c", 1, "k") for i, t, s in corpus]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def twice(spark):
    """Repeated rows and null keys."""
    text = prose(random.Random(9), 60)
    rows = [(1, text), (1, text), (2, text), (None, text), (None, None), (3, None), (3, "")]
    return spark.createDataFrame([(i, t, "en", None, None, "b", "c", 1, "k") for i, t in rows], DOCS)
