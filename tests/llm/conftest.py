import random

import pytest

from ridgeline.llm.common import ship


@pytest.fixture(scope="session", autouse=True)
def package_on_workers(spark):
    ship(spark)


@pytest.fixture(scope="session")
def corpus():
    """Rows (doc_id, text) with copies, near copies, shared passages, empty, null and odd texts, in no order."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 6)))
    passage = [word() for _ in range(40)]
    texts = [" ".join(word() for _ in range(rng.randint(0, 120))) for _ in range(120)]
    for _ in range(60):
        words = rng.choice(texts).split()
        for _ in range(rng.randint(0, 3)):
            if words:
                words[rng.randrange(len(words))] = word()
        texts.append(rng.choice([" ", "  ", "\n", " \t"]).join(words))
    for _ in range(40):
        a = rng.randrange(25)
        words = [word() for _ in range(rng.randint(0, 30))] + passage[a : a + rng.randint(5, 15)] + [word() for _ in range(rng.randint(0, 30))]
        texts.append(" ".join(words))
    texts += [None, None, "", " ", "\n\t", "one", "ONE", "one two three", "a b c d", "x " * 3000, "é" * 300, "ab" * 200]
    rng.shuffle(texts)
    return [(i * 3 + 1, t) for i, t in enumerate(texts)]


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table with extra columns whose names clash with those used inside."""

    def build(rows, partitions=3):
        data = [(i, t, "en", f"src{(i or 0) % 4}", None, 7, "k", 1.5) for i, t in rows]
        schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, row int, key string, node double"
        return spark.createDataFrame(data, schema).repartition(partitions)

    return build
