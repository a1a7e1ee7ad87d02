from __future__ import annotations

import random

import pytest

#: Column names that the operators use inside.
CLASHING = ["row", "digest", "run", "weight", "place", "score", "bits", "part", "start", "carried", "label", "shard", "n", "at"]


def prose(rng: random.Random, words: int, vocabulary: int = 400) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}" if rng.random() < 0.6 else f"x{rng.randrange(10**6)}" for _ in range(words))


@pytest.fixture(scope="session")
def documents(spark):
    """Texts with copies, near copies, shared passages, repeated lines, and every awkward case."""
    rng = random.Random(5)
    texts: list[str | None] = [prose(rng, rng.choice([3, 20, 60, 200])) for _ in range(60)]
    base = prose(rng, 150)
    words = base.split()
    for n in range(30):
        changed = list(words)
        for _ in range(n % 6):
            changed[rng.randrange(len(changed))] = f"y{rng.randrange(10**6)}"
        texts.append(" ".join(changed))
    passage = prose(rng, 55)
    texts += [f"{prose(rng, 30)} {passage}\n{prose(rng, 30)}" for _ in range(12)]
    texts += [texts[0]] * 5 + [f"  {texts[1]}".replace(" ", "\t\n")] * 3 + [texts[2].upper()] * 2
    texts += ["again and again " * 60, prose(rng, 6000), "word", "", "", "  \n ", None, None, "a b c", "A b  c", "é ß ñ 漢字 \U0001f600 x"]
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [(None, texts[0]), (None, texts[3]), (None, None), (7, texts[7]), (7, texts[7]), (8, "another text with number eight")]
    rng.shuffle(rows)
    extra = ", ".join(f"`{name}` string" for name in CLASHING)
    return spark.createDataFrame([(*r, *[None] * len(CLASHING)) for r in rows], f"doc_id long, text string, {extra}").repartition(3)


@pytest.fixture(scope="session")
def empty(documents):
    return documents.limit(0)
