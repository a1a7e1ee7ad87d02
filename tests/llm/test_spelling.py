"""Spelling variants against brute force."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattline.llm.spelling import Reduced, spelling_groups


def counts_by_hand(rows):
    counts = Counter()
    for number, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if number is None else number}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return counts


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    first = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
    return a[first + (len(a) >= len(b)) :] == b[first + (len(b) >= len(a)) :]


def groups_by_hand(rows):
    n = {w: c for w, c in counts_by_hand(rows).items() if len(w) >= 5 and c >= 3}
    form, near = {}, {}
    for word in n:
        near[word] = [v for v in n if one_edit(word, v)]
        best = min(near[word], key=lambda v: (-n[v], v), default=None)
        form[word] = best if best is not None and n[best] >= 2 * n[word] else None
    out = []
    for word in n:
        root = word
        while form[root] is not None:
            root = form[root]
        out.append((word, form[word], root, n[word], len(near[word]), n[form[word]] if form[word] else None))
    return sorted(out)


def texts():
    rng = random.Random(8)
    bases = ["maison", "été́s", "straße", "letter", "banana", "aaaaaa", "ÀÉÎÕÜß", "colour", "abcde", "×÷×÷×", "q" * 3000]
    words = []
    for base in bases:
        words += [base] * 60
        for _ in range(12):
            w = list(base)
            at = rng.randrange(len(w))
            kind = rng.randrange(3)
            if kind == 0:
                w[at] = rng.choice("abcxyzéÉ")
            elif kind == 1:
                del w[at]
            else:
                w.insert(at, rng.choice("abcxyzéÉ"))
            words += ["".join(w)] * rng.randrange(2, 25)
    words += ["wooden"] * 90 + ["woodem"] * 30 + ["voodem"] * 9 + ["voodym"] * 3
    words += [w.upper() for w in words[::3]]
    rng.shuffle(words)
    rows = [(i, " ".join(words[i::40])) for i in range(40)]
    return [*rows, (40, None), (41, ""), (42, "... 123 \U0001f600"), (None, "letter " * 5), (3, rows[3][1]), (3, rows[3][1]), (50, "z" * 200_000)]


@pytest.mark.parametrize("symbols", [1, 8])
def test_groups(spark, symbols):
    rows = texts()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    df = df.withColumn("word", F.lit("x")).withColumn("n", F.lit("y")).withColumn("key", F.lit(None)).withColumn("root", F.lit(1))
    found = spelling_groups(df, symbols=symbols)
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    by_hand = groups_by_hand(rows)
    assert sum(r[1] is not None for r in by_hand) > 50
    assert any(r[2] != r[1] for r in by_hand if r[1])
    assert sorted(tuple(r) for r in found.collect()) == by_hand


def test_no_words(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert spelling_groups(empty).count() == 0
    assert spelling_groups(spark.createDataFrame([(1, "a bc"), (2, None)], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("word", ["a", "abba", "aaaa", "abcdefgh", "zyyz" * 5])
def test_neighbourhoods_are_whole_and_without_repeats(word):
    reduced = Reduced(3)
    symbols = reduced.of([word])
    strings = {tuple(symbols[0].tolist())}
    for s in list(strings):
        for i in range(len(s) + 1):
            strings |= {s[:i] + (c,) + s[i:] for c in (1, 2, 3)}
            if i < len(s):
                strings |= {s[:i] + s[i + 1 :]} | {s[:i] + (c,) + s[i + 1 :] for c in (1, 2, 3)}
    made = np.concatenate([keys for _, keys in reduced.neighbours(symbols)])
    wanted = {int(reduced.keys(np.array([s], np.uint64).reshape(1, -1))[0]) for s in strings}
    assert len(made) == len(strings) and set(made.tolist()) == wanted
