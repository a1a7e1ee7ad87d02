"""Exact copies, repeated runs and near copies against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattline.llm import jaccard_join
from wattline.llm.components import components
from wattline.llm.exact_dedup import exact_groups, without_copies
from wattline.llm.jaccard_join import SignatureTree, similar_groups, without_similar
from wattline.llm.substring_dedup import repeated_words


def collected(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def pairs(documents):
    return [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]


def order(number):
    return (number is None, number or 0)


def exact_by_hand(rows):
    groups = defaultdict(list)
    for number, text in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", text or "")].append(number)
    out = []
    for text, numbers in groups.items():
        first = min(numbers, key=order)
        kept = [False] * len(numbers)
        kept[numbers.index(first)] = True
        digest = hashlib.sha256(text.encode()).hexdigest()
        out += [(n, first, len(numbers), k, digest) for n, k in zip(numbers, kept, strict=True)]
    return sorted(out, key=str)


@pytest.mark.parametrize("slots", [1 << 10, 1 << 26])
def test_exact_copies_with_a_crowded_and_a_roomy_filter(documents, slots):
    found = exact_groups(documents, slots=slots)
    assert collected(found, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == exact_by_hand(pairs(documents))


def test_exact_copies_run_no_python(documents):
    plan = exact_groups(documents)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_rows_without_copies_keep_their_columns(documents, empty):
    kept = without_copies(documents)
    assert kept.columns == documents.columns
    assert kept.count() == len({re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in pairs(documents)})
    assert exact_groups(empty).count() == without_copies(empty).count() == 0


def cut_by_hand(rows, length):
    split = [(n, (t or "").encode().split()) for n, t in rows]
    seen = Counter(tuple(w[p : p + length]) for _, w in split for p in range(len(w) - length + 1))
    out = []
    for number, words in split:
        covered = bytearray(len(words))
        for p in range(len(words) - length + 1):
            if seen[tuple(words[p : p + length])] > 1:
                covered[p : p + length] = b"\1" * length
        kept = [w for w, c in zip(words, covered, strict=True) if not c]
        out.append((number, len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("length", [1, 2, 7, 35])
def test_repeated_words(documents, length):
    found = repeated_words(documents, length=length)
    assert collected(found, "doc_id", "n_words", "n_removed", "kept_sha256") == cut_by_hand(pairs(documents), length)


def test_removed_stretches_and_kept_text_agree(documents, empty):
    for r in repeated_words(documents).where("n_removed > 0").collect():
        assert r.n_removed == sum(r.removed[1::2]) - sum(r.removed[::2])
        assert r.kept_sha256 == hashlib.sha256(r.kept.encode()).hexdigest()
    assert repeated_words(empty).count() == 0


def shingles(text, size):
    words = (text or "").encode().lower().split()
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[p : p + size]) for p in range(len(words) - size + 1)}


def groups_by_hand(rows, size, similarity):
    sets = [shingles(t, size) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= similarity * (len(a) + len(sets[j]) - both):
                parent[find(i)] = find(j)
    smallest = {}
    for i, (number, _) in enumerate(rows):
        smallest[find(i)] = min(smallest.get(find(i), number), number, key=order)
    return sorted(((n, len(sets[i]), smallest[find(i)]) for i, (n, _) in enumerate(rows)), key=str)


@pytest.mark.parametrize(("size", "similarity"), [(5, 75), (5, 50), (2, 90), (1, 30)])
def test_near_copies(documents, size, similarity):
    found = similar_groups(documents, shingle=size, similarity=similarity)
    assert collected(found, "doc_id", "n_shingles", "component_id") == groups_by_hand(pairs(documents), size, similarity)


def test_a_text_of_one_shingle_meets_longer_ones(spark):
    rows = [(1, "a a a a a"), (2, "a a a a a a a a"), (3, "spam " * 100), (4, "Spam " * 5), (5, "a a a a"), (6, "a b c d e"), (7, "a b c d e f")]
    found = similar_groups(spark.createDataFrame(rows, "doc_id long, text string"))
    assert collected(found, "doc_id", "n_shingles", "component_id") == groups_by_hand(rows, 5, 75)


@pytest.mark.parametrize(("common", "node", "bits"), [(2, 2, 64), (1000, 3, 1024)])
def test_near_copies_with_small_nodes_and_crowded_bitmaps(documents, monkeypatch, common, node, bits):
    """The same classes when most links must come out of the dual traversal."""
    monkeypatch.setattr(jaccard_join, "COMMON", common)
    monkeypatch.setattr(jaccard_join, "NODE", node)
    monkeypatch.setattr(jaccard_join, "BITS", bits)
    monkeypatch.setattr(jaccard_join, "_roots", lambda judged, met, *_: judged.select(F.col("row").alias("a"), F.col("row").alias("b")).limit(0))
    found = similar_groups(documents)
    assert collected(found, "doc_id", "n_shingles", "component_id") == groups_by_hand(pairs(documents), 5, 75)


def test_candidates_grow_with_a_group_not_with_its_pairs(spark, monkeypatch):
    """One-word edits of a text of 40 words: most copies are similar to few others and to no central one."""
    counted, real = [], jaccard_join._verified
    monkeypatch.setattr(jaccard_join, "_verified", lambda pairs, *rest: counted.append(pairs.count()) or real(pairs, *rest))
    totals = []
    for copies in (150, 300):
        counted.clear()
        rng = random.Random(4)
        rows = []
        for i in range(copies):
            words = [f"b{j}" for j in range(40)]
            words[rng.randrange(40)] = f"y{i}"
            rows.append((i, " ".join(words)))
        found = similar_groups(spark.createDataFrame(rows, "doc_id long, text string"))
        assert collected(found, "doc_id", "n_shingles", "component_id") == groups_by_hand(rows, 5, 75)
        totals.append(sum(counted))
    assert totals[1] <= 2.2 * totals[0] + 20


def test_a_signature_tree_loses_no_similar_pair():
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 400, rng.integers(1, 40))) for _ in range(300)]
    sets += [np.unique(np.append(s[: rng.integers(1, len(s) + 1)], rng.integers(0, 400, 2))) for s in sets[:200]]
    sets.sort(key=len)
    bits = np.zeros((len(sets), 128), np.uint8)
    for row, s in zip(bits, sets, strict=True):
        row[s % 128] = 1
    sizes = np.array([len(s) for s in sets])
    excess = sizes - bits.sum(axis=1)
    packed = np.packbits(bits, axis=1).view(np.uint64)
    roots = np.arange(len(sets)) // 3
    found = list(SignatureTree(roots, sizes, excess, packed, 60).pairs())
    assert len(found) == len(set(found)) < len(sets) ** 2 / 20
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(np.intersect1d(a, sets[j]))
            if roots[i] != roots[j] and 100 * both >= 60 * (len(a) + len(sets[j]) - both):
                assert (j, i) in found or (i, j) in found


def test_one_row_of_each_component_stays(documents, empty):
    kept = without_similar(documents)
    assert kept.columns == documents.columns
    by_hand = groups_by_hand([(i, t) for i, (_, t) in enumerate(pairs(documents))], 5, 75)
    assert kept.count() == len({component for _, _, component in by_hand})
    marked = similar_groups(documents)
    assert marked.where("kept").count() == kept.count()
    assert similar_groups(empty).count() == without_similar(empty).count() == 0


def test_components_of_chains_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(5, i) for i in range(6, 40)] + [(70, 70), (39, 41), (200, 201), (201, 200)]
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {found[i] for i in range(100, 161)} == {100}
    assert {found[i] for i in [*range(5, 40), 41]} == {5}
    assert found[200] == found[201] == 200
    assert 70 not in found
