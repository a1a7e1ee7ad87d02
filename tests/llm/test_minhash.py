"""Tensored minhash and the linking of rows that share keys, against brute force."""

from __future__ import annotations

import random

import numpy as np
import pytest
from test_copies import collected, groups_by_hand, pairs

from wattline.llm import linking
from wattline.llm.jaccard_join import Shingles
from wattline.llm.tensor_minhash import HALVES, WIDTH, MinHashes, half_keys, least_equal, near_groups


@pytest.mark.parametrize(("size", "similarity"), [(4, 80), (2, 90), (4, 100)])
def test_near_groups(documents, size, similarity):
    found = near_groups(documents, shingle=size, similarity=similarity)
    assert collected(found, "doc_id", "n_shingles", "component_id") == groups_by_hand(pairs(documents), size, similarity)


def test_one_row_of_each_component_is_kept(documents, empty):
    by_hand = groups_by_hand([(i, t) for i, (_, t) in enumerate(pairs(documents))], 4, 80)
    assert near_groups(documents).where("kept").count() == len({component for _, _, component in by_hand})
    assert near_groups(empty).count() == 0
    assert near_groups(empty).columns == ["doc_id", "n_shingles", "component_id", "kept"]


@pytest.mark.parametrize(("few", "deals"), [(0, 1), (1 << 20, 8)])
def test_groups_that_are_divided_lose_no_link(spark, monkeypatch, few, deals):
    """One-word edits of a short text: most copies are similar to few others, and homes are far larger than a part."""
    monkeypatch.setattr(linking, "PART_ROWS", 6)
    monkeypatch.setattr(linking, "DEALS", deals)
    monkeypatch.setattr(linking, "FEW_LINKS", few)
    counted = []
    monkeypatch.setattr(linking, "classes_of", lambda links, real=linking.classes_of: counted.append(links.count()) or real(links))
    rng = random.Random(3)
    base = [f"b{i}" for i in range(40)]
    rows = []
    for i in range(120):
        words = list(base)
        words[rng.randrange(40)] = f"y{i}"
        rows.append((i, " ".join(words)))
    other = [f"c{i}" for i in range(30)]
    rows += [(200 + i, " ".join(base[:12] + other[: 18 + i % 4])) for i in range(20)]
    rng.shuffle(rows)
    found = near_groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    assert collected(found, "doc_id", "n_shingles", "component_id") == groups_by_hand(rows, 4, 80)
    assert deals == 1 or max(counted) <= 3 * len(rows)


def test_minhashes_estimate_similarity():
    rng = np.random.default_rng(1)
    hashes = MinHashes(2000)
    shared, a, b = (rng.integers(0, 2**63, n).astype(np.uint64) for n in (600, 200, 200))
    x, y = (hashes.of(np.unique(np.concatenate([shared, own]))) for own in (a, b))
    assert abs((x == y).mean() - 0.6) < 0.05


def test_pairs_at_the_threshold_share_a_table():
    """Of 3,000 pairs of similarity 0.8 all share a half key in both collections, and enough minhashes."""
    rng = np.random.default_rng(2)
    hashes = MinHashes(2 * HALVES * WIDTH)
    needed = least_equal(2 * HALVES * WIDTH, 80)
    for _ in range(3000):
        tokens = rng.integers(0, 2**63, 50).astype(np.uint64)
        x, y = hashes.of(tokens[:45]), hashes.of(tokens[5:])
        same = half_keys(x, WIDTH) == half_keys(y, WIDTH)
        assert same[:HALVES].any() and same[HALVES:].any()
        assert (x == y).sum() >= needed


def test_long_texts_are_hashed_whole():
    text = " ".join(str(i % 70001) for i in range(300_000)).encode()
    tokens = Shingles(4).of(text)
    parts = [MinHashes(8).of(tokens[i : i + 1000]) for i in range(0, len(tokens), 1000)]
    assert len(tokens) > 70_000 and len(parts) > 70
    assert MinHashes(8).of(tokens[::-1].copy()).tolist() == MinHashes(8).of(tokens).tolist()
