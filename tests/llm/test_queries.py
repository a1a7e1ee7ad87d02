"""The registered queries, sharding, and the pipeline against its stages by hand."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F
from test_spelling import groups_by_hand
from test_whitening import by_hand

import __spark_entry__ as entry
import corpus_pipeline
import verify
from wattline.llm.queries import ORACLE, QUERIES
from wattline.llm.sharding import shards

SF = "/root/testdata/sf0.001"
tables = pytest.mark.skipif(not Path(SF).is_dir(), reason="test tables are not here")


@tables
@pytest.mark.parametrize("name", list(ORACLE))
def test_queries_agree_with_sql(spark, name):
    assert verify.check(spark, verify.connect(SF), SF, name) == []


@tables
@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ORACLE and not n.startswith("op11_")])
def test_queries_return_every_row(spark, name):
    found = QUERIES[name](spark, SF)
    source, key = next((t, k) for t, k in (("pages", "page_id"), ("embeddings", "vec_id"), ("documents", "doc_id")) if k in found.columns)
    numbers = {r[0] for r in found.select(key).collect()}
    wanted = {r[0] for r in spark.read.parquet(f"{SF}/{source}.parquet").select(key).collect()}
    assert numbers <= wanted if name.startswith("op4_") else numbers == wanted


@tables
def test_spelling_query_agrees_with_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    found = QUERIES["op11_spelling"](spark, SF)
    assert sorted(tuple(r) for r in found.collect()) == groups_by_hand(rows)


@tables
def test_whitening_query_agrees_with_dense_algebra(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()]
    numbers, deviation, values, share = by_hand(rows)
    place = {number: i for i, number in enumerate(numbers)}
    found = QUERIES["op13_whitening"](spark, SF).collect()
    assert len(found) == 8 * len(numbers) and {r.deviation - deviation[place[r.vec_id]] for r in found} == {0}
    for c in range(1, 9):
        mine = {r.vec_id: r.whitened for r in found if r.component == c}
        other = {n: values[place[n], c - 1] for n in numbers}
        direct = max(abs(mine[n] - other[n]) for n in numbers)
        turned = max(abs(mine[n] + other[n]) for n in numbers)
        assert min(direct, turned) < 1e-6
    assert max(abs(r.explained / share[r.component - 1] - 1) for r in found) < 1e-4


def test_registered_names():
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("limit", [300, 5_000, 10**9])
def test_shards_fit_and_hold_every_row(spark, documents, limit):
    same = documents.where("doc_id = 3").select("doc_id", "text").limit(1).crossJoin(spark.range(200)).drop("id")
    rows = documents.select("doc_id", "text").unionAll(same)
    places, directory = shards(rows, limit=limit)
    places, directory = places.cache(), directory.cache()
    wanted = sorted((r.doc_id is None, r.doc_id or 0, len((r.text or "").encode())) for r in rows.collect())
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_bytes) for r in places.collect()) == wanted
    by_shard = {
        (r.shard, r.depth): (r.n, r.b)
        for r in places.groupBy("shard", "depth").agg(F.count("*").alias("n"), F.sum("n_bytes").alias("b")).collect()
    }
    assert by_shard == {(r.shard, r.depth): (r.n_rows, r.n_bytes) for r in directory.collect()}
    assert all(size <= limit or n == 1 for n, size in by_shard.values())
    prefixes = [shard for shard, _ in by_shard]
    assert not any(a != b and b.startswith(a) for a in prefixes for b in prefixes)
    assert all(r.oversized == (r.n_bytes > limit) for r in directory.collect())


def test_an_empty_table_has_no_shards(empty):
    places, directory = shards(empty)
    assert places.count() == directory.count() == 0


@tables
def test_pipeline_follows_its_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {r.doc_id for r in docs.collect()}
    toxic = {r.doc_id for r in QUERIES["op7_toxicity"](spark, SF).where("predicted = 1").collect()}
    kept -= toxic
    rest = docs.where(~F.col("doc_id").isin(list(toxic)))
    by_text, words = {}, {}
    for r in sorted(rest.collect(), key=lambda r: r.doc_id):
        by_text.setdefault(" ".join(r.text.split()) if r.text.strip() == r.text else r.text, r.doc_id)
        w = r.text.encode().lower().split()
        words[r.doc_id] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}
    kept = set(by_text.values())
    roots = {i: i for i in kept}
    for a in sorted(kept):
        for b in sorted(kept):
            both = len(words[a] & words[b])
            if b < a and 100 * both >= 75 * (len(words[a]) + len(words[b]) - both):
                old, new = max(roots[a], roots[b]), min(roots[a], roots[b])
                roots = {i: new if root == old else root for i, root in roots.items()}
    kept = {i for i in kept if roots[i] == i}
    kept -= {r.doc_id for r in QUERIES["op4_decontamination"](spark, SF).collect()}
    pieces = corpus_pipeline.run(spark, SF)
    assert {r.doc_id for r in pieces.select("doc_id").collect()} == kept
    starts = pieces.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("wanted"))
    assert starts.where("n != wanted").count() == 0
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "jaccard_join", "decontamination", "packing"]
