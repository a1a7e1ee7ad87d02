"""One query per operator over its whole table, and the SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.llm import quality, toxicity
from wattline.llm.common import table
from wattline.llm.decontaminate import contaminated
from wattline.llm.exact_dedup import exact_groups
from wattline.llm.html_text import extract
from wattline.llm.jaccard_join import similar_groups
from wattline.llm.labelled import remainder
from wattline.llm.license_scan import scan
from wattline.llm.packing import pack
from wattline.llm.sharding import shards
from wattline.llm.spelling import spelling_groups
from wattline.llm.substring_dedup import repeated_words
from wattline.llm.tensor_minhash import near_groups
from wattline.llm.whitening import whitened


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(table(spark, sf_dir, "documents"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def _verdicts(scored: DataFrame, modulus: int, held_out: int) -> DataFrame:
    return scored.select(
        "doc_id",
        F.coalesce(remainder("doc_id", modulus) == held_out, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.fit(documents, labels, quality.not_held_out(3, 1))
    return _verdicts(quality.scored(documents, model), 3, 1)


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents")).drop("spans")


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    places, _ = shards(table(spark, sf_dir, "documents"))
    return places.drop("row")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit(documents, labels, toxicity.not_held_out(5, 0))
    return _verdicts(toxicity.scored(documents, model), 5, 0)


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = repeated_words(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = similar_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", "n_shingles", "component_id")


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_groups(table(spark, sf_dir, "documents"))


def op12_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_quality": op2_quality,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_decontamination": op4_decontamination,
    "op5_license_scan": op5_license_scan,
    "op6_sharding": op6_sharding,
    "op7_toxicity": op7_toxicity,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_html_text": op10_html_text,
    "op11_spelling": op11_spelling,
    "op12_minhash": op12_minhash,
    "op13_whitening": op13_whitening,
}



def _linked_sql(size: int, similarity: int, columns: str) -> str:
    """Components of documents by all pairs that share a shingle; the recursion follows links to the smallest number."""
    return rf"""
        with recursive words as (
            select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x20\x09-\x0D]+') as w
            from documents
        ),
        sets as (
            select doc_id, case when len(w) = 0 then [] when len(w) < {size} then [array_to_string(w, ' ')]
                else list_distinct([array_to_string(w[i : i + {size - 1}], ' ') for i in range(1, len(w) - {size - 2})]) end as s
            from words
        ),
        tokens as (select doc_id, len(s) as n, unnest(s) as token from sets),
        pairs as (
            select a.doc_id as a, b.doc_id as b, any_value(a.n) + any_value(b.n) as total, count(*) as shared
            from tokens a join tokens b on a.token = b.token and a.doc_id < b.doc_id group by a.doc_id, b.doc_id
        ),
        links as (select a, b from pairs where 100 * shared >= {similarity} * (total - shared)),
        edges as (select a, b from links union all select b, a from links),
        reached(doc_id, other) as (
            select doc_id, doc_id from documents
            union
            select r.doc_id, e.b from reached r join edges e on r.other = e.a
        )
        select {columns}
        from (select doc_id, min(other) as component_id from reached group by doc_id) c join sets using (doc_id)
    """


ORACLE = {
    "op3_exact_dedup": r"""
        with normal as (
            select doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) as text_sha256
            from documents
        )
        select doc_id,
               min(doc_id) over same as keep_id,
               count(*) over same as group_size,
               doc_id = min(doc_id) over same as kept,
               text_sha256
        from normal window same as (partition by text_sha256)
    """,
    "op8_substring_dedup": r"""
        with words as (
            select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents
        ),
        places as (select doc_id, w, unnest(range(1, len(w) - 33)) as i from words),
        windows as (select doc_id, i, array_to_string(w[i : i + 34], ' ') as run from places),
        repeated as (select run from windows group by run having count(*) > 1),
        covered as (
            select doc_id, list_distinct(flatten(list(range(i, i + 35)))) as c
            from windows join repeated using (run) group by doc_id
        ),
        kept as (
            select doc_id, w, case when c is null then w else [w[i] for i in range(1, len(w) + 1) if not list_contains(c, i)] end as k
            from words left join covered using (doc_id)
        )
        select doc_id, len(w) as n_words, len(w) - len(k) as n_removed, sha256(array_to_string(k, ' ')) as kept_sha256 from kept
    """,
    "op9_jaccard_join": _linked_sql(5, 75, "doc_id, len(s) as n_shingles, component_id"),
    "op12_minhash": _linked_sql(4, 80, "doc_id, len(s) as n_shingles, component_id, doc_id = component_id as kept"),
}
