"""Registered queries of the subpackage over the smallest tables."""

import pytest

import __spark_entry__ as entry_points
from lakestrata.llm.queries import ORACLE_SQL, QUERIES
from verification.compare import difference


def test_all_are_registered():
    assert set(QUERIES) <= set(entry_points.queries())
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES if n != "pipeline")
    assert numbers == list(range(1, 14)) and "pipeline" in QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, name):
    assert difference(spark, entry_points.SMALLEST, QUERIES[name], ORACLE_SQL[name]) is None


@pytest.mark.parametrize(
    "name, columns",
    [
        ("op3_bpe_merge_replay", "doc_id n_tokens ids_sha256 decoded_sha256"),
        ("op5_wavelet_shards", "doc_id start n_tokens ids_crc32"),
        ("op7_jaccard_groups", "doc_id n_shingles component_id"),
        ("op8_secret_blob_ledger", "doc_id n_assign n_access n_hex base_sha256 spans"),
        ("op9_vector_collisions", "vec_id n_links component_id kept"),
        ("op11_ring_shards", "doc_id size text_crc32 law shard slot grown_shard"),
        (
            "op12_token_spans",
            "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256",
        ),
    ],
)
def test_query_returns_every_row(spark, name, columns):
    found = QUERIES[name](spark, entry_points.SMALLEST)
    assert found.columns[: len(columns.split())] == columns.split()
    table = "embeddings" if columns.startswith("vec_id") else "documents"
    assert found.count() == spark.read.parquet(f"{entry_points.SMALLEST}/{table}.parquet").count()
