"""The driver queries: names, columns and whole tables."""

import pytest

from trailmark.llm import queries

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_bpe": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op2_packing": "doc_id piece start length ids_crc32 sequence_id offset",
    "op3_simhash": "doc_id fingerprint component_id",
    "op4_toxicity": "doc_id held_out score predicted",
    "op5_pii": "doc_id n_email n_ip n_card n_phone base_sha256 spans",
    "op6_topk": "query_id rank vec_id score",
    "op7_urls": "page_id host path rule verdict",
    "op8_licenses": "doc_id n_words n_base first_word last_word base_labels labels score",
    "op9_token_counts": "doc_id n_bytes n_tokens over_limit",
    "op10_embedding_dedup": "vec_id n_links component_id kept",
    "op11_importance": "doc_id n_features weight score rank",
    "op12_neighbours": "query_id rank vec_id score",
    "op13_conversations": "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256",
}
ROWS_OF = {"op6_topk": None, "op7_urls": "pages", "op10_embedding_dedup": "embeddings", "op2_packing": None,
           "op12_neighbours": None, "op13_conversations": None}


@pytest.mark.parametrize("name", list(COLUMNS))
def test_columns_and_rows(spark, name):
    found = queries.QUERIES[name](spark, SF)
    assert found.columns == COLUMNS[name].split()
    table = ROWS_OF.get(name, "documents")
    if table:
        assert found.count() == spark.read.parquet(f"{SF}/{table}.parquet").count()


def test_one_query_for_each_operator():
    assert set(queries.QUERIES) == set(COLUMNS) and set(queries.ORACLE_SQL) <= set(COLUMNS)


def test_types(spark):
    types = dict(queries.op2_packing(spark, SF).dtypes)
    assert (types["piece"], types["start"], types["sequence_id"], types["offset"]) == ("int", "bigint", "bigint", "bigint")
    assert dict(queries.op3_simhash(spark, SF).dtypes) == {
        "doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"}
    assert all(len(r.fingerprint) == 16 and r.fingerprint == r.fingerprint.lower()
               for r in queries.op3_simhash(spark, SF).collect())
