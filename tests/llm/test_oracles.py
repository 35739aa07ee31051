"""The registered corpus queries: those with SQL against it, the others for their columns (sf0.001)."""

import duckdb
import pytest

from yoyflow.llm import registry

SF = "/root/testdata/sf0.001"
CONTRACTS = {
    "op3_token_counts": "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean",
    "op4_language_id": "doc_id bigint, held_out boolean, lang_pred string, score double",
    "op6_nearest": "query_id bigint, rank int, vec_id bigint, score double",
    "op7_token_files": "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint",
    "op8_lattice_lm": "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double",
    "op10_secrets": "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string",
    "op11_quality_rules": "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean",
    "op12_hard_negatives": "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint",
    "op13_prefix_trie": "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string",
}


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = con.execute(registry.oracle_sql()[name])
    columns = [c[0] for c in want.description]
    got = registry.queries()[name](spark, SF).select(*columns)
    order = lambda r: tuple((x is None, x) for x in r)
    assert sorted((tuple(r) for r in got.collect()), key=order) == sorted(want.fetchall(), key=order)


@pytest.mark.parametrize("name", sorted(CONTRACTS))
def test_contract_columns(spark, name):
    types = dict(registry.queries()[name](spark, SF).dtypes)
    for column in CONTRACTS[name].split(", "):
        c, kind = column.split()
        assert types[c] == kind
