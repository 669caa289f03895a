"""Every registered query of the subpackage: against SQL where there is one, else its columns."""

import duckdb
import pytest

from chronogrid.llm import registered

SF = "/root/testdata/sf0.01"
COLUMNS = {
    "op1_language": ["doc_id", "held_out", "lang_pred", "score", "lang_rejected"],
    "op2_warc": ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
    "op3_line_dedup": ["doc_id", "n_lines", "n_dropped", "kept_sha256"],
    "op4_quality": ["doc_id", "lang", "n_symbols", "perplexity", "threshold", "rejected"],
    "op5_nearest": ["query_id", "rank", "vec_id", "score"],
    "op6_simhash": ["doc_id", "fingerprint", "component_id"],
    "op7_bpe": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op8_decontamination": ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
    "op9_sharding": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
    "op10_html": ["page_id", "url", "text", "n_chars"],
    "op11_conversation_trie": ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"],
    "op12_secrets": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    "op13_manifest": ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"],
}


def plain(rows):
    return sorted((tuple(None if v is None or v != v else v for v in r) for r in rows), key=repr)


def sql_rows(sf, sql, columns):
    con = duckdb.connect()
    for name in ("documents", "pages", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    assert sorted(names) == sorted(columns)
    order = [names.index(c) for c in columns]
    return [tuple(r[i] for i in order) for r in found.fetchall()]


def test_all_registered():
    assert set(registered.QUERIES) == set(COLUMNS)


@pytest.mark.parametrize("name", sorted(registered.ORACLE))
def test_against_sql(ready, name):
    got = registered.QUERIES[name](ready, SF)
    assert got.columns == COLUMNS[name]
    assert plain(got.collect()) == plain(sql_rows(SF, registered.ORACLE[name], got.columns))


EMPTY = {
    "documents": ([], "doc_id long, text string, lang string, source string, n_chars long"),
    "pages": ([], "page_id long, url string, html string"),
    "embeddings": ([], "vec_id long, embedding array<float>, label int"),
    "benchmark": ([], "item_id long, text string"),
    "labels": ([], "doc_id long, quality int, toxic int"),
    "conversations": ([], "conv_id long, turn long, role string, text string"),
}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_empty_tables(ready, tables, name):
    got = registered.QUERIES[name](ready, tables(**EMPTY))
    assert got.columns == COLUMNS[name]
    assert got.count() == 0


NULLS = {
    "documents": ([(None,) * 5, (None,) * 5, (50, None, None, None, None), (100, "", "en", "s", 0)], EMPTY["documents"][1]),
    "pages": ([(None, None, None), (None, None, None), (3, None, ""), (4, "u", "<p>x")], EMPTY["pages"][1]),
    "embeddings": ([(None, [1.0, 2.0], 1), (50, None, 1), (100, [0.0, 0.0], 1), (150, [1.0, None], 1), (200, [], 1),
                    (250, [float("nan"), 1.0], 1), (300, [1.0, 2.0], 1), (300, [1.0, 2.0], 1), (301, [1.0, 2.0], 1),
                    (302, [-1.0, 2.0], None), (303, [1.0, 2.0, 3.0], 1)], EMPTY["embeddings"][1]),
    "benchmark": ([(None, None), (1, None), (2, "")], EMPTY["benchmark"][1]),
    "labels": ([(None, None, None), (100, 1, 0)], EMPTY["labels"][1]),
    "conversations": ([(None, None, None, None), (5, None, None, None)], EMPTY["conversations"][1]),
}
ROWS = {"op1_language": 4, "op2_warc": 4, "op3_line_dedup": 4, "op4_quality": 4, "op5_nearest": 2, "op6_simhash": 4,
        "op7_bpe": 4, "op8_decontamination": 4, "op9_sharding": 4, "op10_html": 4, "op11_conversation_trie": 1, "op12_secrets": 4, "op13_manifest": 4}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_nulls(ready, tables, name):
    assert registered.QUERIES[name](ready, tables(**NULLS)).count() == ROWS[name]
