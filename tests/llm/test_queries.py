"""The registered queries: their columns, their rows, and their SQL where it
can express them."""

import duckdb
import pytest

import __spark_entry__ as E
from tessera.llm import catalog
from tools.check_oracle import rows

COLUMNS = {
    "op1_": {"doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int", "slot": "bigint", "grown_shard": "int"},
    "op2_": {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint", "kept": "boolean"},
    "op3_": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op4_": {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
    "op5_": {"doc_id": "bigint", "n_chars": "bigint", "edited_sha256": "string", "fingerprint": "string", "edited_fingerprint": "string",
             "near_edited": "double", "near_next": "double"},
    "op6_": {"doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint"},
    "op7_": {"doc_id": "bigint", "score": "double", "kept": "boolean"},
    "op8_": {"doc_id": "bigint", "start": "bigint", "n_tokens": "bigint", "ids_crc32": "bigint"},
    "op9_": {"page_id": "bigint", "url": "string", "text": "string", "n_chars": "bigint"},
    "op11_": {"vec_id": "bigint", "code": "string", "error": "bigint", "label_error": "bigint", "codebooks_sha256": "string"},
    "op12_": {"doc_id": "bigint", "n_features": "bigint", "weight": "bigint", "score": "bigint", "rank": "bigint"},
    "op13_": {"doc_id": "bigint", "n_email": "bigint", "n_ip": "bigint", "n_card": "bigint", "n_phone": "bigint", "base_sha256": "string", "spans": "string"},
    "op10_": {"vec_id": "bigint", "n_links": "bigint", "component_id": "bigint", "kept": "boolean"},
}


@pytest.mark.parametrize("prefix", COLUMNS)
def test_columns_and_rows(spark, tiny, prefix):
    name, = [n for n in catalog.QUERIES if n.startswith(prefix)]
    df = E.queries()[name](spark, tiny)
    assert COLUMNS[prefix].items() <= dict(df.dtypes).items()
    source = {"op9_": "pages", "op10_": "embeddings", "op11_": "embeddings"}.get(prefix, "documents")
    got = df.toPandas()
    assert len(got) == spark.read.parquet(f"{tiny}/{source}.parquet").count()
    if name in catalog.ORACLE:
        con = duckdb.connect()
        for view in {source, "benchmark"}:
            con.execute(f"CREATE VIEW {view} AS SELECT * FROM read_parquet('{tiny}/{view}.parquet')")
        want = con.execute(catalog.ORACLE[name]).df()
        assert sorted(got.columns) == sorted(want.columns) and rows(got, 9) == rows(want, 9)


def test_all_are_registered():
    assert set(catalog.QUERIES) < set(E.queries()) and "pipeline" in E.queries()
    assert set(catalog.ORACLE) <= set(E.oracle_sql())
