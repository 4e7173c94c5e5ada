"""Every query of the subpackage on the smallest tables, by SQL where there is any."""

from collections import Counter

import pytest
from checks.compare import connect

import __spark_entry__ as driver
from burstline.llm import queries

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_fingerprints": "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
    "op2_jaccard": "doc_id n_shingles component_id",
    "op3_warc": "page_id payload_bytes payload_digest record_type refers_to",
    "op4_language": "doc_id held_out lang_pred score",
    "op5_mixture": "doc_id size source_size target taken",
    "op6_packing": "doc_id piece start length ids_crc32 sequence_id offset",
    "op7_suffixes": "doc_id n_bytes n_removed n_spans kept_sha256",
    "op8_quality": "doc_id held_out score predicted",
    "op9_exact": "doc_id keep_id group_size kept text_sha256",
    "op10_recompression": "doc_id n_words n_removed kept_sha256",
    "op11_transducer": "doc_id n_bytes n_tokens over_limit",
    "op12_collocations": "lang rank phrase a l r n score",
    "op13_divergence": "lang source part item value rank",
}
#: Queries whose rows are groups, not documents.
GROUPED = {"op12_collocations", "op13_divergence"}


def test_registered():
    assert set(COLUMNS) == set(queries.QUERIES)
    assert set(queries.QUERIES) | {"pipeline"} <= set(driver.queries())
    assert set(queries.ORACLE) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_query(spark, name):
    got = queries.QUERIES[name](spark, SF)
    assert set(COLUMNS[name].split()) <= set(got.columns)
    rows = got.collect()
    if name in GROUPED:
        assert rows and len(set(rows)) == len(rows)
        return check_sql(name, got.columns, rows)
    table, key = ("pages", "page_id") if name == "op3_warc" else ("documents", "doc_id")
    ids = {r[key] for r in spark.read.parquet(f"{SF}/{table}.parquet").select(key).collect()}
    assert {r[key] for r in rows} == ids
    assert len(rows) == len(ids) or name == "op6_packing"
    check_sql(name, got.columns, rows)


def check_sql(name, columns, rows):
    if name in queries.ORACLE:
        relation = connect(SF).sql(queries.ORACLE[name])
        columns = sorted(columns)
        theirs = Counter(relation.select(*[f'"{c}"' for c in columns]).fetchall())
        assert Counter(tuple(r[c] for c in columns) for r in rows) == theirs
