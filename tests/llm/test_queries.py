"""Every registered query over its whole table: columns, types, rows, and SQL twins."""

import duckdb
import pytest

import __spark_entry__ as entry
from check_queries import TABLES, rows_of
from tests.llm.conftest import SF

CONTRACT = {
    "op1_virtual_slots": "doc_id bigint, size bigint, text_crc32 bigint, law string, shard int, slot bigint, grown_shard int",
    "op2_block_anchors": "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string",
    "op3_weighted_mixing": "doc_id bigint, size bigint, source_size bigint, target double, taken bigint",
    "op4_segment_edit_lines": "doc_id bigint, n_lines bigint, n_removed bigint",
    "op5_rank_order_language": "doc_id bigint, held_out boolean, lang_pred string, score double",
    "op6_template_decontamination": "doc_id bigint, item_id bigint",
    "op7_recurrent_toxicity": "doc_id bigint, held_out boolean, score double, predicted int",
    "op8_cotrained_quality": "doc_id bigint, score double",
    "op9_projection_forest": "vec_id bigint, n_links bigint, component_id bigint, kept boolean",
    "op10_shingle_jaccard": "doc_id bigint, n_shingles bigint, component_id bigint",
    "op11_ball_codes": "vec_id bigint, code string, error bigint, label_error bigint, codebooks_sha256 string",
    "op12_packed_audit": (
        "part string, filter_order string, step int, kept bigint, removed bigint, redundant bigint, unique_fails bigint, "
        "good_lost bigint, toxic_lost bigint, shapley bigint"
    ),
    "op13_certified_packing": "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint",
}


def test_all_operators_and_the_pipeline_are_registered():
    names = [n for n in entry.queries() if n.startswith("op") or n == "pipeline"]
    assert sorted(names) == sorted([*CONTRACT, "pipeline"])


@pytest.mark.parametrize("name", CONTRACT)
def test_columns_and_rows(spark, name):
    got = entry.queries()[name](spark, SF)
    assert set(CONTRACT[name].split(", ")) <= {" ".join(x) for x in got.dtypes}
    table = "embeddings" if "vec_id" in got.columns else "documents"
    if name == "op12_packed_audit":
        parts = {r[0] for r in got.select("part").distinct().collect()}
        whole = spark.read.parquet(f"{SF}/documents.parquet")
        assert parts == {r[0] or "" for r in whole.select("lang").distinct().collect()} and got.count() == 600 * len(parts)
        return
    if name == "op13_certified_packing":
        got = got.filter("piece = 0")
    if name != "op6_template_decontamination":
        whole = spark.read.parquet(f"{SF}/{table}.parquet")
        key = got.columns[0]
        assert sorted(r[0] for r in got.select(key).collect()) == sorted(r[0] for r in whole.select(key).collect())


def test_twins(spark):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    twins = {n: s for n, s in entry.oracle_sql().items() if n in CONTRACT}
    assert list(twins) == ["op3_weighted_mixing", "op11_ball_codes", "op12_packed_audit"]
    for name, sql in twins.items():
        assert rows_of(entry.queries()[name](spark, SF).toPandas()) == rows_of(con.execute(sql).df())
