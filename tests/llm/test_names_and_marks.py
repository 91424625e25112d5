"""Clashing column names in placement, emphasis marks in licence notices."""

import pytest

from churnlake.llm import license_scan, placement


def test_placement_keeps_all_columns(spark):
    shape = "doc_id long, slot string, shard string, shard_ string, __key string, __slot string, row string, place string, `a.b` int"
    docs = spark.createDataFrame([(1, "s", "h", "x", "k", "t", "r", "p", 5), (None, None, None, None, None, None, None, None, None)], shape)
    placed = placement.place(docs, "doc_id", placement.named_shards(spark, 4), 499)
    assert placed.columns == [*docs.columns, "slot_", "shard__"]
    rows = {r["doc_id"]: tuple(r) for r in placed.collect()}
    assert rows[1][:9] == (1, "s", "h", "x", "k", "t", "r", "p", 5) and rows[1][10].startswith("shard-")
    plain = placement.place(docs.select("doc_id"), "doc_id", placement.named_shards(spark, 4), 499)
    assert {r.doc_id: (r.slot, r.shard) for r in plain.collect()} == {k: v[9:] for k, v in rows.items()}


@pytest.mark.parametrize("text,found", [
    ("_Released under the MIT License._", True), ("__Released under the MIT License.__", True), ("*Released under the MIT License.*", True),
    ("Released_under_the_MIT_License.", True), ("Released under the  MIT License.", True), ("Released under the MI_T License.", False)])
def test_emphasis(spark, text, found):
    rows = license_scan.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert bool(rows) == found


def test_versions_keep_their_dot(spark):
    text = "__Licensed under CC BY 4.0__"
    assert [r.license for r in license_scan.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()]
    none = "Licensed under CC BY 4_0"
    assert not license_scan.scan(spark.createDataFrame([(1, none)], "doc_id long, text string")).collect()
