"""The pipeline: stages in order, each on all that the one before kept."""

import corpus_pipeline as p
from panelcraft.llm import simhash_grid, slack_packing

SF = "/root/testdata/sf0.001"


def test_stages_and_rows(spark):
    docs = p.documents(spark, SF)
    columns, seen = docs.columns, [docs.count()]
    for name, stage in p.STAGES:
        out = p.written(stage(spark, docs, SF), "test")
        if name != p.STAGES[-1][0]:
            assert out.columns == columns
            seen.append(out.count())
            assert out.select("doc_id").subtract(docs.select("doc_id")).count() == 0
        before, docs = docs, out
    assert seen == sorted(seen, reverse=True) and seen[-1] > 0.5 * seen[0]
    assert docs.select("doc_id").distinct().count() == before.count()
    assert docs.groupBy("sequence_id").sum("length").filter(f"`sum(length)` > {slack_packing.CAPACITY}").count() == 0


def test_run_equals_the_stages_by_hand(spark):
    docs = p.documents(spark, SF)
    for _, stage in p.STAGES:
        docs = p.written(stage(spark, docs, SF), "test")
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, p.run(spark, SF).select(key).collect())) == sorted(map(tuple, docs.select(key).collect()))


def test_near_duplicates_leave_one_of_each_group(spark):
    docs = p.documents(spark, SF)
    kept = p.near_duplicates(spark, docs, SF)
    groups = simhash_grid.near_duplicates(docs).select("component_id").distinct().count()
    assert kept.count() == groups


def test_empty_documents(spark):
    docs = p.documents(spark, SF).limit(0)
    for _, stage in p.STAGES:
        docs = p.written(stage(spark, docs, SF), "test")
    assert docs.count() == 0
