"""The pipeline against its stages' own decisions, on the small tables."""

import pytest

import corpus_pipeline as cp
from riskframe.llm import decontam, neardup

from llm_rows import SF_SMALL


def test_stages_and_run(spark):
    assert [n for n, _ in cp.STAGES] == ["toxicity", "line_dedup", "near_dedup", "decontamination", "mixing"]
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns, ids = docs.columns, {r["doc_id"] for r in docs.select("doc_id").collect()}
    for name, stage in cp.STAGES[:-1]:
        docs = cp.stored(stage(spark, docs, SF_SMALL), f"t-{name}")
        assert docs.columns == columns
        left = {r["doc_id"] for r in docs.select("doc_id").collect()}
        assert left <= ids and docs.count() == len(left) and (name != "line_dedup" or left == ids)
        ids = left
        if name == "near_dedup":
            assert neardup.near_duplicates(docs).filter("id <> class_id").count() == 0
        if name == "decontamination":
            bench = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
            assert decontam.find_leaks(docs, bench).filter("size(leaks) > 0").count() == 0
    mix = cp.run(spark, SF_SMALL).collect()
    assert {r["doc_id"] for r in mix} == ids and len(mix) == len(ids)
    assert all(0 <= r["taken"] <= 3 * r["size"] for r in mix)


@pytest.mark.parametrize("rows", [0, 1])
def test_nasty_rows(spark, rows):
    from llm_rows import NASTY
    docs = spark.createDataFrame([(i, t, "en", None, len(t or "")) for i, t in NASTY],
                                 "doc_id long, text string, lang string, source string, n_chars long").selectExpr("*", "1 as score", "2 as row")
    docs = docs if rows else docs.limit(0)
    for _, stage in cp.STAGES[1:-1]:
        docs = cp.stored(stage(spark, docs, SF_SMALL), "t-nasty")
    assert docs.count() == (5 if rows else 0)       # blank texts, equal texts and a repeated id are one each
    assert cp.STAGES[-1][1](spark, docs, SF_SMALL).count() == docs.count()


def test_rows_that_share_an_id_are_documents_of_their_own(spark):
    """Their texts and classes stay apart; the copies of each are one."""
    words = [" ".join(f"{w}{i}" for i in range(60)) for w in "abcd"]
    rows = [(7, words[0]), (7, words[1]), (7, words[1]), (7, None), (8, words[0]), (9, words[2]), (9, words[2] + " end"), (10, words[3])]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, source string, several int")
    left = cp.drop_near_duplicates(spark, docs, SF_SMALL)
    assert left.columns == docs.columns
    got = sorted((r["doc_id"], r["text"] or "") for r in left.collect())
    assert got[:3] == [(7, ""), (7, words[1]), (8, words[0])] and got[4:] == [(10, words[3])] and got[3][0] == 9 and len(got) == 5
    ident = cp.identified(docs).select("row.doc_id", "ident").distinct().collect()
    assert {r["doc_id"] for r in ident if r["ident"] == r["doc_id"]} == {8, 10}
    assert sorted(r["doc_id"] for r in ident if r["ident"] >= 1 << 62) == [7, 7, 7, 9, 9]
