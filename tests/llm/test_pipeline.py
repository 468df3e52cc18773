"""The pipeline: all stages against plain Python, and each stage on odd rows."""

import pytest

SF = "/root/testdata/sf0.001"


def test_pipeline(spark):
    """run() against the stages in plain Python."""
    import corpus_pipeline
    from quillmesh.llm.pieces import MODEL
    from test_cross_document import brute_components
    from test_row_local import brute_contamination, brute_lines, brute_verdicts

    import sentencepiece

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    verdicts = brute_verdicts([(r.doc_id, r.source, r.text) for r in docs.collect()], 100)
    rows = [(i, verdicts[i][2]) for i in sorted(texts) if verdicts[i][0]]
    rows = [(i, v[2]) for i, v in brute_lines(rows).items()]
    parts = brute_components(rows)
    rows = [(i, t) for i, t in rows if parts[i][2]]
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    bad = brute_contamination(rows, bench)
    rows = [(i, t) for i, t in rows if not bad[i][1]]
    plain = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, SF).collect()}
    assert set(got) == {i for i, _ in rows}
    assert all(got[i].n_tokens == len(plain.encode(t)) and got[i].round_trip for i, t in rows)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "near_dedup", "decontamination", "sentencepiece"]
    assert corpus_pipeline.STAGES[0][1](spark, docs, SF).columns == docs.columns


STAGE_NAMES = ["quality_rules", "line_dedup", "near_dedup", "decontamination", "sentencepiece"]
ODD_NAMES = ["n_words", "key", "text_2", "score", "ids", "bands_2", "_keys", "_doc", "_kept", "_good", "_gone", "_bad", "row", "keys", "lines", "kept", "at", "host", "h", "node", "bands", "items", "hits"]


@pytest.mark.parametrize("k", range(5))
def test_stage_on_odd_rows(spark, make, k):
    """Null ids, nulls, empties, repeated rows, a long word, ties and clashing columns; then an empty table."""
    import corpus_pipeline

    long = " ".join(f"w{i}" for i in range(60))
    rows = [(1, None), (2, ""), (3, " \t\n"), (None, long), (None, None), (4, long), (4, long), (5, long), (6, "x" * 200_000), (7, "\n".join([long] * 3))]
    docs = make(rows, extra=False)
    for name in ODD_NAMES:
        docs = docs.selectExpr("*", f"cast(9 as int) AS `{name}`")
    name, stage = corpus_pipeline.STAGES[k]
    out = stage(spark, docs, SF)
    got = [(r.doc_id, getattr(r, "text", None)) for r in out.collect()]
    if k == 4:
        assert sorted(str(i) for i, _ in got) == sorted(str(i) for i, _ in rows)
    else:
        assert out.columns == docs.columns
        assert all(r[n] == 9 for r in out.collect() for n in ODD_NAMES)
    if k == 0:  # too few words, or too many repeated ones, go
        assert sorted(str(i) for i, _ in got) == ["4", "4", "5", "None"]
    if k in (1, 3):
        assert len(got) == len(rows) and dict(got)[1] is None
    if k == 2:  # 5 is a copy of 4 and 7 a near copy (56 of 60 shingles), both rows of 4 stay, rows without doc_id stay
        assert sorted(str(i) for i, _ in got) == sorted(["1", "2", "3", "None", "None", "4", "4", "6"])
    assert stage(spark, docs.limit(0), SF).count() == 0
