"""The queries against their DuckDB SQL, and the pipeline against its stages' rules."""

import pytest

from portrait.llm.oracle import ORACLE_SQL
from portrait.llm.queries import QUERIES
from portrait.plans.check import compare, duckdb_conn

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duckdb_conn(SMALL)


@pytest.mark.parametrize("key", sorted(ORACLE_SQL))
def test_matches_duckdb(llm, con, key):
    r = compare(QUERIES[key](llm, SMALL), con, ORACLE_SQL[key])
    assert r["cols_match"] and r["rows_match"] and r["values_match"] and r["types_match"], r


def test_pipeline(llm, tmp_path):
    import corpus_pipeline as P

    from portrait.llm import decontaminate, ngram_join, quality_rules, sentencepiece_codec, suffix_dedup
    from portrait.llm.queries import VOCABULARY
    docs = before = llm.read.parquet(f"{SMALL}/documents.parquet")
    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}
    seen = []
    for name, stage in P.STAGES:
        path = str(tmp_path / name.replace(" ", "-"))
        stage(llm, docs, SMALL).write.parquet(path)
        before, docs = docs, llm.read.parquet(path)
        seen.append((before, docs))
        if name != P.STAGES[-1][0]:
            assert docs.columns == before.columns
            assert docs.filter("n_chars != length(text)").count() == 0
    (q0, q1), (j0, j1), (s0, s1), (d0, d1), (e0, e1) = seen
    assert ids(q1) == ids(quality_rules.judge(q0).filter("kept"))
    assert ids(j1) == {r.component_id for r in ngram_join.join(j0).collect()}
    assert ids(s1) == ids(s0)
    cut = {r.doc_id: r for r in suffix_dedup.report(s0, length=P.PASSAGE_BYTES).collect()}
    for r in s1.collect():
        assert len(r.text.encode()) <= cut[r.doc_id].n_bytes - cut[r.doc_id].n_removed
    bench = llm.read.parquet(f"{SMALL}/benchmark.parquet")
    assert ids(d1) == ids(d0) - ids(decontaminate.scan(d0, bench).filter("contaminated"))
    back = sentencepiece_codec.decode(e1, sentencepiece_codec.Vocabulary.load(VOCABULARY))
    assert {(r.doc_id, r.text) for r in back.collect()} == {(r.doc_id, r.text) for r in e0.collect()}


def test_pipeline_removes_passages_of_fifty_words(llm):
    """A passage of 51 words, below 400 bytes, in two documents that share nothing else."""
    import corpus_pipeline as P
    own = lambda k: " ".join(f"{k}{i}{k}" for i in range(60))
    passage = " ".join(f"word{i % 7}{chr(97 + i % 26)}" for i in range(51))
    rows = [(1, f"{own('a')} {passage} {own('b')}"), (2, f"{own('c')} {passage} {own('d')}"), (3, own("e"))]
    docs = llm.createDataFrame(rows, "doc_id long, text string")
    left = {r.doc_id: r.text for r in dict(P.STAGES)["suffix-array dedup"](llm, docs, SMALL).collect()}
    assert 250 < len(passage) < 400 and not any(passage in t for t in left.values())
    assert left[3] == own("e") and all(left[i].startswith(own(k)) for i, k in ((1, "a"), (2, "c")))


def test_pipeline_keeps_a_row_given_twice(llm):
    """A repeated row and a copy without id leave one row, whose text the next stage does not remove."""
    import corpus_pipeline as P
    text = " ".join(f"clean{i}" for i in range(90))
    rows = [(1, text), (1, text), (2, text), (None, text), (3, " ".join(f"own{i}" for i in range(90)))]
    stages, docs = dict(P.STAGES), llm.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "length(text) n_chars")
    once = stages["n-gram Jaccard join"](llm, docs, SMALL)
    assert sorted(r.doc_id for r in once.collect()) == [1, 3]
    left = {r.doc_id: r for r in stages["suffix-array dedup"](llm, once, SMALL).collect()}
    assert left[1].text == text and left[1].n_chars == len(text)


def test_pipeline_on_edge_cases(llm, edge, empty, tmp_path):
    """Nulls in every column, empty, white, very long and repeated texts, clashing names, no rows."""
    import corpus_pipeline as P
    bench = llm.read.parquet(f"{SMALL}/benchmark.parquet")
    for name, docs in (("edge", edge), ("empty", empty)):
        sf = str(tmp_path / name)
        docs.write.parquet(f"{sf}/documents.parquet")
        bench.write.parquet(f"{sf}/benchmark.parquet")
        before = llm.read.parquet(f"{sf}/documents.parquet")
        for stage, f in P.STAGES[:-1]:
            f(llm, before, sf).write.parquet(f"{sf}/{stage}")
            before = llm.read.parquet(f"{sf}/{stage}")
            assert before.columns == edge.columns
        got = {r.doc_id: r.n_tokens for r in P.run(llm, sf).collect()}
        if name == "empty":
            assert got == {}
            continue
        # one of the copies 0, 1, the row without id and the near copy 2; one of 8 and 9, near copies too; 11 alone
        assert got.keys() == {0, 8, 11} and all(n > 0 for n in got.values())
        kept = {r.doc_id: r.text for r in before.collect()}
        assert "passage5 " in kept[8] and kept[11].endswith("u29999")
