"""The pipeline against plain versions of its stages, and every registered query of the subpackage."""

import os
import random

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline as P
from clickstream.llm import queries as Q
from clickstream.llm import toxicity as tox
from clickstream.llm.common import held_out
from clickstream.llm.sentencepiece_viterbi import decode, load
from test_decontam import brute as brute_leaks
from test_line_dedup import brute as brute_lines, key_of
from test_simhash import brute_fp, brute_groups

SF = "/root/testdata/sf0.001"


def plain_lines(rows):
    """Line dedup by its definition: (doc_id, text) with lines cut."""
    holders = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key_of(line)) >= 40:
                holders.setdefault(key_of(line), set()).add(i)
    gone = lambda i, x: len(key_of(x)) >= 40 and len(holders[key_of(x)]) >= 5 and i < max(holders[key_of(x)])
    return [(i, "\n".join(x for x in (t or "").split("\n") if not gone(i, x)) if any(gone(i, x) for x in (t or "").split("\n")) else t)
            for i, t in rows]


def test_pipeline_matches_plain_stages(llm):
    out = P.run(llm, SF)
    docs = llm.read.parquet(f"{SF}/documents.parquet")
    assert out.columns == [*docs.columns, "ids"]
    model = tox.fit(docs, llm.read.parquet(f"{SF}/labels.parquet"), usable=~held_out(F.col("doc_id")))
    lex = tox.Lexicon(model.insults, model.threat)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    rows = [(i, t) for i, t in rows if model.slope * tox.document_signal(t, lex) + model.offset < 0]
    rows = sorted(plain_lines(rows))
    rep = brute_groups([0] * len(rows), [brute_fp(t) for _, t in rows], 4)
    rows = [r for k, r in enumerate(rows) if rep[k] == k]  # the smallest id of each group
    items = [(r.item_id, r.text) for r in llm.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaks = {x[0]: x[4] for x in brute_leaks(rows, items)}
    rows = [(i, t) for i, t in rows if not leaks[i]]
    got = {r.doc_id: r for r in out.collect()}
    assert sorted(got) == [i for i, _ in rows] and 0 < len(rows) < docs.count()
    piece = load(Q.tokenizer_file("piece_bpe_32k.model"))
    for i, t in rows:
        assert got[i].text == t and decode(piece, got[i].ids) == t
    assert all(r.n_chars == len(r.text) for r in got.values())


def test_every_stage_takes_odd_documents(llm, tmp_path):
    rnd = random.Random(1)
    rows = [(i, rnd.choice([None, "", "a b c", "the same words again and again", "x" * 5000]), "en", None, None, 1.0, "z") for i in range(12)]
    rows += [(None, None, None, None, None, None, None), (3, "repeated id", None, "s", 1, 0.0, "y"), (3, "repeated id", None, "s", 1, 0.0, "y")]
    schema = "doc_id long, text string, lang string, source string, n_chars long, score double, ids string"
    for data in (rows, []):
        docs = llm.createDataFrame(data, schema)
        for name, stage in P.STAGES:
            path = str(tmp_path / f"{name}-{len(data)}")
            stage(llm, docs, SF).write.parquet(path)
            new = llm.read.parquet(path)
            assert new.columns[:len(docs.columns)] == docs.columns or set(docs.columns) <= set(new.columns), name
            assert new.count() <= docs.count()
            docs = new


def test_registered_queries(llm):
    names = [f"op{n}_" for n in range(1, 14)]
    have = [q for q in entry.queries() if q.startswith("op")]
    assert [sum(q.startswith(n) for q in have) for n in names] == [1] * 13 and "pipeline" in entry.queries()
    n = llm.read.parquet(f"{SF}/documents.parquet").count()
    for q in have:
        if not q.startswith(("op11_", "op12_", "op13_")):  # of other tables, held against their SQL below
            assert entry.queries()[q](llm, SF).count() == n, q


@pytest.mark.parametrize("name", sorted(k for k in entry.oracle_sql() if k.startswith("op")))
def test_queries_match_their_sql(llm, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "labels", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = con.execute(entry.oracle_sql()[name])
    cols = [c[0] for c in want.description]
    got = entry.queries()[name](llm, SF)
    assert sorted(got.columns) == sorted(cols)
    assert sorted((tuple(r[c] for c in cols) for r in got.collect()), key=str) == sorted(want.fetchall(), key=str)


def test_native_operators_run_no_python(llm):
    for q in ("op2_secret_scan", "op8_quality_rules", "op13_url_filter"):
        plan = Q.QUERIES[q](llm, SF)._jdf.queryExecution().toString()
        assert not any(x in plan for x in ("Python", "Pandas", "Arrow")), q


def test_nothing_else_imports_the_subpackage():
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    for top in ("clickstream", "tools"):
        for d, _, files in os.walk(os.path.join(root, top)):
            for f in files:
                if f.endswith(".py") and "/llm" not in d:
                    with open(os.path.join(d, f)) as fh:
                        assert "clickstream.llm" not in fh.read(), f
