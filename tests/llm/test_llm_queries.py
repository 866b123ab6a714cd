"""Queries against their SQL, and the pipeline against a brute-force version of its decisions."""

import re
from collections import Counter, defaultdict

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from policylake.llm import queries
from policylake.llm.oracle import ORACLE

from check_oracles import compare, connect
from test_llm_operators import low, shingle_set


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, folder, name):
    assert compare(queries.QUERIES[name](spark, folder).toArrow(), connect(folder).sql(ORACLE[name]).to_arrow_table()) is None


def test_pipeline(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    items = [r.text for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    seen = {r.doc_id: r.text for r in docs.collect()}
    staged = {}
    for name, apply in corpus_pipeline.STAGES[:-1]:
        out = corpus_pipeline.stage(apply(spark, docs, folder), name)
        assert out.columns == docs.columns
        docs, staged[name] = out, {r.doc_id: r.text for r in out.collect()}
    assert staged["language_id"] == {i: t for i, t in seen.items() if re.search("[^\\W\\d_]", t or "")}

    holders, text = defaultdict(set), staged["language_id"]
    for i, t in text.items():
        for line in t.split("\n"):
            holders[low(line.strip(" \t\n\x0b\x0c\r"))].add(i)
    def stays(i, line):  # noqa: E306
        key = low(line.strip(" \t\n\x0b\x0c\r"))
        return len(key) < 10 or min(holders[key]) == i
    assert staged["line_dedup"] == {i: "\n".join(x for x in t.split("\n") if stays(i, x)) for i, t in text.items()}

    sets = {i: shingle_set(t) for i, t in staged["line_dedup"].items()}
    linked = defaultdict(set)
    for i in sets:
        for j in sets:
            if i < j and sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                linked[i].add(j)
                linked[j].add(i)
    dropped, left = set(), set(sets)
    while left:
        group, todo = set(), [min(left)]
        while todo:
            i = todo.pop()
            if i not in group:
                group.add(i)
                todo += linked[i]
        dropped |= group - {min(group)}
        left -= group
    assert set(staged["minhash_dedup"]) == set(sets) - dropped

    gone = set(staged["minhash_dedup"]) - set(staged["decontamination"])
    flat = {i: " ".join(t.split()) for i, t in staged["minhash_dedup"].items()}
    whole = {i for i, t in flat.items() if any(" ".join(x.split()) in t for x in items)}
    assert whole <= gone and len(gone) <= len(whole) + 2

    mix = corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()
    assert {r.doc_id for r in mix} <= set(staged["decontamination"])
    assert all(n == 1 for n in Counter((r.doc_id, r.epoch) for r in mix).values())


def test_stages_on_odd_rows(spark, folder, docs, no_docs):
    """Nulls, repeated rows, rows with one id and other texts, clashing names; then no rows at all."""
    odd = docs.drop("n_chars").withColumn("n_chars", F.char_length("text").cast("long")).withColumns({"row_key": F.lit("x"), "nth": F.lit("y")})
    odd = odd.unionByName(odd.filter("doc_id = 6").withColumn("text", F.concat(F.lit("another "), "text")))
    texts = {i: sorted({r.text for r in odd.collect() if r.doc_id == i and r.text}) for i in (6, 7)}
    for name, apply in corpus_pipeline.STAGES[:-1]:
        out = apply(spark, odd, folder)
        assert out.columns == odd.columns and out.count() <= odd.count(), name
        assert apply(spark, no_docs, folder).count() == 0, name
    mix = corpus_pipeline.mixing_sources(spark, odd, folder).collect()
    assert all(n == 1 for n in Counter((r.doc_id, r.epoch) for r in mix).values())
    assert all(r.text == texts[r.doc_id][0] for r in mix if r.doc_id in texts)
    assert corpus_pipeline.mixing_sources(spark, no_docs, folder).count() == 0
