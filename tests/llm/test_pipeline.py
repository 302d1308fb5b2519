"""Stages of the corpus pipeline, each on its own input."""

from collections import Counter

import pytest

import corpus_pipeline as P
from loadcast.llm import boilerplate, hyperminhash, mixing, toxicity
from loadcast.llm.common import keep


@pytest.fixture(scope="module")
def steps(spark, sf_dir, docs):
    out = [docs]
    for name, stage in P.STAGES:
        out.append(keep(stage(spark, out[-1], sf_dir), f"test-{name}"))
    return out


def rows(df):
    return Counter(tuple(r) for r in df.select("doc_id", "text").collect())


def test_columns(steps):
    assert [s.columns for s in steps[1:-1]] == [steps[0].columns] * 4 and len(P.STAGES) == 5


def test_toxicity_stage(spark, sf_dir, steps):
    judged = toxicity.toxicity(steps[0], spark.read.parquet(f"{sf_dir}/labels.parquet"))
    gone = {r["doc_id"] for r in judged.collect() if r["predicted"]}
    assert rows(steps[1]) == Counter({k: n for k, n in rows(steps[0]).items() if k[0] not in gone})


def test_line_stage(steps):
    assert rows(steps[2]) == rows(boilerplate.drop_boilerplate(steps[1]))
    assert all(r["n_chars"] == len(r["text"] or "") for r in steps[2].join(steps[1].select("doc_id", steps[1]["text"].alias("was")), "doc_id").where("text <> was").collect())


def test_near_stage(steps):
    kept = {r["doc_id"] for r in hyperminhash.near_documents(steps[2]).collect() if r["kept"]}
    assert {k[0] for k in rows(steps[3])} == kept and set(rows(steps[3])) <= set(rows(steps[2]))


def test_mixing_stage(steps):
    want = Counter({r["doc_id"]: r["copies"] for r in mixing.plan(steps[3]).collect() if r["copies"]})
    assert Counter(r[0] for r in steps[4].select("doc_id").collect()) == want


def test_packing_stage(steps):
    pieces = steps[5].collect()
    assert Counter({k: sum(r["length"] for r in pieces if r["doc_id"] == k) for k in {r["doc_id"] for r in pieces}}) == Counter(
        {k: sum(r["doc_tokens"] for r in pieces if r["doc_id"] == k and r["start"] == 0) for k in {r["doc_id"] for r in pieces}}
    )
    assert Counter(r["doc_id"] for r in pieces if r["start"] == 0) == Counter(r[0] for r in steps[4].select("doc_id").collect())


def test_odd_tables_pass(spark, sf_dir, odd, nothing):
    for df in (odd, nothing):
        for name, stage in P.STAGES:
            df = keep(stage(spark, df, sf_dir), f"test-{name}")
    assert df.count() == 0


def test_copies_of_a_document_stay_whole(spark, sf_dir):
    """A third of a source are copies of one document, some with other blanks; one whole copy leaves the near-dedup stage."""
    copy = "\n".join(f"line {k} of the copied page says {k * 7919 % 1009} and {k * 31 % 97}" for k in range(8))
    texts = [copy] * 25 + [copy.replace("\n", " \n\n")] * 5
    texts += [f"own words {k} {k * k % 7907}\nshared footer\nmore of {k * 104729 % 99991} and {k}" for k in range(60)]
    given = spark.createDataFrame([(k, t, "en", "s", len(t)) for k, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    lines = keep(P.without_boilerplate(spark, given, sf_dir), "test-copies")
    assert {r["text"] for r in lines.where("doc_id < 30").collect()} == set(texts[:30])
    assert lines.where("text like '%shared footer%'").count() == 0
    left = P.one_of_each(spark, lines, sf_dir).where("doc_id < 30").collect()
    assert len(left) == 1 and left[0]["text"] in texts[:30]


def test_small_sites_lose_boilerplate(spark, sf_dir):
    """The ratio decides on small sites too: 4 of 4, 4 of 20 and 2 of 10 pages; a line of one page or of copies stays."""
    texts = [(s, f"{s} page {k} says {k * 7919 % 1009}" + ("\nfooter" if k < m else "")) for s, n, m in (("a", 4, 4), ("b", 20, 4), ("c", 10, 2), ("d", 10, 1), ("e", 50, 2)) for k in range(n)]
    texts += [("d", "d page 0 says 0\nfooter")] * 3
    given = spark.createDataFrame([(k, t, "en", s, len(t)) for k, (s, t) in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    out = P.without_boilerplate(spark, given, sf_dir).where("text like '%footer%'").groupBy("source").count().collect()
    assert {r["source"]: r["count"] for r in out} == {"d": 4, "e": 2}
