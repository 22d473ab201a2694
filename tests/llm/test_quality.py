"""Document quality: classes of clear pages, Viterbi against brute force, odd texts."""

from __future__ import annotations

import itertools
import random

import numpy as np
import pytest

from wayledger.llm import quality as q

FILL = "the captain of a ship said that coffee and cotton came to market in winter while people on the river were told of the new bridge by a doctor from our village".split()


def prose(rnd, n=20):
    return "\n".join(" ".join(rnd.choice(FILL) for _ in range(7)) + rnd.choice(["", "", ".", ","]) for _ in range(n))


def listing(rnd, n=20):
    return "\n".join(f"{k}. {rnd.choice(FILL)} {rnd.choice(FILL)}" for k in range(1, n))


def names(rnd, n=20):
    return "\n".join(f"{rnd.choice(FILL).title()}ton, {rnd.choice('ABC')}." for _ in range(n))


def tabled(rnd, n=20):
    return "\n".join(f"{rnd.choice(FILL):10}  " + "   ".join(f"{rnd.random() * 100:5.2f}" for _ in range(4)) for _ in range(n))


def junk(rnd, n=20):
    return "\n".join("".join(rnd.choice("#%&*+=<>|~^■□•§°") for _ in range(30)) for _ in range(n))


@pytest.fixture(scope="module")
def pages():
    rnd = random.Random(4)
    kinds = {"prose": prose, "list": listing, "table": tabled, "junk": junk}
    rows = [(k, kind, kinds[kind](rnd)) for k, kind in enumerate(["prose"] * 120 + ["list", "table", "junk"] * 12)]
    rows += [(900 + k, "list", names(rnd)) for k in range(6)]
    return rows


def test_classes(spark, pages):
    odd = [(1000, "", None), (1001, "", ""), (1002, "", " \n\t \n"), (1002, "", " \n\t \n")]
    df = spark.createDataFrame([(i, t, 1.0, "x") for i, _, t in pages + odd], "doc_id long, text string, n_lines double, word string")
    got = q.document_quality(df)
    found = {r.doc_id: r.doc_class for r in q.not_prose(got).collect()}
    want = {i: kind for i, kind, _ in pages if kind != "prose"}
    assert found == want
    rows = [r for r in got.collect() if r.doc_id >= 1000]
    assert len(rows) == 4 and all(r.n_lines == 0 and r.prose_share is None for r in rows)


def test_empty_and_one(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert q.document_quality(empty).count() == 0 and q.not_prose(q.document_quality(empty)).count() == 0
    one = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    assert q.document_quality(one).count() == 1


def test_a_very_long_text(spark, pages):
    rnd = random.Random(1)
    df = spark.createDataFrame([(i, t) for i, _, t in pages] + [(5000, tabled(rnd, 30_000))], "doc_id long, text string")
    assert {r.doc_id: r.doc_class for r in q.not_prose(q.document_quality(df)).collect()}[5000] == "table"


def test_statistics():
    s = q.line_statistics(["Ab cd.\n\n12  x\n", "", "É-1"], {"ab", "cd"})
    assert s.doc.tolist() == [0, 0, 2]
    c = s.cols
    assert c["words"].tolist() == [2, 1, 1] and c["letters"].tolist() == [4, 1, 1] and c["known"].tolist() == [2, 0, 0]
    assert c["end_mark"].tolist() == [1, 0, 0] and c["gaps"].tolist() == [0, 1, 0] and c["figures"].tolist() == [0, 1, 1]
    assert c["capital"].tolist() == [1, 0, 1]


def test_viterbi_by_brute_force():
    rnd = np.random.default_rng(0)
    k = len(q.LABEL_OF)
    emit = tuple(np.log(rnd.dirichlet(np.ones(b), k)) for b in q.BINS.values())
    model = q.LineModel(np.log(np.full(k, 1 / k)), np.log(rnd.dirichlet(np.ones(k), k)), emit)
    sizes = [1, 4, 2, 3]
    f = np.stack([rnd.integers(0, b, sum(sizes)) for b in q.BINS.values()], 1)
    doc = np.repeat(np.arange(4), sizes)
    got, score, at = model.label(f, doc), model.scores(f), 0
    for n in sizes:
        best = max(itertools.product(range(k), repeat=n), key=lambda p: model.start[p[0]] + sum(score[at + i, x] for i, x in enumerate(p)) + sum(model.move[a, b] for a, b in itertools.pairwise(p)))
        assert got[at : at + n].tolist() == list(best)
        at += n
    assert model.label(f[:0], doc[:0]).tolist() == []


def test_the_sample_is_the_least_hashes_whatever_the_partitions(spark):
    rows_in = [(i, "" if i % 3 else f"text number {i}" + (" long" * 50 if i % 5 == 0 else "")) for i in range(900)]
    docs = spark.createDataFrame(rows_in, "doc_id long, text string")
    docs = docs.unionByName(docs.where("doc_id = 6"))  # a repeated row counts once
    rules = q.QualityRules(sample_docs=40, sample_chars=100)
    got = [q.sample_texts(docs.repartition(n), rules) for n in (1, 7)]
    assert got[0] == got[1] and len(got[0][0]) == 40 and got[0][1] == 301
    every = q.sample_texts(docs, q.QualityRules(sample_docs=10_000, sample_chars=100))[0]
    assert len(every) == 240 and max(map(len, every)) <= 100 and set(got[0][0]) <= set(every)
    assert q.sample_texts(docs.where("false"), rules) == ([], 0)
