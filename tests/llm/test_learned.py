"""Quality rules, quality classifier and toxicity: statistics against brute force, held-out accuracy, odd rows."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

from voxmill.llm import rules, subwords, toxicity
from voxmill.llm import textvec as tv
from voxmill.llm.common import table

SF = "/root/testdata/sf0.1"
needs_tables = pytest.mark.skipif(not Path(SF).exists(), reason="test tables are absent")
SPACE = "\x20\x09\x0a\x0b\x0c\x0d"


def statistics(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if line.strip(SPACE):
            dup += line in seen
            seen.add(line)
    windows = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    covered = {p for i in range(len(w) - 7) if windows[tuple(w[i : i + 8])] > 1 for p in range(i, i + 8)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)


def test_statistics_by_brute_force(spark, docs_of):
    r = random.Random(3)
    rows = [(0, None), (1, ""), (2, " \n\t\x0b\x0c\r "), (3, "a\x0cb\x0bc\rd e"), (4, "😀# é\n😀# é\n\n \n"), (5, "x " * 30), (6, "  　a b"), (7, "x y " * 4 + "z")]
    rows += [(10 + i, "".join(r.choice(["a ", "b ", "c\n", "#", "é", " ", "\t", "ab "]) for _ in range(r.randint(0, 120)))) for i in range(150)]
    got = {x.doc_id: x for x in rules.statistics(docs_of(rows)).collect()}
    for i, t in rows:
        x = got[i]
        assert (x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words) == statistics(t), (i, t)


def test_rules_native(spark, docs_of):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(300)], "doc_id long, quality int, toxic int")
    df = docs_of([(i, " ".join(f"w{i}x{k}" + ("" if i % 2 else "***") for k in range(30))) for i in range(300)])
    out = rules.filtered(df, labels)
    assert not re.search("Python|Pandas|Arrow", out._jdf.queryExecution().toString())
    assert all(x.kept == bool(x.doc_id % 2) and not x.base_failed for x in out.collect())


def test_rules_without_labels(spark, docs_of):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = rules.filtered(docs_of([(1, "w " * 19), (2, " ".join(f"w{k}" for k in range(20))), (3, None), (None, "")]), none).collect()
    assert {(x.doc_id, x.base_failed, x.kept) for x in got} == {(1, True, False), (2, False, True), (3, True, False), (None, True, False)}
    nulls = spark.createDataFrame([(2, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    assert rules.filtered(docs_of([]), nulls).count() == 0


@needs_tables
def test_rules_on_labels(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    got = rules.filtered(docs, labels).join(labels, "doc_id").where("NOT base_failed").toPandas()
    assert got[got.quality == 1].kept.mean() > 0.99 and got[got.quality == 0].kept.mean() < 0.1


def test_features_by_definition():
    ids, doc = subwords.features(["Ab  cd\ncd", "", "x"])
    assert Counter(doc.tolist())[1] == 0
    # " ab ": runs of 3 (" ab", "ab ") and 4; " x ": one of 3; words, pairs and the repeat of cd
    n = Counter(doc.tolist())
    assert n[2] == 1 + 1 and n[0] == 3 + 3 * (2 + 1) + 2 + 1
    assert (ids[doc == 0] == subwords.REPEAT).sum() >= 1
    again, owner = subwords.features(["zz", "Ab  cd\ncd"])
    assert sorted(again[owner == 1].tolist()) == sorted(ids[doc == 0].tolist())


@needs_tables
@pytest.mark.parametrize("op, label, folds, held, cut", [(subwords, "quality", 5, 0, 0.3), (toxicity, "toxic", 3, 1, 0.7)])
def test_held_out_accuracy(spark, op, label, folds, held, cut):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    model = op.fit(docs, labels) if op is subwords else op.fit(op.train_rows(docs, labels))
    got = op.score(docs, model).join(labels, "doc_id").toPandas()
    out = got[[zlib.crc32(str(i).encode()) % folds == held for i in got.doc_id]]
    assert ((out.score >= cut) == (out[label] == 1)).mean() > 0.97
    assert out.score.between(0, 1).all()


@pytest.mark.parametrize("op, column", [(subwords, "quality"), (toxicity, "toxic")])
def test_odd_rows(spark, docs_of, op, column):
    df = docs_of([(1, None), (2, ""), (2, "a b"), (None, "x"), (3, "word " * 50_000), (4, "😀".encode("utf-16", "surrogatepass").decode("utf-16"))])
    for rows in ([], [(2, 1, 1)], [(2, 1, 0), (3, 0, 1), (3, 0, 1), (None, 1, 1), (4, None, None)]):
        labels = spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
        model = op.fit(df, labels) if op is subwords else op.fit(op.train_rows(df, labels))
        got = op.score(df, model).collect()
        assert len(got) == 6 and all(0 <= x.score <= 1 for x in got)
        assert op.score(docs_of([]), model).count() == 0


def test_labels_stay_outside_the_held_out_fold(spark, docs_of):
    ids = list(range(60))
    labels = spark.createDataFrame([(i, 1, 1) for i in ids], "doc_id long, quality int, toxic int")
    df = docs_of([(i, str(i)) for i in ids])
    got = {int(x.text) for x in toxicity.train_rows(df, labels).collect()}
    assert got == {i for i in ids if zlib.crc32(str(i).encode()) % 3 != 1}


def maximal(scores):
    """All maximal scoring segments by definition: take the best one (the longest of the leftmost), then go on at either side."""
    best = None
    for i in range(len(scores)):
        total = 0.0
        for j in range(i, len(scores)):
            total += scores[j]
            if total > 1e-12 and (best is None or total > best[0] + 1e-12):
                best = (total, i, j + 1)
    if best is None:
        return []
    _, a, b = best
    return maximal(scores[:a]) + [best] + [(s, x + b, y + b) for s, x, y in maximal(scores[b:])]


@pytest.mark.parametrize("seed", range(30))
def test_segments_by_definition(seed):
    r = np.random.default_rng(seed)
    scores = np.round(r.normal(-0.2, 1, r.integers(0, 40)), 3)
    got = [(round(s, 6), a, b) for s, a, b in toxicity.segments(scores)]
    assert got == [(round(s, 6), a, b) for s, a, b in maximal(scores.tolist())]


def test_lambda_solves_its_equation():
    values, p = np.array([-1.0, 2.0]), np.array([0.8, 0.2])
    lam = toxicity.karlin_lambda(values, p)
    assert (p * np.exp(lam * values)).sum() == pytest.approx(1, abs=1e-6) and lam > 0.1
    assert toxicity.karlin_lambda(np.array([1.0]), np.array([1.0])) == 1.0


def test_logistic():
    x = np.linspace(-3, 3, 200)
    slope, offset = toxicity.logistic(x, (x > 1).astype(float), np.ones(200))
    assert slope > 2 and -offset / slope == pytest.approx(1, abs=0.2)
    assert toxicity.logistic(x, np.ones(200), np.ones(200)) == (1.0, 0.0)


def test_toxic_ones_go(spark, docs_of, prose):
    bad = ["vile", "foul", "awful"]
    rows = [(i, prose(i, 60) + (" " + " ".join(bad) if i % 4 == 0 else "")) for i in range(600)]
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(600)], "doc_id long, quality int, toxic int")
    df = docs_of([*rows, (700, None), (701, "")]).selectExpr("*", "0 AS score", "1 AS label")
    got = toxicity.without_toxic(df, labels)
    assert got.columns == df.columns
    left = {x.doc_id for x in got.collect()}
    assert left == {i for i in range(600) if i % 4} | {700, 701}
    spans = {x.doc_id: x for x in toxicity.score(docs_of(rows), toxicity.fit(toxicity.train_rows(df, labels))).collect()}
    assert rows[0][1][spans[0].best_start : spans[0].best_end].split()[-3:] == bad


def test_hashes_depend_on_the_slice_alone():
    points, starts = tv.code_points(["ab ab", "xab", ""])
    h = tv.Hasher(points)
    assert h(np.array([0]), np.array([2]))[0] == h(np.array([3]), np.array([5]))[0] == h(np.array([7]), np.array([9]))[0] != h(np.array([6]), np.array([8]))[0]
    assert starts.tolist() == [0, 6, 10, 11]
