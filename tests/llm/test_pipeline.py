"""The pipeline's stages one after the other, against their own brute force, and the registered queries."""

from __future__ import annotations

import hashlib
from pathlib import Path

import pytest

import corpus_pipeline
from voxmill.llm import chunks, decontaminate, jaccard, pieces, registry, toxicity
from voxmill.llm.common import table

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="test tables are absent")
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def results(spark, tmp_path_factory):
    docs, out = table(spark, SF, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp(name) / "t")
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append({r.doc_id: r for r in docs.collect()})
        assert name == "piece_encoding" or docs.columns == COLUMNS
    return out


def test_stages(spark, results):
    docs = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    model = toxicity.fit(toxicity.train_rows(table(spark, SF, "documents"), table(spark, SF, "labels")))
    ids = list(docs)
    scores = dict(zip(ids, toxicity.evidences(model, [docs[i] or "" for i in ids])[0], strict=True))
    assert set(results[0]) == {i for i in ids if scores[i] < 0.7}

    sets = {i: set(jaccard.shingle_sets([r.text or ""])[0].tolist()) for i, r in results[0].items()}
    gone = {j for i in sets for j in sets if i < j and (sets[i] == sets[j] or 10 * len(sets[i] & sets[j]) >= 8 * len(sets[i] | sets[j]))}
    assert set(results[1]) == set(sets) - gone

    seen: set[bytes] = set()
    for i in sorted(results[1]):
        data = (results[1][i].text or "").encode()
        offsets, n = chunks.chunks(data)
        digests = chunks.digests(data, offsets)
        new = set(digests) - seen
        run, cut, own = [], [], set()
        for k, d in enumerate([*digests, None]):
            if d is not None and (d not in new or d in own):
                run.append(k)
            else:
                cut += run if sum(int(n[x]) for x in run) >= chunks.MIN_PASSAGE else []
                run = []
            own.add(d)
        want = b"".join(data[offsets[k] : offsets[k + 1]] for k in range(len(digests)) if k not in set(cut)) if len(digests) else data
        assert (results[2][i].text or "").encode() == want
        seen |= set(digests)

    items = [decontaminate.normal(r.text) for r in table(spark, SF, "benchmark").collect()]
    for i, r in results[2].items():
        text = decontaminate.normal(r.text)
        if any(x in text for x in items):
            assert i not in results[3]
    assert len(results[3]) > 0.9 * len(results[2])

    v = pieces.vocabulary(pieces.model_path())
    assert set(results[4]) == set(results[3])
    for i, r in results[4].items():
        found = v.encode(results[3][i].text or "")
        assert (r.n_tokens, r.ids_sha256) == (len(found), hashlib.sha256(",".join(map(str, found)).encode()).hexdigest())


def test_run_is_the_stages(spark, results):
    got = {r.doc_id: r.ids_sha256 for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == {i: r.ids_sha256 for i, r in results[-1].items()}


def test_registered():
    import __spark_entry__ as e

    assert set(registry.QUERIES) <= set(e.queries()) and "pipeline" in e.queries()
    assert {int(n[2:].split("_")[0]) for n in registry.QUERIES} == set(range(1, 11))


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_matches_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    df = registry.QUERIES[name](spark, SF)
    answer = con.execute(registry.ORACLE[name])
    names = [c[0] for c in answer.description]
    assert sorted(names) == sorted(df.columns)
    assert sorted(tuple(r[c] for c in names) for r in df.collect()) == sorted(answer.fetchall())


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_queries_run(spark, name):
    assert registry.QUERIES[name](spark, SF).count() > 0
