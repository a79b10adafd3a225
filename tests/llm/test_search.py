"""Decontamination, Jaccard join and chunk dedup against brute force."""

from __future__ import annotations

import random

import numpy as np
import pytest

from voxmill.llm import chunks, decontaminate, jaccard


def edit_distance_in(item, text):
    """Least edit distance of item to any stretch of text."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row)


@pytest.mark.parametrize("seed", range(8))
def test_myers(seed):
    r = random.Random(seed)
    item = "".join(r.choice("abc") for _ in range(r.randint(1, 80)))
    text = "".join(r.choice("abc") for _ in range(r.randint(0, 150)))
    want = edit_distance_in(item, text)
    got = decontaminate.myers(decontaminate.masks(item), len(item), text, len(item))
    assert (got[0] if got else len(item)) == min(want, len(item))


def test_pieces_cover():
    for n in (30, 31, 99):
        got = decontaminate.pieces("x" * n, 3)
        assert "".join(p for _, p in got) == "x" * n and len(got) == 4


def test_leaks_by_brute_force(spark, docs_of, prose):
    r = random.Random(5)
    items = [prose(100 + i, 12) for i in range(6)]
    rows = []
    for i in range(60):
        text = prose(i, r.randint(0, 60))
        if i % 3 == 0:
            leak = list(items[i % 6])
            for _ in range(r.randint(0, 9)):
                k = r.randrange(len(leak))
                leak[k] = r.choice(["", "zz", "q"])
            text = text + " " + "".join(leak).upper() + "\n\t " + text
        rows.append((i, text))
    bench = spark.createDataFrame([*enumerate(items), (7, None), (8, ""), (9, "no one has it")], "item_id long, text string")
    got = {(x.doc_id, x.item_id): x.n_edits for x in decontaminate.matches(docs_of(rows), bench).collect()}
    want = {}
    for i, text in rows:
        for j, item in enumerate(items):
            d = edit_distance_in(decontaminate.normal(item), decontaminate.normal(text))
            if d <= decontaminate.budget(decontaminate.normal(item)):
                want[i, j] = d
    assert got == want and len(want) >= 8
    in_blocks = decontaminate.matches(docs_of(rows), bench, block_chars=100)
    assert {(x.doc_id, x.item_id): x.n_edits for x in in_blocks.collect()} == want
    kept = decontaminate.without_leaks(docs_of(rows), bench)
    assert {x.doc_id for x in kept.collect()} == set(range(60)) - {i for i, _ in want}
    assert kept.columns == docs_of([]).columns


def test_short_items(spark, docs_of):
    """Below 30 characters an item counts as whole words without edits; one or two short words don't count."""
    bench = spark.createDataFrame([(1, "What is Zorb's law?"), (2, "a cat"), (3, "the law"), (4, "佐布定律是什么呢这是一个问题"), (5, "red or blue"), (6, "Unhexoctiumate")], "item_id long, text string")
    rows = [(1, "He asked: WHAT is\nzorb's law? twice: what is zorb's law?"), (2, "what is zorb's lawn"), (3, "the law of a cat"), (4, "他问佐布定律是什么呢这是一个问题吗"), (5, "bored or blue"), (6, "red or blue, unhexoctiumates"), (7, "what is zorbs law?"), (8, "unhexoctiumate")]
    got = {(x.doc_id, x.item_id, x.n_edits) for x in decontaminate.matches(docs_of(rows), bench).collect()}
    assert got == {(1, 1, 0), (4, 4, 0), (6, 5, 0), (8, 6, 0)}
    assert {x.doc_id for x in decontaminate.without_leaks(docs_of(rows), bench).collect()} == {2, 3, 5, 7}


def test_leaks_of_nothing(spark, docs_of):
    bench = spark.createDataFrame([(1, "a passage that is long enough to count")], "item_id long, text string")
    assert decontaminate.matches(docs_of([(None, None), (1, ""), (2, "x")]), bench).count() == 0
    assert decontaminate.matches(docs_of([]), bench).count() == 0
    assert decontaminate.matches(docs_of([(1, "x")]), bench.limit(0)).count() == 0
    assert decontaminate.without_leaks(docs_of([(1, None)]), bench).count() == 1


def near_copies(prose):
    r = random.Random(2)
    rows = []
    for g in range(12):
        base = prose(1000 + g, r.randint(30, 120)).split()
        for _ in range(r.randint(1, 12)):
            w = list(base)
            for _ in range(r.choice([0, 0, 1, 2, 3])):
                w[r.randrange(len(w))] = r.choice(["uu", "vv", "ww"])
            rows.append((len(rows), " ".join(w)))
    common = prose(77, 60)
    rows += [(len(rows) + i, f"{prose(500 + i, 40)} {common} {prose(900 + i, 40)}") for i in range(40)]
    return [*rows, (900, ""), (901, None), (902, "a b"), (903, "a  b\n"), (904, "a b c")]


def shingles(text):
    w = (text or "").split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


@pytest.mark.parametrize("leaf", [256, 8])
def test_links_by_brute_force(docs_of, prose, leaf):
    rows = near_copies(prose)
    sets = {i: shingles(t) for i, t in rows}
    near = {i: {j for j in sets if j != i and (sets[i] == sets[j] or 10 * len(sets[i] & sets[j]) >= 8 * len(sets[i] | sets[j]))} for i in sets}
    got = {x.doc_id: x for x in jaccard.similar_documents(docs_of(rows), leaf=leaf).collect()}
    assert {i: x.n_links for i, x in got.items()} == {i: len(n) for i, n in near.items()}
    seen = {}
    for i in sorted(sets):
        if i not in seen:
            todo = [i]
            while todo:
                j = todo.pop()
                if j not in seen:
                    seen[j] = i
                    todo += near[j]
    assert {i: x.class_id for i, x in got.items()} == seen
    assert sum(map(len, near.values())) > 100


def test_large_groups_of_near_copies(docs_of, prose):
    """Groups far over a leaf, each of another seed: a split may not lose rows from which the next run samples nothing."""
    r, rows, size = random.Random(8), [], {}
    for g, n in enumerate([300] * 24 + [600] * 8 + [2000]):
        base = prose(40_000 + g, 200).split()
        size[len(rows)] = n
        for i in range(n):
            w = list(base)
            w[r.randrange(len(w))] = f"edit{i}"
            rows.append((len(rows), " ".join(w)))
    got = {}
    for x in jaccard.similar_documents(docs_of(rows)).select("class_id", "n_links").collect():
        got.setdefault(x.class_id, []).append(x.n_links)
    assert {c: len(n) for c, n in got.items()} == size
    assert all(n == [size[c] - 1] * size[c] for c, n in got.items())


def by_rows(rows):
    """(doc_id, n_links, class_id) of each row by comparing all rows; ids may repeat."""
    sets = [shingles(t) for _, t in rows]
    near = [[j for j in range(len(rows)) if j != i and (a == sets[j] or 10 * len(a & sets[j]) >= 8 * len(a | sets[j]))] for i, a in enumerate(sets)]
    out = []
    for i, (doc, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            new = set(near[todo.pop()]) - seen
            seen |= new
            todo += new
        out.append((doc, len(near[i]), min(rows[j][0] for j in seen)))
    return out


@pytest.mark.parametrize("leaf", [256, 4])
def test_repeated_ids(docs_of, prose, leaf):
    a, b, c = prose(1, 60), prose(2, 60), prose(3, 60)
    rows = [(1, a), (1, b), (2, b + " x"), (3, a + " y"), (3, a + " y"), (4, c), (1, c + " z"), (5, a + " w"), (5, b + " w"), (1, "")]
    rows += [(6, f"{prose(4, 60)} v{i}") for i in range(9)]
    for given in (rows, rows[::-1]):
        got = jaccard.similar_documents(docs_of(given).repartition(3), leaf=leaf).collect()
        assert sorted((x.doc_id, x.n_links, x.class_id) for x in got) == sorted(by_rows(rows))
    kept = sorted((x.doc_id, x.text[:20]) for x in jaccard.keep_one(docs_of(rows)).collect())
    assert kept == sorted([(1, a[:20]), (1, b[:20]), (1, c[:20]), (1, ""), (6, prose(4, 60)[:20])])


def test_recall_where_buckets_split(docs_of, prose):
    """Pairs of similarity 0.8 to 0.85 among texts that share a passage, in buckets that are split at every level."""
    r, common, rows = random.Random(4), prose(60_000, 40), []
    for i in range(900):
        own = prose(61_000 + i, 80).split()
        rows.append((len(rows), " ".join([common, *own])))
        if i < 450:
            own[r.randrange(8, 12)] = own[r.randrange(68, 72)] = f"edit{i}"
            own[-1] = f"edit{i}"
            rows.append((len(rows), " ".join([common, *own])))
    sims = [len(shingles(rows[i][1]) & shingles(rows[i + 1][1])) / len(shingles(rows[i][1]) | shingles(rows[i + 1][1])) for i in range(0, 900, 2)]
    assert all(0.8 <= x <= 0.85 for x in sims)
    got = {x.doc_id: x.n_links for x in jaccard.similar_documents(docs_of(rows), leaf=8).collect()}
    assert sum(got[i] for i in range(900)) >= 0.99 * 900 and not any(got[i] for i in range(900, len(rows)))


def test_core_by_definition():
    """Sets of the core are similar to each other, whatever the middle is."""
    rng = np.random.default_rng(3)
    base = np.unique(rng.integers(0, 1 << 63, 120, dtype=np.uint64))
    sets = [np.unique(np.concatenate([rng.choice(base, len(base) - rng.integers(0, 14), replace=False), rng.integers(0, 1 << 63, rng.integers(0, 14), dtype=np.uint64)])) for _ in range(60)]
    for similarity in (0.8, 0.7, 0.95):
        core = [s for s in sets if jaccard.in_core(s, base, similarity)]
        assert jaccard.similar(core, similarity).sum() == len(core) * (len(core) - 1) and core
    assert not jaccard.in_core(base, base[:0], 0.8)


def test_one_of_each_class_stays(spark, docs_of, prose):
    text = prose(1, 50)
    df = docs_of([(4, text), (3, text), (3, text), (5, prose(2, 50)), (None, text), (6, None), (7, "")]).selectExpr("*", "1 AS class_id", "2 AS links")
    got = jaccard.keep_one(df)
    assert got.columns == df.columns
    assert sorted(str(x.doc_id) for x in got.collect()) == ["3", "5", "6", "None"]
    assert jaccard.keep_one(df.limit(0)).count() == 0


def test_empty_and_null_ids(docs_of):
    assert jaccard.similar_documents(docs_of([])).count() == 0
    got = {x.doc_id: (x.class_id, x.n_links) for x in jaccard.similar_documents(docs_of([(None, "x y"), (2, "x y"), (1, None)])).collect()}
    assert got == {None: (2, 1), 2: (2, 1), 1: (1, 0)}


def test_sampling_recall():
    rng = np.random.default_rng(1)
    missed = 0
    for _ in range(300):
        base = rng.integers(0, 1 << 63, 90, dtype=np.uint64)
        a, b = np.unique(np.concatenate([base[:80], base[80:85]])), np.unique(np.concatenate([base[:80], base[85:]]))  # 80 of 90 shared
        missed += not any(set(x.tolist()) & set(y.tolist()) for x, y in zip(jaccard.sampled(a), jaccard.sampled(b), strict=True))
    assert missed == 0


def test_gear_by_definition():
    data = np.frombuffer(bytes(range(40)), np.uint8)
    h = chunks.gear(data)
    for i in (0, 7, 39):
        assert h[i] == sum(int(chunks._GEAR[data[i - k]]) << k for k in range(min(chunks.WINDOW, i + 1))) % (1 << 32)


def test_chunks_make_up_the_text(prose):
    for text in ("", "  ", "a", "é ü\n ß", prose(1, 500), "same " * 300, "\n".join(prose(i, 3) for i in range(50))):
        data = text.encode()
        offsets, n = chunks.chunks(data)
        assert n.sum() == len(text.split()) and (n > 0).all()
        if len(n):
            assert offsets[0] == 0 and offsets[-1] == len(data) and (np.diff(offsets) > 0).all() and n.max() <= chunks.MAX_WORDS
            assert all(data[a:b].decode() for a, b in zip(offsets[:-1], offsets[1:], strict=True))


def test_chunks_resist_insertions(prose):
    text = prose(3, 400)
    before = set(chunks.digests(text.encode(), chunks.chunks(text.encode())[0]))
    w = text.split()
    moved = " ".join([*w[:200], "inserted", *w[200:]]).encode()
    after = set(chunks.digests(moved, chunks.chunks(moved)[0]))
    assert len(before - after) <= 4


def test_passages_are_found(docs_of, prose):
    passages = [prose(5000 + k, 51) for k in range(12)]
    rows = [(i, f"{prose(i, 70)}\n{passages[i % 12]} {prose(300 + i, 60)}") for i in range(36)]
    rows += [(100 + i, prose(2000 + i, 120)) for i in range(30)]
    rows += [(200, prose(9, 8)), (201, prose(9, 8)), (202, None), (203, ""), (None, passages[0])]
    got = chunks.repeated_passages(docs_of(rows)).collect()
    assert {x.doc_id for x in got} == set(range(12, 36))
    assert all(x.first_doc_id < x.doc_id and x.first_doc_id % 12 == x.doc_id % 12 for x in got)
    clean = {x.doc_id: x for x in chunks.without_repeats(docs_of(rows)).collect()}
    assert len(clean) == len(rows) and clean[202].text is None
    for i, text in rows:
        if i is not None and i not in range(12, 36):
            assert clean[i].text == text
    for i in range(12, 36):
        cut = rows[i][1].split()
        left = clean[i].text.split()
        assert left[:60] == cut[:60] and left[-50:] == cut[-50:] and len(cut) - len(left) >= 20 and clean[i].n_chars == len(clean[i].text)


def test_whole_copies_and_own_repeats(docs_of, prose):
    text = prose(1, 100)
    got = {x.doc_id: x.text for x in chunks.without_repeats(docs_of([(2, text), (1, text), (1, text), (3, f"{prose(2, 40)} {prose(2, 40)}")])).collect()}
    assert got[1] == text and got[2] == ""
    assert len(got[3].split()) < 60
    assert chunks.without_repeats(docs_of([])).count() == 0


def test_clashing_columns(docs_of, prose):
    text = prose(1, 100)
    df = docs_of([(2, text), (1, text)]).selectExpr("*", "5 AS _met", "6 AS _id", "7 AS pos")
    got = chunks.without_repeats(df)
    assert got.columns == df.columns and {x.doc_id: (x.text == text, x._met, x._id) for x in got.collect()} == {1: (True, 5, 6), 2: (False, 5, 6)}
