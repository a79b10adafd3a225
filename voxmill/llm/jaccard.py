"""N-gram Jaccard self-join by chosen paths (operator 3).

A document is its set of five-word shingles. Each of RUNS independent runs samples about BRANCH of its shingles by a hash that all
documents share; documents meet in the bucket of a sampled shingle. A bucket of over LEAF documents is split again, up to LEVELS - 1
times: each document goes on with the shingles that are least under SPLIT hashes of that run and level, of which every
document has some, so that no split drops one. Small buckets are brute-forced on sketches of 64 minima, whose loose threshold only
forms candidate groups.

Large groups of near copies can't be split, as they share what is sampled. So each large bucket is first held against PIVOTS
of its documents: those alike to a pivot form a star. If at most LEAF are left, or no level is, these are compared with the whole bucket, in
blocks, and the bucket is done. No bucket is capped, and work grows with the square of what is alike to no pivot after all splits alone.

Within the candidate groups every pair counts exactly. In a group of over LEAF sets let R be any set, and the cost of a member
S be 5 |R - S| + 4 |S - R|. Two members whose costs add up to at most |R| have a similarity of 0.8 or more, so the links among
those of a cost up to |R| / 2 are known without a comparison. The others are compared with the whole group, in blocks. R holds
the shingles of most of up to CENTRE members; links don't depend on it.

Two sets of similarity 0.8 miss each other in one run with probability 0.33 if they are of one size and 0.37 if one holds the other, and in
each split with 0.04, so in all runs with 1.5e-5 and 4.5e-5 where their buckets are small, and with 1e-4 and 2e-4 where they are
large at every level.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxmill.llm import textvec as tv
from voxmill.llm.common import by_key, cut, small_batches, spread, table, texts_of, unused, whole_groups
from voxmill.operators.graph import components

WORDS = 5
SIMILARITY = 0.8
RUNS = 10
BRANCH = 1.25
LEVELS = 4
#: Rows that one task takes at least, of sets and of large buckets.
ROWS = 20_000
#: Minima of each run and level that a document of a large bucket goes on with.
SPLIT = 2
#: Documents of a bucket or block that one brute-force step compares.
LEAF = 256
#: Documents of a large bucket that all others are held against.
PIVOTS = 8
#: Members of a large group that its middle is made of.
CENTRE = 15
SKETCH = 64
#: Equal minima that make a candidate: at similarity 0.8, 38 or more of 64 with probability 0.99999.
SKETCH_HITS = 38

_rng = np.random.default_rng(20_011)
_RUN = _rng.integers(1, 1 << 63, RUNS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MINIMA = _rng.integers(1, 1 << 63, SKETCH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEPS = _rng.integers(1, 1 << 63, WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(texts: list[str]) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's runs of five words; a shorter text is one run, an empty one none."""
    points, starts = tv.code_points(texts)
    first, end, doc = tv.word_spans(points, starts, ~tv.is_space_point(points))
    words = tv.Hasher(points)(first, end)
    n = len(words)
    edges = np.searchsorted(doc, np.arange(len(texts) + 1))
    run = np.zeros(max(n - WORDS + 1, 0), dtype=np.uint64)
    for k in range(WORDS):
        run += words[k : k + len(run)] * _STEPS[k]
    run = tv.mix(run)
    out = []
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        if b - a >= WORDS:
            out.append(np.unique(run[a : b - WORDS + 1]))
        elif b > a:
            out.append(tv.mix((words[a:b] * _STEPS[: b - a]).sum(dtype=np.uint64, keepdims=True) + np.uint64(b - a)))
        else:
            out.append(run[:0])
    return out


def sampled(tokens: np.ndarray) -> list[np.ndarray]:
    """For each run, the hashes of the shingles that it samples from a set."""
    limit = BRANCH / max(len(tokens), 1)
    if limit >= 1:
        return [tokens * m for m in _RUN]
    top = np.uint64(int(limit * 2**64))
    hashed = tokens[None, :] * _RUN[:, None]
    return [h[h < top] for h in hashed]


def minima(tokens: np.ndarray) -> np.ndarray:
    """The least hash under each of 64 functions, mixed to 32 bits."""
    if not len(tokens):
        return np.zeros(SKETCH, dtype=np.uint32)
    least = np.empty(SKETCH, dtype=np.uint64)
    for a in range(0, SKETCH, 16):
        least[a : a + 16] = (tokens[None, :] * _MINIMA[a : a + 16, None]).min(axis=1)
    return tv.mix(least).astype(np.uint32)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small_batches(batches, "text"):
        digest, sketches, splits, keys = [], [], [], []
        for tokens in shingle_sets(texts_of(batch)):
            least = minima(tokens)
            digest.append(hashlib.blake2b(tokens.tobytes(), digest_size=16).digest())
            sketches.append(least.astype(np.uint8).tobytes())
            splits.append(least[: RUNS * (LEVELS - 1) * SPLIT].tobytes())
            keys.append([x.view(np.int64).tolist() for x in sampled(tokens)] if len(tokens) else [])
        yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "text_hash": batch.column("text_hash"), "digest": digest, "sketch": sketches, "splits": splits, "keys": pa.array(keys, pa.list_(pa.list_(pa.int64())))})


def _labels(near: np.ndarray) -> np.ndarray:
    """For each row of a symmetric adjacency matrix, the least index of its component."""
    n = len(near)
    near = near | np.eye(n, dtype=bool)
    labels = np.arange(n)
    while True:
        new = np.where(near, labels[None, :], n).min(axis=1)
        if (new == labels).all():
            return labels
        labels = new


def _candidate_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stars over the components of alike sketches in each bucket."""
    for batch in whole_groups(batches, ["path", "part"]):
        path, part, ids = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("path", "part", "sid"))
        rows = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), dtype=np.uint8).reshape(-1, SKETCH)
        new = np.flatnonzero(np.concatenate(([True], (path[1:] != path[:-1]) | (part[1:] != part[:-1]), [True])))
        size = np.diff(new)
        u, v = [], []
        two = new[:-1][size == 2]
        hit = two[(rows[two] == rows[two + 1]).sum(axis=1) >= SKETCH_HITS]
        u.append(ids[hit])
        v.append(ids[hit + 1])
        for a, n in zip(new[:-1][size > 2].tolist(), size[size > 2].tolist(), strict=True):
            r, own = rows[a : a + n], ids[a : a + n]
            near = np.empty((n, n), dtype=bool)
            for i in range(0, n, 64):
                near[i : i + 64] = (r[i : i + 64, None, :] == r[None, :, :]).sum(axis=2, dtype=np.uint8) >= SKETCH_HITS
            root = own[_labels(near)]
            other = root != own
            u.append(own[other])
            v.append(root[other])
        u, v = np.concatenate(u), np.concatenate(v)
        pairs = np.unique(np.stack([np.maximum(u, v), np.minimum(u, v)], axis=1), axis=0) if len(u) else np.zeros((0, 2), dtype=np.int64)
        yield pa.RecordBatch.from_pydict({"u": pairs[:, 0], "v": pairs[:, 1]})


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each row of a large bucket the first pivot that it is alike to, null if there is none."""
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), dtype=np.uint8).reshape(-1, SKETCH)
        pivots = batch.column("pivots").to_pylist()
        owner = np.repeat(np.arange(len(rows)), [len(p) for p in pivots])
        flat = np.frombuffer(b"".join([x["sketch"] for p in pivots for x in p]), dtype=np.uint8).reshape(-1, SKETCH)
        ids = np.array([x["sid"] for p in pivots for x in p], dtype=np.int64)
        hit = np.flatnonzero((rows[owner] == flat).sum(axis=1) >= SKETCH_HITS)
        # the first of each row's hits
        owners, first = np.unique(owner[hit], return_index=True)
        star, found = np.zeros(len(rows), dtype=np.int64), np.zeros(len(rows), dtype=bool)
        star[owners], found[owners] = ids[hit[first]], True
        yield pa.RecordBatch.from_pydict({**{c: batch.column(c) for c in ("path", "run", "sid", "place", "n")}, "star": pa.array(star, mask=~found)})


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small_batches(batches, "text"):
        data = [t.tobytes() for t in shingle_sets(texts_of(batch))]
        yield pa.RecordBatch.from_pydict({**{c: batch.column(c) for c in ("sid", "component", "n", "copies", "place")}, "tokens": pa.array(data, pa.binary())})


def _middles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The shingles that over half of a group's chosen members have."""
    for batch in batches:
        out = []
        for i in range(batch.num_rows):
            sets = [np.frombuffer(x, dtype=np.uint64) for x in batch.column("chosen")[i].as_py()]
            token, count = np.unique(np.concatenate(sets), return_counts=True)
            out.append(token[2 * count > len(sets)].tobytes())
        yield pa.RecordBatch.from_pydict({"component": batch.column("component"), "middle": pa.array(out, pa.binary())})


def in_core(tokens: np.ndarray, middle: np.ndarray, similarity: float) -> bool:
    """Whether a set is so close to `middle` that it is similar to every other such set."""
    p, q = Fraction(round(similarity * 1_000_000), 1_000_000).as_integer_ratio()
    common = len(np.intersect1d(tokens, middle, assume_unique=True))
    return len(middle) > 0 and 2 * (q * (len(middle) - common) + p * (len(tokens) - common)) <= (q - p) * len(middle)


def _costs(similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            core = [in_core(np.frombuffer(t, dtype=np.uint64), np.frombuffer(m, dtype=np.uint64), similarity) for t, m in zip(batch.column("tokens").to_pylist(), batch.column("middle").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_pydict({**{c: batch.column(c) for c in ("component", "sid", "copies")}, "core": pa.array(core, pa.bool_())})

    return run


def similar(sets: list[np.ndarray], similarity: float = SIMILARITY) -> np.ndarray:
    """Matrix of the pairs whose exact Jaccard similarity reaches the threshold; the diagonal is false."""
    n = len(sets)
    size = np.array([len(s) for s in sets], dtype=np.int64)
    common = np.zeros((n, n), dtype=np.float32)
    if n <= 4:
        for i in range(n):
            for j in range(i):
                common[i, j] = common[j, i] = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
    else:
        token = np.concatenate(sets)
        owner = np.repeat(np.arange(n), size)
        _, where, df = np.unique(token, return_inverse=True, return_counts=True)
        often = df > 1
        column = np.cumsum(often) - 1
        use = often[where]
        column, owner = column[where[use]], owner[use]
        order = np.argsort(column, kind="stable")
        column, owner = column[order], owner[order]
        width, total = 4096, int(often.sum())
        for a in range(0, total, width):
            lo, hi = np.searchsorted(column, [a, a + width])
            block = np.zeros((n, min(width, total - a)), dtype=np.float32)
            block[owner[lo:hi], column[lo:hi] - a] = 1
            common += block @ block.T
    union = size[:, None] + size[None, :] - common
    # in whole numbers, so that a pair at the threshold counts
    near = (common.astype(np.int64) * 1_000_000 >= round(similarity * 1_000_000) * union.astype(np.int64)) & (union > 0)
    np.fill_diagonal(near, False)
    return near


def _exact(similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per member of each pair of blocks: documents that it is linked to there, and the least member that links lead to."""
        for batch in whole_groups(batches, ["component", "part"]):
            group = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("component", "part")], axis=1)
            ids, block, copies, cross = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("sid", "block", "copies", "cross"))
            tokens = batch.column("tokens")
            new = np.flatnonzero(np.concatenate(([True], (group[1:] != group[:-1]).any(axis=1), [True]))).tolist()
            links, root = np.zeros(len(ids), dtype=np.int64), ids.copy()
            for a, b in zip(new[:-1], new[1:], strict=True):
                near = similar([np.frombuffer(tokens[i].as_py(), dtype=np.uint64) for i in range(a, b)], similarity)
                if cross[a]:
                    near &= block[a:b, None] != block[None, a:b]
                links[a:b] = near @ copies[a:b]
                root[a:b] = ids[a:b][_labels(near)]
            yield pa.RecordBatch.from_pydict({"sid": ids, "links": links, "root": root})

    return run


def _blocks(rows: DataFrame, key: str, leaf: int) -> DataFrame:
    """Rows (key, place, n, rest and others) of groups of any size, dealt into the pairs of their blocks that hold a row with `rest`.

    A group of up to `leaf` rows is one block. The others have blocks of about half as many: the first ones for the rows with
    `rest`, the ones behind for the rows without, which meet the first ones alone. part names the pair, block the row's own, and
    cross says that rows of one block aren't to be compared there.
    """
    whole = rows.where(F.col("n") <= leaf).withColumns({"part": F.lit(0).cast("long"), "block": F.lit(0).cast("long"), "cross": F.lit(False)})
    large = rows.where(F.col("n") > leaf)
    sizes = large.groupBy(key).agg(F.count(F.when(F.col("rest"), 1)).alias("rests")).where("rests > 0")
    first = F.ceil(F.col("rests") * 2 / leaf).cast("long")
    many = first + F.ceil((F.col("n") - F.col("rests")) * 2 / leaf).cast("long")
    # another hash than the one that deals rows out to tasks
    dealt = F.xxhash64(F.lit("block"), "place")
    block = F.when(F.col("rest"), F.pmod(dealt, F.col("first"))).otherwise(F.col("first") + F.pmod(dealt, F.greatest(F.col("many") - F.col("first"), F.lit(1))))
    pairs = large.join(sizes, key).withColumns({"first": first, "many": many}).withColumn("block", block)
    pairs = pairs.withColumn("other", F.explode(F.sequence(F.lit(0), F.when(F.col("rest"), F.col("many")).otherwise(F.col("first")) - 1)))
    part = F.least("block", "other") * F.col("many") + F.greatest("block", "other")
    pairs = pairs.withColumn("part", part).withColumn("cross", F.col("block") != F.col("other"))
    # in the part of two blocks every row is cross, in that of a block with itself none
    return whole.unionByName(pairs.drop("first", "many", "other", "rests"))


def tasks_for(rows: int) -> int:
    return max(1, -(-rows // ROWS))


def few(df: DataFrame) -> DataFrame:
    """A table that was written down, in tasks of ROWS rows or more."""
    return df.coalesce(tasks_for(df.count()))


def _held_against_pivots(large: DataFrame, reps: DataFrame, tasks: int, with_reps: int) -> DataFrame:
    """(path, run, sid, place, n, star) of the rows of large buckets (path, run, sid, place, n): star is a pivot that a row is alike to, or null."""
    rows = large.join(reps.select("sid", "sketch"), "sid").coalesce(with_reps)
    # the same in every bucket, so that buckets of about the same documents have the same pivots and stars
    at = F.xxhash64(F.lit("pivot"), "place")
    chosen = rows.groupBy("path", F.pmod(at, F.lit(PIVOTS)).alias("nth")).agg(F.min(F.struct(at.alias("at"), "sid", "sketch")).alias("x")).coalesce(tasks)
    pivots = chosen.groupBy("path").agg(F.sort_array(F.collect_list("x")).alias("x")).coalesce(tasks).select("path", F.transform("x", lambda x: F.struct(x["sid"].alias("sid"), x["sketch"].alias("sketch"))).alias("pivots"))
    met = rows.join(pivots, "path").coalesce(with_reps)
    return met.select("path", "run", "sid", "place", "n", "sketch", "pivots").mapInArrow(_stars, "path long, run int, sid long, place long, n long, star long")


def _candidates(reps: DataFrame, leaf: int) -> DataFrame:
    """Edges (u, v) between sets whose sketches are alike in some bucket: stars of large buckets, and what blocks give.

    What is left to split may be little, in as many parts as all had, so each level takes tasks by its number of rows; a join with all sets
    takes as many as these need.
    """
    for_reps = tasks_for(reps.count())
    lists = reps.select("sid", "place", F.posexplode("keys").alias("run", "own"))
    rows = lists.select("sid", "place", "run", F.explode("own").alias("key")).select("sid", "place", "run", F.xxhash64("run", "key").alias("path")).distinct()
    found, edges = [], []
    for level in range(1, LEVELS + 1):
        counts = rows.groupBy("path").agg(F.count("*").alias("n")).where("n > 1")
        if level == 1:
            met = rows.join(counts, "path")
            large = cut(met.where(F.col("n") > leaf))
        else:
            met = cut(rows.join(counts.coalesce(tasks), "path").coalesce(tasks))
            large = met.where(F.col("n") > leaf)
        found.append(met.where(F.col("n") <= leaf).select("path", F.lit(0).cast("long").alias("part"), "sid"))
        n_rows = large.count()
        if not n_rows:
            break
        tasks = tasks_for(n_rows)
        with_reps = max(tasks, for_reps)
        stars = cut(_held_against_pivots(large.coalesce(tasks), reps, tasks, with_reps))
        edges.append(stars.where("star != sid").select(F.col("sid").alias("u"), F.col("star").alias("v")))
        left = stars.groupBy("path").agg(F.count(F.when(F.col("star").isNull(), 1)).alias("left")).coalesce(tasks)
        stars = stars.join(left, "path").coalesce(tasks).withColumn("rest", F.col("star").isNull())
        done = F.lit(True) if level == LEVELS else F.col("left") <= leaf
        found.append(_blocks(stars.where(done).select("path", "sid", "place", "n", "rest"), "path", leaf).select("path", "part", "sid"))
        if level == LEVELS:
            break
        nth = F.explode(F.sequence(F.lit(0), F.lit(SPLIT - 1)))
        on = stars.where(~done).select("path", "run", "sid", "place").join(reps.select("sid", "splits"), "sid").coalesce(with_reps).withColumn("nth", nth)
        key = F.substring("splits", ((F.col("run") * (LEVELS - 1) + level - 1) * SPLIT + F.col("nth")) * 4 + 1, F.lit(4))
        rows = on.select("sid", "place", "run", F.xxhash64("path", "nth", key).alias("path")).distinct().coalesce(tasks)
    leaves = found[0]
    for more in found[1:]:
        leaves = leaves.unionByName(more)
    pairs = by_key(leaves.join(reps.select("sid", "sketch"), "sid").select("path", "part", "sid", "sketch"), "path", "part").mapInArrow(_candidate_edges, "u long, v long")
    for more in edges:
        pairs = pairs.unionByName(more)
    return pairs


def _links(members: DataFrame, similarity: float, leaf: int) -> DataFrame:
    """(sid, links, class) by exact similarity within the groups of members (sid, component, n, copies, place, tokens)."""
    schema = "sid long, links long, root long"
    compare = lambda rows: by_key(rows.select("component", "part", "block", "cross", "sid", "copies", "tokens"), "component", "part").mapInArrow(_exact(similarity), schema)
    few = members.where(F.col("n") <= leaf).withColumn("rest", F.lit(True))
    # a group of one block is compared at once, so its roots are its classes
    out = compare(_blocks(few, "component", leaf)).withColumnRenamed("root", "class")
    many = cut(members.where(F.col("n") > leaf))
    if many.isEmpty():
        return out
    chosen = many.groupBy("component", F.pmod(F.xxhash64(F.lit("centre"), "place"), F.lit(CENTRE)).alias("nth")).agg(F.min_by("tokens", "place").alias("tokens"))
    middles = chosen.groupBy("component").agg(F.collect_list("tokens").alias("chosen")).mapInArrow(_middles, "component long, middle binary")
    costs = cut(many.join(middles, "component").select("component", "sid", "copies", "tokens", "middle").mapInArrow(_costs(similarity), "component long, sid long, copies long, core boolean"))
    core = costs.where("core")
    sums = core.groupBy("component").agg(F.sum("copies").alias("all"), F.min("sid").alias("root"))
    known = core.join(sums, "component").select("sid", (F.col("all") - F.col("copies")).alias("links"), "root")
    rest = many.join(costs.select("sid", (~F.col("core")).alias("rest")), "sid")
    found = cut(known.unionByName(compare(_blocks(rest, "component", leaf))))
    links = found.groupBy("sid").agg(F.sum("links").alias("links"))
    classes = components(found.select(F.col("sid").alias("u"), F.col("root").alias("v"))).select(F.col("id").alias("sid"), F.col("component").alias("class"))
    return out.unionByName(links.join(classes, "sid", "left").select("sid", "links", F.coalesce("class", "sid").alias("class")))


def _classes(docs: DataFrame, similarity: float, leaf: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, text_hash, digest) of each row of docs, and (digest, sid, set_id, copies, links, class) of each set."""
    hashed = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    features = cut(hashed.mapInArrow(_features, "doc_id long, text_hash long, digest binary, sketch binary, splits binary, keys array<array<bigint>>"))
    # the row with the least id stands for a set; its text is found again by id and hash
    stands = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "text_hash")))
    sets = features.groupBy("digest").agg(stands.alias("stands"), F.count("*").alias("copies"), *[F.first(c).alias(c) for c in ("sketch", "splits", "keys")])
    sets = few(cut(sets.select("digest", "stands", "copies", "sketch", "splits", "keys", F.xxhash64("digest").alias("place"), F.monotonically_increasing_id().alias("sid"))))
    reps = sets.where("stands IS NOT NULL AND size(keys) > 0")
    groups = few(cut(components(_candidates(reps, leaf)).withColumnRenamed("id", "sid")))
    sizes = groups.groupBy("component").agg(F.count("*").alias("n"))
    members = groups.join(sizes, "component").join(reps.select("sid", "copies", "place", "stands.doc_id", "stands.text_hash"), "sid")
    texts = members.join(hashed, ["doc_id", "text_hash"]).dropDuplicates(["doc_id", "text_hash"])
    tokens = texts.select("sid", "component", "n", "copies", "place", "text").mapInArrow(_sets, "sid long, component long, n long, copies long, place long, tokens binary")
    exact = cut(_links(tokens, similarity, leaf))
    of_set = sets.select("digest", "sid", F.col("stands.doc_id").alias("set_id"), "copies").join(exact, "sid", "left")
    return features.select("doc_id", "text_hash", "digest"), of_set.select("digest", "sid", "set_id", "copies", "links", F.coalesce("class", "sid").alias("class"))


def similar_documents(docs: DataFrame, similarity: float = SIMILARITY, leaf: int = LEAF) -> DataFrame:
    """One row for each row of docs (doc_id, text): set_id, class_id, n_links.

    set_id is the least doc_id with the same shingle set, class_id the least that links of at least `similarity` lead to, and n_links
    the number of other rows that are linked directly, copies included. Null and empty texts have the same, empty set and
    are linked to each other alone. Rows that repeat an id are rows like any other, whether their texts agree or not.
    A null id never names a set or class: those are null if no other row has the text.
    """
    rows, sets = _classes(docs, similarity, leaf)
    least = sets.groupBy("class").agg(F.min("set_id").alias("class_id"))
    of_set = sets.join(least, "class").select("digest", "set_id", "class_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    return rows.select("doc_id", "digest").join(of_set, "digest").drop("digest")


def keep_one(docs: DataFrame) -> DataFrame:
    """Of each class of similar documents the row with the least id, with all columns of docs; rows without an id stay.

    Of rows that agree in id and text, one stays. Where an id has several texts, each goes or stays with its own class; where
    texts of one class share the least id, one of them stays, by the digests of their sets.
    """
    rows, sets = _classes(docs, SIMILARITY, LEAF)
    stays = sets.where("set_id IS NOT NULL").groupBy("class").agg(F.min(F.struct("set_id", "digest")).alias("x"))
    kept = stays.select(F.col("x.set_id").alias("doc_id"), F.col("x.digest").alias("digest"))
    # one text of the kept row's id and set
    kept = rows.join(kept, ["doc_id", "digest"]).groupBy("doc_id", "digest").agg(F.min("text_hash").alias("text_hash"))
    value = unused(docs, "text_hash")
    kept = kept.withColumnRenamed("text_hash", value)
    one = docs.where("doc_id IS NOT NULL").withColumn(value, F.xxhash64("text")).join(kept, ["doc_id", value], "left_semi").dropDuplicates(["doc_id", value])
    return one.select(docs.columns).unionByName(docs.where("doc_id IS NULL"))


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_documents(spread(table(spark, sf_dir, "documents")))


QUERIES = {"op3_jaccard_join": op3}

#: By brute force: all pairs of sets that share a shingle, and all sets that links reach.
ORACLE = {
    "op3_jaccard_join": r"""WITH RECURSIVE w AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
      k AS (SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END)) AS g FROM w),
      sets AS (SELECT g, min(doc_id) AS id, count(*) AS copies, len(g) AS n FROM k GROUP BY g),
      t AS (SELECT id, n, copies, unnest(g) AS x FROM sets),
      p AS (SELECT a.id AS a, b.id AS b, any_value(b.copies) AS c FROM t a JOIN t b ON a.x = b.x AND a.id <> b.id GROUP BY a.id, b.id HAVING 5 * count(*) >= 4 * (any_value(a.n) + any_value(b.n) - count(*))),
      links AS (SELECT a, sum(c) AS links FROM p GROUP BY a),
      reach(id, r) AS (SELECT id, id FROM sets UNION SELECT reach.id, p.b FROM reach JOIN p ON reach.r = p.a),
      class AS (SELECT id, min(r) AS class_id FROM reach GROUP BY id)
      SELECT k.doc_id, sets.id AS set_id, class.class_id, CAST(coalesce(links.links, 0) + sets.copies - 1 AS BIGINT) AS n_links FROM k JOIN sets ON k.g = sets.g JOIN class ON class.id = sets.id LEFT JOIN links ON links.a = sets.id""",
}
