"""Benchmark decontamination by pigeonhole edit matching (operator 1).

Texts are compared lower-cased, with each run of white space as one space. An item of m characters may lie in a text with up to
k = floor(ERROR_RATE * m) edits. Cut into k + 1 pieces, one piece at least is then in the text without an edit: an
Aho-Corasick automaton finds all pieces of a block of items in one scan. Pieces are taken in groups of two (the last of
three if they are odd): a group of g pieces must lie in the text with g - 1 edits at most for one of them to hold the exact piece that the
pigeonhole promises, so Myers' bit-parallel algorithm verifies first the group of a hit, and then the stretch that the whole item may take. Items go in blocks of BLOCK_CHARS characters, each with an automaton of bounded size, so the benchmark may be of any
size; documents are scanned once a block.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxmill.llm.common import small_batches, spread, table, texts_of

ERROR_RATE = 0.10
#: Shorter items must lie in a text as whole words and without edits: with edits they are phrases that clean texts hold too.
WHOLE_CHARS = 30
#: Items of fewer words and fewer characters are words, not tests, and match nothing.
LEAST_WORDS, LEAST_CHARS = 3, 12
BLOCK_CHARS = 2_000_000

_SPACE = re.compile(r"\s+")


def normal(text: str | None) -> str:
    """Lower case, each run of white space as one space, none at the ends."""
    return _SPACE.sub(" ", (text or "").lower()).strip()


def budget(item: str, rate: float = ERROR_RATE) -> int:
    return int(rate * len(item)) if len(item) >= WHOLE_CHARS else 0


def is_test(item: str) -> bool:
    return len(item) >= LEAST_CHARS or item.count(" ") >= LEAST_WORDS - 1


def at_borders(text: str, start: int, end: int) -> bool:
    """Whether a stretch neither begins nor ends within a word; scripts without spaces between words have no such borders."""

    def joined(i: int) -> bool:
        return 0 < i < len(text) and all(c.isalnum() and ord(c) < 0x2E80 for c in text[i - 1 : i + 1])

    return not joined(start) and not joined(end)


def pieces(item: str, k: int) -> list[tuple[int, str]]:
    """(offset, piece) of k + 1 pieces whose lengths differ by one at most."""
    cuts = [len(item) * i // (k + 1) for i in range(k + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True) if b > a]


def groups(parts: list[tuple[int, str]]) -> list[list[tuple[int, str]]]:
    """Pieces in neighbouring twos; three in the last group if they are odd."""
    n = max(len(parts) // 2, 1)
    return [parts[2 * i : 2 * i + 2 if i < n - 1 else None] for i in range(n)]


def masks(item: str) -> dict[str, int]:
    out: dict[str, int] = {}
    for i, c in enumerate(item):
        out[c] = out.get(c, 0) | 1 << i
    return out


def myers(peq: dict[str, int], m: int, text: str, k: int) -> tuple[int, int] | None:
    """Least edit distance of a pattern of m characters to any stretch of text, and where the first such ends; None above k."""
    full, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score, best = full, 0, m, (k + 1, -1)
    for j, c in enumerate(text):
        eq = peq.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | (full & ~(xh | pv))
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph = (ph << 1) & full
        mh = (mh << 1) & full
        pv = mh | (full & ~(xv | ph))
        mv = ph & xv
        if score < best[0]:
            best = (score, j + 1)
            if not score:
                break
    return best if best[1] >= 0 and best[0] <= k else None


class Index:
    """Automaton over the pieces of some items, and what verifies their hits."""

    def __init__(self, items: list[tuple[int, str]], rate: float = ERROR_RATE):
        self.items = [(i, text, budget(text, rate), masks(text)) for i, text in items]
        self.automaton = ahocorasick.Automaton()
        where: dict[str, list[tuple]] = {}
        for n, (_, text, k, _) in enumerate(self.items):
            for group in groups(pieces(text, k)):
                whole = "".join(p for _, p in group)
                shared = (group[0][0], whole, len(group) - 1, masks(whole))
                for offset, piece in group:
                    where.setdefault(piece, []).append((n, offset, shared))
        for piece, places in where.items():
            self.automaton.add_word(piece, (len(piece), places))
        if where:
            self.automaton.make_automaton()
        self.empty = not where

    def matches(self, text: str) -> list[tuple[int, int, int]]:
        """(item id, edits, end in the normal text) of each item that lies in the text; text must be normal."""
        if self.empty or not text:
            return []
        stretches: dict[int, list[list[int]]] = {}
        short: dict[int, int] = {}
        for last, (size, places) in self.automaton.iter(text):
            for n, offset, (at, whole, edits, peq) in places:
                start = last + 1 - size - offset
                if len(self.items[n][1]) < WHOLE_CHARS:  # its one piece is the item
                    if n not in short and at_borders(text, start, last + 1):
                        short[n] = last + 1
                    continue
                begin = start + at
                if begin < 0 or not text.startswith(whole, begin):
                    if myers(peq, len(whole), text[max(0, begin - edits) : begin + len(whole) + edits], edits) is None:
                        continue
                _, item, k, _ = self.items[n]
                low, high = max(0, start - k), min(len(text), start + len(item) + k)
                own = stretches.setdefault(n, [])
                # hits come in order of their ends, so their stretches start almost in order: neighbours join
                if own and low <= own[-1][1] and high >= own[-1][0] and low >= own[-1][0] - 2 * k and own[-1][1] - own[-1][0] < 4 * len(item):
                    own[-1] = [min(low, own[-1][0]), max(high, own[-1][1])]
                else:
                    own.append([low, high])
        out = [(self.items[n][0], 0, end) for n, end in short.items()]
        for n, own in stretches.items():
            ident, item, k, peq = self.items[n]
            best = None
            exact = text.find(item)
            if exact >= 0:
                best = (0, exact + len(item))
            else:
                for low, high in own:
                    found = myers(peq, len(item), text[low:high], k)
                    if found and (best is None or found[0] < best[0]):
                        best = (found[0], low + found[1])
            if best:
                out.append((ident, *best))
        return sorted(out)


_built: dict[str, Index] = {}


def built(key: str, items: list[tuple[int, str]], rate: float) -> Index:
    """The index of a block of items, which a worker process keeps from task to task until it meets another block."""
    if key not in _built:
        _built.clear()
        _built[key] = Index(items, rate)
    return _built[key]


def _blocks(benchmark: DataFrame, block_chars: int) -> Iterator[list[tuple[int, str]]]:
    """The items in normal form, in blocks of bounded size; rows without id or text are left out."""
    block, total = [], 0
    for row in benchmark.where("item_id IS NOT NULL AND text IS NOT NULL").select("item_id", "text").toLocalIterator():
        text = normal(row["text"])
        if not is_test(text):
            continue
        if block and total + len(text) > block_chars:
            yield block
            block, total = [], 0
        block.append((row["item_id"], text))
        total += len(text)
    if block:
        yield block


def matches(docs: DataFrame, benchmark: DataFrame, rate: float = ERROR_RATE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """doc_id, item_id, n_edits for each document row and benchmark item that lies in its text with at most rate * length edits.

    Items of fewer than WHOLE_CHARS characters match as whole words without edits. Null and empty texts and items match nothing, nor do items
    of one or two short words. Repeated documents or items match each; of an item's places with equally few edits in a text one counts. An empty benchmark
    gives no rows.
    """
    spark = docs.sparkSession
    out = None
    for block in _blocks(benchmark, block_chars):
        shipped = spark.sparkContext.broadcast(block)  # bounded by block_chars
        found = docs.select("doc_id", "text").mapInArrow(_matcher(shipped, rate), "doc_id long, item_id long, n_edits long")
        out = found if out is None else out.unionByName(found)
    return out if out is not None else spark.createDataFrame([], "doc_id long, item_id long, n_edits long")


def _matcher(shipped, rate: float):
    key = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = built(key, shipped.value, rate)
        for batch in small_batches(batches, "text"):
            doc, item, edits = [], [], []
            for i, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch), strict=True):
                for ident, n, _ in index.matches(normal(text)):
                    doc.append(i)
                    item.append(ident)
                    edits.append(n)
            yield pa.RecordBatch.from_pydict({"doc_id": pa.array(doc, pa.int64()), "item_id": pa.array(item, pa.int64()), "n_edits": pa.array(edits, pa.int64())})

    return run


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs without the rows that hold a benchmark item; the scan marks rows in place, so nothing is joined or shuffled."""
    spark = docs.sparkSession
    out = docs
    for block in _blocks(benchmark, BLOCK_CHARS):
        out = out.mapInArrow(_filter(spark.sparkContext.broadcast(block), ERROR_RATE), docs.schema)
    return out


def _filter(shipped, rate: float):
    key = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = built(key, shipped.value, rate)
        for batch in small_batches(batches, "text"):
            yield batch.filter(pa.array([not index.matches(normal(t)) for t in texts_of(batch)], pa.bool_()))

    return run


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matches(spread(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"))


QUERIES = {"op1_decontaminate": op1}
