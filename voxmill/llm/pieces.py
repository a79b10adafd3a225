"""SentencePiece BPE encoding by backtracking, and decoding (operator 9).

The model is read through the sentencepiece library: pieces, scores and byte pieces; encoding is this module's own.

Two characters that stand side by side in no piece of the vocabulary are never merged, so a text falls apart between them. No piece
holds the space mark behind another character, so that every word can be encoded alone, and most words have parts. In a part, an Aho-Corasick automaton over the pieces that
merging can produce gives the matches that start at each position, longest first. Backtracking takes the longest match whose
pair with the piece before is compatible: merging the two together again gives just these two pieces. Positions from which no
way leads to the end are kept in a bitfield and not entered again. Words and parts that have been encoded before come from bounded tables.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxmill.llm.common import small_batches, spread, table, texts_of

MARK = "▁"
MODEL = "piece_bpe_32k.model"
#: Words that one worker remembers, in each of two tables: when the young one is full it becomes the old one.
WORD_TABLE = 300_000
#: Pairs of pieces whose compatibility one worker remembers, at most.
PAIR_TABLE = 300_000
#: Longer words (no white space for so long) are encoded without being remembered.
LONG_WORD = 64

_WORD = re.compile(f"{MARK}*[^{MARK}\n]+|{MARK}+|\n")


def model_path(name: str = MODEL) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Vocabulary:
    """Pieces of a SentencePiece BPE model with byte fallback, the identity normaliser and a space mark in front."""

    def __init__(self, path: str):
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.pieces = [sp.id_to_piece(i) for i in range(n)]
        special = [sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) for i in range(n)]
        self.bytes = {int(p[3:5], 16): i for i, p in enumerate(self.pieces) if sp.is_byte(i)}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.score = {p: sp.get_score(i) for i, p in enumerate(self.pieces) if not special[i]}
        self.ident = {p: i for i, p in enumerate(self.pieces) if not special[i]}
        self.silent = {i for i in range(n) if sp.is_control(i)}
        if any(re.search(f"[^{MARK}]{MARK}|\n", p) for p in self.ident):
            raise ValueError("a piece holds a line end, or the space mark behind another character: words can't be encoded alone")
        #: Pairs of characters that some piece holds side by side.
        self.beside = {p[i : i + 2] for p in self.ident for i in range(len(p) - 1)}
        # pieces that merging doesn't give back whole never occur
        self.reachable = {p for p in self.ident if self.merge(p) == [p]}
        self.starts = ahocorasick.Automaton()
        for p in self.reachable:
            self.starts.add_word(p, p)
        if any(p[0] not in self.reachable for p in self.reachable):
            raise ValueError("a piece begins with a character that is no piece")
        self.starts.make_automaton()
        #: The next shorter piece that begins a piece.
        self.shorter = {p: q for p in self.reachable if (q := next((p[:k] for k in range(len(p) - 1, 0, -1) if p[:k] in self.reachable), None))}
        self._text = {p: str(i) for p, i in self.ident.items()}
        self._pairs: dict[tuple[str, str], bool] = {}
        #: Ids of a word as text, and what they decode to where that isn't the word itself.
        self.young: dict[str, str] = {}
        self._old: dict[str, str] = {}
        self.odd: dict[str, str] = {}

    def merge(self, text: str) -> list[str]:
        """Plain BPE: merge the adjacent pair whose joint piece has the highest score, the leftmost of equals, until none has one."""
        parts: list[str | None] = list(text)
        left, right = list(range(-1, len(parts) - 1)), list(range(1, len(parts) + 1))
        heap = [(-self.score[a + b], i, a + b) for i, (a, b) in enumerate(zip(text, text[1:], strict=False)) if a + b in self.score]
        heapq.heapify(heap)
        while heap:
            _, i, piece = heapq.heappop(heap)
            j = right[i] if parts[i] is not None else len(parts)
            if j >= len(parts) or parts[i] + parts[j] != piece:
                continue
            parts[i], parts[j] = piece, None
            right[i] = right[j]
            if right[j] < len(parts):
                left[right[j]] = i
            for a in (left[i], i):
                b = right[a] if a >= 0 else len(parts)
                if b < len(parts) and parts[a] + parts[b] in self.score:
                    heapq.heappush(heap, (-self.score[parts[a] + parts[b]], a, parts[a] + parts[b]))
        return [p for p in parts if p is not None]

    def compatible(self, a: str, b: str) -> bool:
        """Whether merging a + b again gives just a and b."""
        found = self._pairs.get((a, b))
        if found is None:
            if len(self._pairs) >= PAIR_TABLE:
                self._pairs.clear()
            found = self._pairs[a, b] = self.merge(a + b) == [a, b]
        return found

    def _longest(self, word: str, pos: int) -> str:
        """The longest piece that begins at pos; a character that no piece begins with is a piece by itself."""
        last, p = next(self.starts.iter_long(word, pos), (-1, ""))
        return p if p and last + 1 - len(p) == pos else word[pos]

    def split(self, word: str) -> list[str]:
        """The pieces of a word."""
        known, check, shorter, longest = self._pairs.get, self.compatible, self.shorter.get, self._longest
        n, pos = len(word), 0
        # bitfield of failed positions: a stretch up to a position has one encoding at most, so a position that fails once fails for good
        failed = 0
        out: list[str] = []
        p = longest(word, 0) if n else None
        while pos < n:
            while p is not None:
                if not failed >> (pos + len(p)) & 1:
                    if not out:
                        break
                    fits = known((out[-1], p))
                    if fits or (fits is None and check(out[-1], p)):
                        break
                p = shorter(p)
            if p is not None:
                out.append(p)
                pos += len(p)
                p = longest(word, pos) if pos < n else None
            elif out:
                failed |= 1 << pos
                last = out.pop()
                pos -= len(last)
                p = shorter(last)
            else:
                raise ValueError("no valid encoding")
        return out

    def ids(self, parts: list[str]) -> list[int]:
        out: list[int] = []
        for p in parts:
            i = self.ident.get(p)
            if i is not None:
                out.append(i)
            else:
                out += [self.bytes[b] for b in p.encode("utf-8", "surrogatepass")]
        return out

    def word(self, word: str) -> str:
        """Ids of a word as text; what they decode to goes to `odd` if it isn't the word (space marks left as they are)."""
        found = self.young.get(word) or self._old.get(word)
        if found is None:
            found = self._encoded(word)
            if (plain := self.decode_marked([int(i) for i in found.split(",")])) != word:
                self.odd[word] = plain
        if len(word) <= LONG_WORD:
            if len(self.young) >= WORD_TABLE:
                self._old, self.young = self.young, {}
            self.young[word] = found
        return found

    def _encoded(self, word: str) -> str:
        """Of a word or part: as word(), from its parts if it has any."""
        beside = self.beside
        cuts = [i + 1 for i in range(len(word) - 1) if word[i : i + 2] not in beside]
        if cuts:
            known = self.young.get
            return ",".join([known(part) or self.word(part) for part in (word[a:b] for a, b in zip([0, *cuts], [*cuts, len(word)], strict=True))])
        parts = self.split(word)
        try:
            return ",".join([self._text[p] for p in parts])
        except KeyError:  # bytes of unknown characters
            return ",".join(map(str, self.ids(parts)))

    def looked_up(self, text: str) -> tuple[str, str]:
        """Ids of a text as text, and the text that they decode to."""
        word, young, words = self.word, self.young.get, self.words(text)
        ids = ",".join([young(w) or word(w) for w in words])
        if self.odd:
            words = [self.odd.get(w, w) for w in words]
        return ids, "".join(words).replace(MARK, " ").removeprefix(" ")

    def decode_marked(self, ids: list[int]) -> str:
        out, pending = [], bytearray()
        for i in ids:
            b = self.byte_of.get(i)
            if b is not None:
                pending.append(b)
                continue
            if pending:
                out.append(pending.decode("utf-8", "replace"))
                pending.clear()
            if i not in self.silent:
                out.append(self.pieces[i])
        if pending:
            out.append(pending.decode("utf-8", "replace"))
        return "".join(out)

    @staticmethod
    def words(text: str) -> list[str]:
        return _WORD.findall(MARK + text.replace(" ", MARK)) if text else []

    def encode(self, text: str) -> list[int]:
        return [int(i) for i in self.looked_up(text)[0].split(",")] if text else []

    def decode(self, ids: list[int]) -> str:
        """What the ids stand for, without the space that encoding put in front."""
        text = self.decode_marked(ids).replace(MARK, " ")
        return text.removeprefix(" ")


_loaded: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    """The model at path, read once per process."""
    if path not in _loaded:
        _loaded[path] = Vocabulary(path)
    return _loaded[path]


def _round_trip(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for batch in small_batches(batches, "text"):
            n, encoded, decoded = [], [], []
            for text in texts_of(batch):
                ids, plain = v.looked_up(text)
                n.append(ids.count(",") + 1 if ids else 0)
                encoded.append(hashlib.sha256(ids.encode()).hexdigest())
                decoded.append(hashlib.sha256(plain.encode("utf-8", "surrogatepass")).hexdigest())
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "n_tokens": pa.array(n, pa.int64()), "ids_sha256": encoded, "decoded_sha256": decoded})

    return run


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """One row for each row of docs (doc_id, text): doc_id, n_tokens, ids_sha256, decoded_sha256.

    Null and empty texts have no ids: the digests are those of the empty text. Repeated rows and null ids are kept as they are.
    """
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.select("doc_id", "text").mapInArrow(_round_trip(path), schema)


def _encode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for batch in small_batches(batches, "text", 1 << 20):
            ids = [v.encode(t) for t in texts_of(batch)]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "ids": pa.array(ids, pa.list_(pa.int32()))})

    return run


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and ids (array of int) of each row of docs; null and empty texts have an empty array."""
    return docs.select("doc_id", "text").mapInArrow(_encode(path), "doc_id long, ids array<int>")


def _decode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for batch in batches:
            texts = [v.decode(ids or []) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "text": pa.array(texts, pa.string())})

    return run


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and text of each row (doc_id, ids); null ids decode to the empty text."""
    return encoded.select("doc_id", "ids").mapInArrow(_decode(path), "doc_id long, text string")


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(spread(table(spark, sf_dir, "documents")), model_path())


QUERIES = {"op9_piece_roundtrip": op9}
