"""Token-id files of independent zstandard frames with a trailing seek table (operator 8).

A file holds the ids of consecutive documents as little-endian unsigned 32-bit integers. The stream is cut every FRAME_IDS ids into
frames that are compressed alone. Then come a skippable frame with the document index (ids and lengths, themselves compressed) and the
seek table of zstandard's public seekable format: compressed and decompressed size of each frame and the low half of its
content's XXH64. A reader fetches the tail of a file, finds the frames that hold a document and decompresses those alone.

Files are written under a name of the attempt's own and renamed when they are whole, so that a task may run again.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxmill.llm.common import fresh_path, small_batches, table

FRAME_IDS = 1 << 18
#: Ids after which the next document opens a new file.
FILE_IDS = 1 << 24
LEVEL = 1
END = 0
VOCABULARY = "byte_bpe_50k.json"
#: Words that one worker remembers, in each of two tables: when the young one is full it becomes the old one.
WORD_TABLE = 750_000
#: Words that are encoded as one text.
LINES = 2_000
#: Punctuation that the splitting pattern sets apart from a letter or digit before it (an apostrophe may begin a contraction).
_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"

_SKIPPABLE, _INDEX_MAGIC, _SEEKABLE = 0x184D2A5E, 0x184D2A50, 0x8F92EAB1


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Ids of texts as bytes, by the tokenizers library.

    Its splitting pattern never joins a space or line end to what stands before it, if that is no white space, nor a line end to
    what follows, if that is none either. So a text whose white space is single spaces and line ends between other characters is encoded word by
    word: words behind a space, and words behind a line end, for which a NUL stands here. Words met before come from bounded
    tables. Texts with other white space, NULs, or the string of an added token such as <|endoftext|>, are encoded whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        (self.line,) = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.marks: dict[str, bytes] = {"": b""}
        #: Ids of each word, None for a word that can't be encoded alone.
        self.young: dict[str, bytes | None] = {}
        self.old: dict[str, bytes | None] = {}

    def whole(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _lines(self, words: list[str], before: str) -> list[bytes]:
        """Ids of each word with `before` in front, encoded as lines of one text: line ends stay tokens of their own."""
        out: list[bytes] = []
        for a in range(0, len(words), LINES):
            some = words[a : a + LINES]
            text = "".join([f"{before}{w}\n" for w in some])
            ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")
            ends, data = (np.flatnonzero(ids == self.line) * 4).tolist(), ids.tobytes()
            if len(ends) == len(some):
                out += [data[b:e] for b, e in zip([0, *[x + 4 for x in ends[:-1]]], ends, strict=True)]
            else:
                out += self.whole([before + w for w in some])
        return out

    def _ids(self, words: list[str]) -> list[bytes | None]:
        """Ids of distinct words, from the tables or encoded now; None for those with other white space."""
        if len(self.young) + len(words) > WORD_TABLE:
            self.young, self.old = {}, self.young
        if len(self.marks) > LINES:
            self.marks = {"": b""}
        young, old = self.young, self.old
        # marks behind a letter or digit are apart from it: only what stands before them has to be known
        heads: dict[str, bytes | None] = {}
        cut: list[tuple[str, str]] = []
        for w in [w for w in words if w not in young]:
            if w in old:
                young[w] = old[w]
            elif not w.isprintable() and (w.split() != [w] or w == "\0") or not w:
                young[w] = None
            elif not w[-1].isalnum() and (head := w.rstrip(_MARKS)) != w and head and head[-1].isalnum():
                cut.append((w, head))
                if head not in heads:
                    heads[head] = young.get(head) or old.get(head)
            elif w not in heads:
                heads[w] = None
        missing = [w for w, x in heads.items() if not x]
        spaced, bare = [w for w in missing if w[0] != "\0"], [w for w in missing if w[0] == "\0"]
        heads.update(zip(spaced, self._lines(spaced, " "), strict=True))
        end = np.array([self.line], dtype="<u4").tobytes()
        heads.update((w, end + ids) for w, ids in zip(bare, self._lines([w[1:] for w in bare], ""), strict=True))
        young.update(heads)
        tails = list({w[len(head) :] for w, head in cut} - self.marks.keys())
        self.marks.update(zip(tails, self.whole(tails), strict=True))
        marks = self.marks
        young.update([(w, heads[head] + marks[w[len(head) :]]) for w, head in cut])
        return list(map(young.__getitem__, words))

    def __call__(self, texts: pa.Array | list[str]) -> list[bytes]:
        """Ids of each text, null as the empty one."""
        column = pc.fill_null(pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts.cast(pa.large_string()), "")
        # each text starts like a line, whose end is cut off again; distinct words are found, and ids put together, in Arrow
        nul, none = pa.scalar("\0", pa.large_string()), pa.scalar("", pa.large_string())
        apart = pc.match_substring(column, "\0")
        for token in self.added:
            apart = pc.or_(apart, pc.match_substring(column, token))
        marked = pc.if_else(apart, none, pc.binary_join_element_wise(nul, pc.replace_substring(column, "\n", " \0"), none))
        split = pc.split_pattern(marked, " ")
        words = split.values.dictionary_encode()
        ids = pa.array(self._ids(words.dictionary.to_pylist()), pa.large_binary()).take(words.indices)
        edges = split.offsets.to_numpy()
        offsets = np.frombuffer(ids.buffers()[1], dtype=np.int64)[ids.offset :][: len(ids) + 1]
        data = memoryview(ids.buffers()[2] or b"")
        at = offsets[edges]
        out = [bytes(data[a + 4 : b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
        rest = np.unique(np.searchsorted(edges, np.flatnonzero(ids.is_null().to_numpy(zero_copy_only=False)), side="right") - 1).tolist()
        for i, whole in zip(rest, self.whole([column[i].as_py() for i in rest]), strict=True):
            out[i] = whole
        return out


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The tokenizer at path, loaded once per process."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a URI or local path, and the path in it."""
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{os.path.abspath(uri)}")


class Writer:
    """One file: add documents in order, then close."""

    def __init__(self, uri: str, frame_ids: int = FRAME_IDS):
        self.fs, self.path = filesystem(uri)
        self.part = f"{self.path}.{uuid.uuid4().hex}.part"
        self.out = self.fs.open_output_stream(self.part)
        self.compressor = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True)
        self.frame_bytes, self.pending, self.size = frame_ids * 4, [], 0
        self.frames: list[tuple[int, int, int]] = []
        self.docs: list[int | None] = []
        self.lengths: list[int] = []
        self.total = 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.docs.append(doc_id)
        self.lengths.append(len(ids) // 4)
        self.total += len(ids) // 4
        self.pending.append(ids)
        self.size += len(ids)
        if self.size >= self.frame_bytes:
            data = b"".join(self.pending)
            whole = self.size // self.frame_bytes * self.frame_bytes
            for a in range(0, whole, self.frame_bytes):
                self._frame(data[a : a + self.frame_bytes])
            self.pending, self.size = [data[whole:]], self.size - whole

    def _frame(self, data: bytes) -> None:
        packed = self.compressor.compress(data)
        self.out.write(packed)
        self.frames.append((len(packed), len(data), xxhash.xxh64_intdigest(data) & 0xFFFFFFFF))

    def close(self) -> None:
        if self.size:
            self._frame(b"".join(self.pending))
        named = np.array([d is not None for d in self.docs], dtype=np.uint8)
        index = self.compressor.compress(named.tobytes() + np.array([d or 0 for d in self.docs], dtype="<i8").tobytes() + np.array(self.lengths, dtype="<u8").tobytes())
        index = struct.pack("<Q", len(self.docs)) + index
        self.out.write(struct.pack("<II", _INDEX_MAGIC, len(index)) + index)
        self.frames.append((len(index) + 8, 0, xxhash.xxh64_intdigest(b"") & 0xFFFFFFFF))
        body = b"".join(struct.pack("<III", *f) for f in self.frames) + struct.pack("<IBI", len(self.frames), 0x80, _SEEKABLE)
        self.out.write(struct.pack("<II", _SKIPPABLE, len(body)) + body)
        self.out.close()
        self.fs.move(self.part, self.path)


class Reader:
    """Reads a file's index, and any documents of it by their place, decompressing the frames that hold them alone."""

    def __init__(self, uri: str):
        filesys, path = filesystem(uri)
        self.file = filesys.open_input_file(path)
        size = self.file.size()
        n, flags, magic = struct.unpack("<IBI", self.file.read_at(9, size - 9))
        if magic != _SEEKABLE or not flags & 0x80:
            raise ValueError(f"{uri} has no seek table with checksums")
        raw = self.file.read_at(n * 12, size - 9 - n * 12)
        self.sizes = np.frombuffer(raw, dtype="<u4").reshape(n, 3).astype(np.int64)
        self.packed_at = np.concatenate(([0], np.cumsum(self.sizes[:, 0])))
        self.at = np.concatenate(([0], np.cumsum(self.sizes[:, 1])))
        index = self.file.read_at(int(self.sizes[-1, 0]) - 8, int(self.packed_at[-2]) + 8)
        (docs,) = struct.unpack("<Q", index[:8])
        raw = zstandard.ZstdDecompressor().decompress(index[8:])
        self.named = np.frombuffer(raw, dtype=np.uint8, count=docs)
        self.doc_ids = np.frombuffer(raw, dtype="<i8", count=docs, offset=docs)
        self.lengths = np.frombuffer(raw, dtype="<u8", count=docs, offset=9 * docs).astype(np.int64)
        self.starts = np.concatenate(([0], np.cumsum(self.lengths)))
        self._last = (-1, b"")
        self.decompressed = 0

    def frame(self, i: int) -> bytes:
        if self._last[0] != i:
            packed = self.file.read_at(int(self.sizes[i, 0]), int(self.packed_at[i]))
            data = zstandard.ZstdDecompressor().decompress(packed)
            if xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != self.sizes[i, 2]:
                raise ValueError(f"frame {i} doesn't match its checksum")
            self._last = (i, data)
            self.decompressed += 1
        return self._last[1]

    def document(self, k: int) -> bytes:
        """Ids of the k-th document as bytes."""
        a, b = int(self.starts[k]) * 4, int(self.starts[k + 1]) * 4
        parts, i = [], int(np.searchsorted(self.at, a, side="right")) - 1
        while a < b:
            data, low = self.frame(i), int(self.at[i])
            parts.append(data[a - low : b - low])
            a = low + len(data)
            i += 1
        return b"".join(parts)

    def close(self) -> None:
        self.file.close()


def _write(folder: str, path: str, file_ids: int, frame_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = encoder(path), TaskContext.get().partitionId()
        end = np.array([END], dtype="<u4").tobytes()
        out: Writer | None = None
        done = []

        def close() -> None:
            out.close()
            done.append((part, len(done), f"{folder}/ids-{part:06d}-{len(done):06d}.zst", len(out.docs), out.total))

        for batch in small_batches(batches, "text", 4 << 20):
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encode(batch.column("text")), strict=True):
                if out is None:
                    out = Writer(f"{folder}/ids-{part:06d}-{len(done):06d}.zst", frame_ids)
                out.add(doc_id, ids + end)
                if out.total >= file_ids:
                    close()
                    out = None
        if out is not None:
            close()
        cols = list(zip(*done, strict=True)) or [[]] * 5
        yield pa.RecordBatch.from_pydict({n: pa.array(c, t) for n, c, t in zip(("part", "nth", "path", "n_docs", "n_ids"), cols, (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64()), strict=True)})

    return run


def write(docs: DataFrame, folder: str, path: str, file_ids: int = FILE_IDS, frame_ids: int = FRAME_IDS) -> list[dict]:
    """Encode docs (doc_id, text) and write them to folder in ascending order of id; the files, in order, with their first id's place.

    Null ids come first, equal ids in the order of a hash of their texts. Null and empty texts have the end id alone. No rows give no files.
    """
    out, target = filesystem(folder)
    out.create_dir(target, recursive=True)
    order = docs.select("doc_id", "text", F.xxhash64("text").alias("tie"))
    # ranges take ties apart as well, and only ids and hashes are compared
    dealt = order.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text").select("doc_id", "text")
    rows = dealt.mapInArrow(_write(folder, path, file_ids, frame_ids), "part long, nth long, path string, n_docs long, n_ids long").collect()
    files, start = [], 0
    for r in sorted(rows, key=lambda r: (r["part"], r["nth"])):
        files.append({"path": r["path"], "n_docs": r["n_docs"], "n_ids": r["n_ids"], "start": start})
        start += r["n_ids"]
    return files


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist(), strict=True):
            reader = Reader(path)
            n = len(reader.lengths)
            for a in range(0, n, 10_000):
                span = range(a, min(n, a + 10_000))
                crc = [zlib.crc32(reader.document(k)) for k in span]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array([int(reader.doc_ids[k]) if reader.named[k] else None for k in span], pa.int64()),
                    "start": pa.array(start + reader.starts[a : a + len(span)], pa.int64()),
                    "n_tokens": pa.array(reader.lengths[a : a + len(span)], pa.int64()),
                    "ids_crc32": pa.array(crc, pa.int64()),
                })
            reader.close()


def read_digests(spark: SparkSession, files: list[dict]) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document in the files, each file read and checked by one task."""
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    if not files:
        return spark.createDataFrame([], schema)
    listed = spark.createDataFrame([(f["path"], f["start"]) for f in files], "path string, start long")
    return listed.repartition(len(files), "path").mapInArrow(_read, schema)


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = write(table(spark, sf_dir, "documents"), fresh_path(spark, "token-frames"), vocabulary_path())
    return read_digests(spark, files)


QUERIES = {"op8_token_frames": op8}
