"""Token files and piece encoding against the libraries."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from voxmill.llm import frames, pieces

public = pytest.importorskip("public_tokenizers")


def texts(n=1500):
    r = random.Random(4)
    marks = " abcdefghij ▁éèß\n\tтж日本😀\x01�.,!?0123456789  '\x1c\x85　\0"
    out = ["", " ", "  a  b ", "a\nb\n\n c", "\t x", "é ☃ 😀", "a▁b", "▁", "<s> a </s> <0x41>", "<|endoftext|> x", "ab" * 200, "\n" * 9, " " * 40, "don't we'll x's", "1st 2nd, 3.5% (ok)..."]
    out += ["".join(r.choice(marks) for _ in range(r.randint(1, 60))) for _ in range(n)]
    out += [" ".join("".join(r.choice("ethaionrs") for _ in range(r.randint(1, 12))) + r.choice(["", "", ",", ".\n", "!!", "***", "'s"]) for _ in range(20)) for _ in range(n)]
    return out


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.vocabulary(pieces.model_path())


def test_pieces_as_the_library(vocabulary):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=pieces.model_path())
    for t in texts():
        want = sp.encode(t)
        assert vocabulary.encode(t) == want, t
        assert vocabulary.decode(want) == sp.decode(want), t
        assert vocabulary.looked_up(t)[1] == sp.decode(want), t


def test_pairs_by_merging(vocabulary):
    r = random.Random(1)
    words = ["".join(r.choice("ethaionrs") for _ in range(r.randint(1, 14))) for _ in range(2000)]
    for w in words:
        assert vocabulary.split(w) == vocabulary.merge(w)


def test_word_tables_are_bounded(vocabulary, monkeypatch):
    monkeypatch.setattr(pieces, "WORD_TABLE", 5)
    monkeypatch.setattr(pieces, "PAIR_TABLE", 5)
    v = pieces.Vocabulary(pieces.model_path())
    for t in texts(60):
        assert v.encode(t) == vocabulary.encode(t)
    assert len(v.young) <= 5 and len(v._old) <= 5


def test_round_trip(spark, docs_of, vocabulary):
    import hashlib

    rows = [(1, "Hello wörld\n x"), (2, ""), (3, None), (None, "x"), (1, "Hello wörld\n x")]
    got = pieces.round_trip(docs_of(rows), pieces.model_path()).collect()
    assert len(got) == 5
    for x, (_, t) in zip(got, rows, strict=True):
        ids = vocabulary.encode(t or "")
        assert (x.n_tokens, x.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert x.decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
    back = pieces.decode(pieces.encode(docs_of(rows), pieces.model_path()), pieces.model_path())
    assert [x.text for x in back.collect()] == [t or "" for _, t in rows]
    assert pieces.round_trip(docs_of([]), pieces.model_path()).count() == 0


def test_words_alone_as_whole_texts(monkeypatch):
    monkeypatch.setattr(frames, "WORD_TABLE", 300)
    e = frames.Encoder(frames.vocabulary_path())
    all_texts = texts()
    for a in range(0, len(all_texts), 500):
        assert e(all_texts[a : a + 500]) == e.whole(all_texts[a : a + 500])


@pytest.mark.parametrize("file_ids, frame_ids", [(1 << 24, 1 << 18), (50, 16), (1, 1)])
def test_files(spark, docs_of, tmp_path, file_ids, frame_ids):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(frames.vocabulary_path())
    rows = [(i * 7 % 31, t) for i, t in enumerate(texts(20))][:31]
    rows[3] = (rows[3][0], None)
    files = frames.write(docs_of(rows), str(tmp_path / "ids"), frames.vocabulary_path(), file_ids, frame_ids)
    got = sorted(frames.read_digests(spark, files).collect(), key=lambda x: x.start)
    start = 0
    for x, (i, t) in zip(got, sorted(rows, key=lambda r: r[0]), strict=True):
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 0], dtype="<u4")
        assert (x.doc_id, x.start, x.n_tokens, x.ids_crc32) == (i, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert sum(f["n_docs"] for f in files) == 31
    assert not list((tmp_path / "ids").glob("*.part"))


def test_ids_as_the_library():
    """All texts by the library's defaults, which take the string of an added token for the token."""
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(frames.vocabulary_path())
    some = [*texts(300), "<|endoftext|>", "a<|endoftext|>b c", "a\n<|endoftext|>\n<|endoftext|> ,", "<|endoftext|", "x <|endoftext|>\0"]
    want = [np.array(tok.encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes() for t in some]
    assert frames.Encoder(frames.vocabulary_path())(some) == want
    assert np.frombuffer(want[-5], dtype="<u4").tolist() == [50256]


def test_reader_touches_few_frames(tmp_path):
    path = str(tmp_path / "f.zst")
    w = frames.Writer(path, frame_ids=100)
    docs = [np.arange(k, k + 37, dtype="<u4").tobytes() for k in range(200)]
    for k, d in enumerate(docs):
        w.add(k if k else None, d)
    w.close()
    r = frames.Reader(path)
    assert r.document(150) == docs[150] and r.decompressed <= 2
    assert [r.document(k) for k in range(200)] == docs
    assert r.named.tolist() == [0] + [1] * 199
    r.close()
    import zstandard

    stream = zstandard.ZstdDecompressor().stream_reader(open(path, "rb"), read_across_frames=True)
    assert stream.read() == b"".join(docs)  # any zstandard reader takes the file
    broken = bytearray(open(path, "rb").read())
    broken[20] ^= 255
    open(path, "wb").write(broken)
    with pytest.raises((ValueError, zstandard.ZstdError)):
        frames.Reader(path).document(0)


def test_no_files(spark, docs_of, tmp_path):
    assert frames.write(docs_of([]), str(tmp_path / "none"), frames.vocabulary_path()) == []
    assert frames.read_digests(spark, []).count() == 0
    files = frames.write(docs_of([(None, "b"), (None, "a"), (1, None)]), str(tmp_path / "n"), frames.vocabulary_path())
    assert sorted(str(x.doc_id) for x in frames.read_digests(spark, files).collect()) == ["1", "None", "None"]
