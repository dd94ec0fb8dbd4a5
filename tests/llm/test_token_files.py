import io
import zlib

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import _bpe, _text, token_files
from millrace.session import scratch_path

from .helpers import DOCUMENTS, documents

public_tokenizers = pytest.importorskip("public_tokenizers")
ENCODER = None


def encoder():
    global ENCODER
    if ENCODER is None:
        ENCODER = _bpe.Encoder(_bpe.default_path(), store=500)
    return ENCODER


TEXT = st.lists(st.sampled_from(["a", "Zb", "é", "'s", "'ll", " ", "  ", "\n", "\t", "\r\n", " ", "　", " ", "\u0085",
                                 ".", ",", "!", "1", "…", "日", "😀", "<|endoftext|>", "\x1c"]), max_size=30).map("".join)


@settings(max_examples=200, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=4))
def test_stretches_give_the_ids_of_whole_texts(texts):
    enc = encoder()
    want = [e.ids for e in enc.tokenizer.encode_batch(texts, add_special_tokens=False)]
    for piece in _text.pieces(pa.array(texts)):
        ids, sizes = enc.encode(piece)
        ends = np.cumsum(sizes)
        assert [ids[e - n:e].tolist() for e, n in zip(ends, sizes)] == want[piece.first:piece.first + len(piece)]


MARKED = ["end <|endoftext|> next", "<|endoftext|>", "a  <|endoftext|>  b", "x\n <|endoftext|>\n\ny", "\t <|endoftext|>",
          "<|endo", "ftext|> after", "x<|endoftext|><|endoftext|>.", "\u3000 <|endoftext|>,", "a, <|endoftext| >"]


def test_added_tokens_are_those_of_the_unmodified_library():
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(_bpe.default_path())
    want = [e.ids for e in library.encode_batch(MARKED, add_special_tokens=False)]
    assert want[0] == [437, 220, 50256, 1306]
    got = []
    for piece in _text.pieces(pa.array(MARKED)):
        ids, sizes = encoder().encode(piece)
        got += [i.tolist() for i in np.split(ids, np.cumsum(sizes)[:-1])]
    assert got == want


def test_many_stretches_are_one_call_of_the_library():
    enc = _bpe.Encoder(_bpe.default_path())
    real, calls = enc.tokenizer, []

    class Counting:
        def encode_batch_fast(self, texts, **options):
            calls.extend(texts)
            return real.encode_batch_fast(texts, **options)

    enc.tokenizer = Counting()
    texts = [" ".join(f"word{i}x{j}" for j in range(40)) for i in range(50)] + ["", "é", "日" * 9]
    for more in ([], MARKED):  # with the mark in a stretch, each is a call
        for piece in _text.pieces(pa.array(texts + more)):
            ids, sizes = enc.encode(piece)
            want = [e.ids for e in real.encode_batch(texts + more, add_special_tokens=False)]
            assert [i.tolist() for i in np.split(ids, np.cumsum(sizes)[:-1])] == want
        if not more:
            assert 0 < len(calls) <= -(-2002 // _bpe.JOINED)


class Recording:
    """The library, with the texts that it was given."""

    def __init__(self, real):
        self.real, self.texts = real, []

    def encode_batch_fast(self, texts, **options):
        self.texts.extend(texts)
        return self.real.encode_batch_fast(texts, **options)


def recorded(store=_bpe.STORE):
    enc = _bpe.Encoder(_bpe.default_path(), store=store)
    enc.tokenizer = Recording(enc.tokenizer)
    return enc


def encoded(enc, texts):
    got = []
    for piece in _text.pieces(pa.array(texts)):
        ids, sizes = enc.encode(piece)
        got += [i.tolist() for i in np.split(ids, np.cumsum(sizes)[:-1])]
    want = [e.ids for e in encoder().tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert got == want


def test_stretches_stand_side_by_side_where_one_begins_anyway():
    enc = recorded()
    encoded(enc, [" ".join(f"word{i}" for i in range(600)) + ".", "日", "日本"])
    # Before the two texts that begin with neither space nor line feed.
    assert sum(t.count("<|endoftext|>") for t in enc.tokenizer.texts) == 2


def test_stretches_met_again_outlive_a_full_store():
    enc = recorded(store=500)
    common = " ".join(f"common{i}" for i in range(100))
    encoded(enc, [common])
    for i in range(10):
        encoded(enc, [common + " " + " ".join(f"rare{i}x{j}" for j in range(150))])
        assert enc.known.count <= 500
    assert sum(t.count("common7 ") for t in enc.tokenizer.texts) == 1


def test_a_full_store_of_common_stretches_starts_anew():
    enc = recorded(store=500)
    for i in range(6):
        for _ in range(2):
            encoded(enc, [" ".join(f"w{i}x{j}" for j in range(200))])
            assert enc.known.count <= 500
    long = ["".join(chr(0x4E00 + (i * 37 + j * 101) % 20000) for j in range(300)) for i in range(40)]
    for text in long:  # few stretches, many ids
        encoded(enc, [text])
        assert enc.known.n_ids <= _bpe.STORE_IDS * 500 + 1000


STRETCHES = st.lists(st.text(st.sampled_from("aZé's \n\t\r.,!1…日😀\u3000\u0085\x1c<|>"), min_size=1, max_size=6)
                     | st.sampled_from([" and", " the", "\n", " ", ".", ",", "'ll", "<|endo", "ftext|>", "  x"]),
                     min_size=1, max_size=40)


@settings(max_examples=200, deadline=None)
@given(STRETCHES)
def test_stretches_in_one_call_have_the_ids_of_each_alone(texts):
    enc = encoder()
    whole = []
    for data in (t.encode() for t in texts):
        at = _bpe.cuts(np.frombuffer(data, np.uint8), np.array([0, len(data)])).tolist()
        whole += [data[a:b] for a, b in zip(at, at[1:] + [len(data)])]
    want = [e.ids for e in enc.tokenizer.encode_batch([t.decode() for t in whole], add_special_tokens=False)]
    ids, sizes = enc._library(whole)
    assert [i.tolist() for i in np.split(ids, np.cumsum(sizes)[:-1])] == want


def test_ids_that_do_not_stand_for_their_bytes_are_asked_for_alone():
    enc = recorded()
    enc.lengths = enc.lengths + 1
    encoded(enc, ["some words, and others", "a\nb"])
    assert " words" in enc.tokenizer.texts


def test_runs_are_found_under_keys_that_meet():
    store, rng = _bpe.Store(4), np.random.default_rng(1)
    keys = np.unique(rng.integers(1, 1 << 40, 300, dtype=np.uint64) << np.uint64(8))  # many share their first place
    runs = {}
    for part in np.array_split(rng.permutation(keys), 7):
        sizes = rng.integers(0, 5, len(part))
        ids = rng.integers(0, 1 << 32, sizes.sum(), dtype=np.uint32)
        assert not store.find(part)[1].any()
        store.add(part, sizes, ids)
        runs |= {k: i.tolist() for k, i in zip(part.tolist(), np.split(ids, np.cumsum(sizes)[:-1]))}
    asked = rng.choice(keys, 1000)
    at, known = store.find(asked)
    ids, sizes = store.runs(at)
    assert known.all() and store.count == len(keys)
    assert [i.tolist() for i in np.split(ids, np.cumsum(sizes)[:-1])] == [runs[k] for k in asked.tolist()]
    store.again[at] = True
    kept = store.met_again(1000, 10_000)
    assert kept.find(asked)[1].all() and kept.count == len(np.unique(asked)) and not kept.again.any()
    assert store.met_again(len(np.unique(asked)) - 1, 10_000).count == 0


def test_a_separator_overlaps_no_added_token():
    assert _bpe.separator([b"<|x|>", b"<s>"]) == b"<|x|>"
    assert _bpe.separator([b"a<|", b"<|x|>"]) is None
    assert _bpe.separator([b"aba"]) is None and _bpe.separator([]) is None
    assert _bpe.separator([b"<s>", b"<s>2", b"1-"]) == b"1-"


def plain(rows):
    tokenizer = _bpe.load(_bpe.default_path())
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    out, start = [], 0
    for r in rows:
        ids = tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [2]
        out.append((r[0], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
        start += len(ids)
    return out


@pytest.mark.parametrize("file_bytes,frame_ids", [(1 << 25, 1 << 18), (4000, 100)])
def test_round_trip(spark, file_bytes, frame_ids):
    rows = documents()
    folder = scratch_path(spark, "token-test")
    files = token_files.write_tokens(spark.createDataFrame(rows, DOCUMENTS), folder, file_bytes=file_bytes, frame_ids=frame_ids)
    assert files.count() == 1 if file_bytes > 10**6 else files.count() > 3
    got = token_files.read_documents(files, ids=True).collect()
    want = plain(rows)
    assert sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32, list(r.ids)) for r in got), key=lambda r: r[1]) == want
    some = {w[0]: w[4] for w in want}
    asked = {r.doc_id: list(r.ids) for r in token_files.fetch(files, [5, 12, 10**9]).collect()}
    assert asked == {5: some[5], 12: some[12]}


def written(frames=3):
    out = io.BytesIO()
    writer = token_files.Writer(out, frame_ids=50)
    for i in range(frames):
        writer.add(np.array([i]), np.array([0]), np.array([60]), np.arange(60, dtype=np.uint32) + i)
    writer.close()
    return out.getvalue()


class Source(io.BytesIO):
    def size(self):
        return len(self.getvalue())


def test_any_zstandard_reader_unpacks_the_ids():
    data = zstandard.ZstdDecompressor().decompressobj(read_across_frames=True).decompress(written())
    assert np.frombuffer(data, "<u4").tolist() == [j + i for i in range(3) for j in range(60)]


def test_only_the_frames_asked_for_are_read():
    reader = token_files.Reader(Source(written()))
    read = []
    reader.frame = lambda k, f=reader.frame: read.append(k) or f(k)
    assert reader.document(1).tolist() == list(range(1, 61)) and set(read) == {1, 2}


def test_damage_is_noticed():
    data = bytearray(written())
    reader = token_files.Reader(Source(bytes(data)))
    reader.table = reader.table.copy()
    reader.table[0, 2] ^= 1
    with pytest.raises(ValueError, match="damaged"):
        reader.document(0)
    data[int(reader.places[0]) + 12] ^= 0xFF
    with pytest.raises((ValueError, zstandard.ZstdError)):
        token_files.Reader(Source(bytes(data))).document(0)
    with pytest.raises(ValueError, match="seekable"):
        token_files.Reader(Source(b"x" * 40))


def test_empty_table(spark):
    assert token_files.encode_documents(spark.createDataFrame([], DOCUMENTS)).count() == 0
