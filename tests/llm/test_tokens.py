"""Records and the BPE transducer against the tokenizers library."""

import hashlib
import json
import random
import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tessera.llm import bpe, records
from tessera.llm.scratch import Scratch
from tessera.llm.tokens import JoinedCache, PieceCache, library_cache, token_bytes

BYTE, WORD = P.path("byte_bpe_50k.json"), P.path("word_bpe_49k.json")
ODD = st.lists(st.sampled_from(list("ab \n\t'sre.|<>é 　1́ΣA日🙂\x1c\x85") + ["<|endoftext|>", "  ", " \n", "'ll"]),
               max_size=30).map("".join)


@pytest.mark.parametrize("path", [BYTE, WORD], ids=["byte", "word"])
def test_pieces_give_the_library_ids(path):
    lib = Tokenizer.from_file(path)

    @settings(max_examples=150, deadline=None)
    @given(st.lists(ODD, min_size=1, max_size=5))
    def check(texts):
        ids, off = library_cache(path).encode(pa.array(texts + [None], pa.string()))
        got = [ids[a:b].tolist() for a, b in zip(off, off[1:])]
        assert got == [lib.encode(t, add_special_tokens=False).ids for t in texts] + [[]]
    check()


def test_cache_forgets_but_stays_right():
    lib = Tokenizer.from_file(BYTE)
    cache = PieceCache(lambda ps: [lib.encode(p, add_special_tokens=False).ids for p in ps], limit=10)
    for k in range(5):
        text = " ".join(f"w{k}{j}" for j in range(8))
        ids, _ = cache.encode(pa.array([text]))
        assert ids.tolist() == lib.encode(text, add_special_tokens=False).ids and len(cache.keys) <= 16


def test_new_words_reach_the_library_joined():
    """The library gets one text for several new pieces, not a call's cost for each."""
    lib, sent = Tokenizer.from_file(BYTE), []
    with open(BYTE, encoding="utf-8") as f:
        size = token_bytes(json.load(f))

    def encode_many(pieces):
        sent.extend(pieces)
        return [lib.encode(p, add_special_tokens=False).ids for p in pieces]

    rng = random.Random(5)
    plain = "".join(f" w{k}x" for k in range(3200))
    odd = ["".join(rng.choices(list("ab \n\t's.|<>é\u3000́Σ日🙂\x1c\x85\u2028\u3042") + ["<|endoftext|>", "  ", " \n", "'ll"], k=60)) for _ in range(300)]
    for size_of, most in ((size, 3200 // 16 + 10), (np.zeros_like(size), 10**6)):  # sizes that fit no text: one by one
        cache = JoinedCache(encode_many, size_of)
        sent.clear()
        for texts in ([plain], odd, [plain, "a", *odd[::-1]]):
            ids, off = cache.encode(pa.array(texts))
            assert [ids[a:b].tolist() for a, b in zip(off, off[1:])] == [lib.encode(t, add_special_tokens=False).ids for t in texts]
            if texts == [plain]:
                assert len(sent) <= most
    assert isinstance(library_cache(BYTE), JoinedCache) and not isinstance(library_cache(WORD), JoinedCache)


def test_transducer_with_the_least_window():
    lib, m = Tokenizer.from_file(BYTE), bpe.Merges(BYTE)
    m.window = m.lookahead + 1
    rng = random.Random(3)
    for _ in range(300):
        some = rng.sample(["a", "e", "th", "in", "er", "ation", "=", "-", "====", "s", "ing", "on", "x", "é"], 3)
        text = "".join(rng.choices(some, k=rng.randint(200, 900)))
        assert m.encode(text) == lib.encode(text, add_special_tokens=False).ids


def test_matches_in_blocks():
    text = "a b. c 's  \n don't I'll 've  12é\t\n" * 50
    assert list(bpe.matches(text, 16)) == list(bpe.matches(text))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 50256), max_size=40), st.integers(1, 7))
def test_decoder_in_any_blocks(ids, step):
    lib, d = Tokenizer.from_file(BYTE), bpe.Decoder(bpe.merges(BYTE).bytes)
    got = "".join(d.feed(ids[k:k + step]) for k in range(0, len(ids), step)) + d.feed([], True)
    assert got == lib.decode(ids, skip_special_tokens=False)


def test_digests(docs, rows, empty):
    lib = Tokenizer.from_file(BYTE)
    got = {r.doc_id: r for r in bpe.digests(docs, BYTE).collect()}
    for i, t, *_ in rows:
        ids = lib.encode(t or "", add_special_tokens=False).ids
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert bpe.digests(empty, BYTE).count() == 0 and len(got) == len(rows)


def slow_crc32c(data: bytes) -> int:
    c = 0xFFFFFFFF
    for b in data:
        c ^= b
        for _ in range(8):
            c = (c >> 1) ^ (0x82F63B78 if c & 1 else 0)
    return c ^ 0xFFFFFFFF


def test_crc32c():
    assert slow_crc32c(b"123456789") == 0xE3069283
    rng = random.Random(1)
    parts = [rng.randbytes(n) for n in (4, 9, 255, 256, 257, 5000, 513)]
    assert records.crc32c(parts).tolist() == [slow_crc32c(p) for p in parts]


def test_damage_is_found():
    data = records.frames([b"payload one", b"second \n payload"])
    raw = b"\n".join(data) + b"\n"
    assert [p for *_, p in records.unframe(raw)] == [b"payload one", b"second \n payload"]
    for k in (0, 9, 14, len(raw) - 3):
        bad = bytearray(raw)
        bad[k] ^= 1
        with pytest.raises(ValueError):
            list(records.unframe(bytes(bad)))


def test_records_round_trip(spark, docs, rows, empty):
    lib, scratch = Tokenizer.from_file(WORD), Scratch(spark, "t")
    path = scratch.path("files")
    records.write_records(docs, path, WORD, text_bytes_per_file=20_000)
    index = scratch.save(records.build_index(scratch, path), "index")
    got = {r.doc_id: r for r in index.collect()}
    start, want = 0, {}
    for i, t, *_ in sorted(rows):
        want[i] = lib.encode(t or "", add_special_tokens=False).ids + [1]
        crc = zlib.crc32(np.array(want[i], "<u4").tobytes())
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (start, len(want[i]), crc)
        start += len(want[i])
    assert len({r.file for r in got.values()}) > 1
    some = index.where("doc_id % 3 = 0")  # a shuffled read of a few records
    assert {r.doc_id: r.ids for r in records.read_records(spark, some).collect()} == {i: x for i, x in want.items() if i % 3 == 0}
    none = scratch.path("none")
    records.write_records(empty, none, WORD)
    assert records.build_index(scratch, none).count() == 0


def test_null_ids_and_repeated_rows(spark):
    scratch = Scratch(spark, "t")
    df = spark.createDataFrame([(None, "a"), (3, "b c"), (3, "b c"), (-1, None)], "doc_id long, text string")
    path = scratch.path("files")
    records.write_records(df, path, WORD)
    got = sorted((r.start, r.doc_id, r.n_tokens) for r in records.build_index(scratch, path).collect())
    assert got == [(0, None, 2), (2, -1, 1), (3, 3, 3), (6, 3, 3)]
