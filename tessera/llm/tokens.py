"""Whole-text tokenisation through a bounded cache of pieces.

A text is cut where no token and no pre-tokeniser match can cross: before a
run of white space, between an ASCII letter and ASCII punctuation, and after
a single line break.  Ids of a text are then the ids of its pieces in order.
The rule holds for tokenisers whose pre-tokeniser separates white space,
letters and punctuation (both public BPE files do); ``PieceCache`` refuses
others.  Frequent pieces are encoded once per worker.
"""

from __future__ import annotations

import functools
import json
import os
from collections.abc import Callable
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa

from tessera.llm.words import LOWER, SPACE, U64, segment_hash, text_bytes

#: Kinds of bytes: lead bytes of characters of which some are white space are
#: MAYBE_SPACE; "|" is no PUNCT, as it stays inside special tokens such as <|endoftext|>.
WHITE, LETTER, PUNCT, MAYBE_SPACE = 1, 2, 3, 4
_kind = np.zeros(256, np.uint8)
_kind[SPACE] = WHITE
_kind[65:91] = _kind[97:123] = LETTER
for _a, _b in ((33, 48), (58, 65), (91, 97), (123, 127)):
    _kind[_a:_b] = PUNCT
_kind[ord("|")] = 0
_kind[[0xC2, 0xE1, 0xE2, 0xE3]] = MAYBE_SPACE
KIND = _kind.tobytes()


def cut(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """First bytes of the pieces of all texts, ascending."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64)
    kind = np.frombuffer(data.tobytes().translate(KIND), np.uint8)
    space = kind == WHITE
    at = np.zeros(n, bool)
    if n > 1:
        solid = ~space[:-1]
        solid[1:] &= ~((data[:-2] == 0xC2) & ((data[1:-1] == 0x85) | (data[1:-1] == 0xA0)))
        if n > 3:
            solid[2:] &= ~((data[:-3] >= 0xE1) & (data[:-3] <= 0xE3))
        run = space[1:] & solid
        at[1:] = run | ((kind[:-1] == LETTER) & (kind[1:] == PUNCT))
        at[2:] |= run[:-1] & (data[1:-1] == 10) & ~space[2:] & (kind[2:] != MAYBE_SPACE)
    at[off[:-1][off[:-1] < off[1:]]] = True
    return np.flatnonzero(at)


class PieceCache:
    """Ids of texts; at most about ``limit`` pieces are remembered.

    ``fold`` is for tokenisers that drop white space and ignore case: pieces
    are then looked up without their leading space and in lower case."""

    def __init__(self, encode_many: Callable[[list[str]], list], limit: int = 700_000, fold: bool = False):
        self.encode_many, self.limit, self.fold = encode_many, limit, fold
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(0, U64)         # ascending
        self.slot = np.zeros(0, np.int64)    # the list that a key stands for
        self.off = np.zeros(1, np.int64)     # list i is flat[off[i]:off[i + 1]]
        self.flat = np.zeros(0, np.uint32)

    def _learn(self, keys: np.ndarray, pieces: pa.LargeBinaryArray) -> None:
        got = self.encode_many(texts(pieces))
        lens = np.fromiter(map(len, got), np.int64, len(got))
        self._add(keys, np.fromiter(chain.from_iterable(got), np.uint32, int(lens.sum())), lens)

    def _add(self, keys: np.ndarray, flat: np.ndarray, lens: np.ndarray) -> None:
        where = np.searchsorted(self.keys, keys)
        self.slot = np.insert(self.slot, where, len(self.keys) + np.arange(len(keys)))
        self.keys = np.insert(self.keys, where, keys)
        self.flat = np.concatenate([self.flat, flat])
        self.off = np.concatenate([self.off, self.off[-1] + np.cumsum(lens)])

    def encode(self, col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order, and the n + 1 offsets of the texts into them."""
        data, off = text_bytes(col)
        start = cut(data, off)
        if not len(start):
            return np.zeros(0, np.uint32), np.zeros(len(off), np.int64)
        head = np.searchsorted(start, off)  # each text's first piece
        if self.fold:
            if b"<|" not in data.tobytes():  # special tokens keep their case
                data = LOWER[data]
            bare = SPACE[data[start]] & (np.diff(start, append=len(data)) > 1)
            keep = np.ones(len(data), bool)
            keep[start[bare]] = False
            data, start = data[keep], start - (np.cumsum(bare) - bare)
        # Equal pieces of these texts are found by Arrow; only distinct ones are hashed and looked up.
        ends = np.append(start, len(data))
        named = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(ends), pa.py_buffer(data)]).dictionary_encode()
        pieces, back = named.dictionary, named.indices
        raw, at = piece_bytes(pieces)
        keys = segment_hash(raw, at[:-1], at[1:])
        order = np.argsort(keys)  # near keys are looked up one after the other
        keys, rank = keys[order], np.argsort(order)
        if len(self.keys) + len(keys) > self.limit or len(self.flat) > 8 * self.limit:
            self.clear()
        pos = np.searchsorted(self.keys, keys)
        new = np.ones(len(keys), bool)
        old = pos < len(self.keys)
        new[old] = self.keys[pos[old]] != keys[old]
        if new.any():
            self._learn(keys[new], pieces.take(pa.array(order[new])))
            pos = np.searchsorted(self.keys, keys)
        lists = pa.LargeListArray.from_arrays(pa.array(self.off), pa.array(self.flat))
        lists = lists.take(pa.array(self.slot[pos][rank])).take(back)
        ids = np.frombuffer(lists.values.buffers()[1], np.uint32, len(lists.values)) if len(lists.values) else np.zeros(0, np.uint32)
        return ids, np.frombuffer(lists.buffers()[1], np.int64, len(lists) + 1)[head]


class JoinedCache(PieceCache):
    """For byte-level tokenisers without a normaliser, that only split.

    New pieces that begin with a blank and end with none are encoded several
    as one text: a match begins at each of their blanks.  ``size``, the bytes
    of text of each id, tells where a piece ends; should one not end with an
    id, all are encoded one by one, as other pieces always are."""

    JOINED = 16

    def __init__(self, encode_many: Callable[[list[str]], list], size: np.ndarray):
        super().__init__(encode_many)
        self.size = size

    def _learn(self, keys: np.ndarray, pieces: pa.LargeBinaryArray) -> None:
        data, at = piece_bytes(pieces)
        last, two, three = (data[np.maximum(at[1:] - k, 0)] for k in (1, 2, 3))
        blank = SPACE[last] | (two == 0xC2) & ((last == 0x85) | (last == 0xA0)) | (last >= 0x80) & (three >= 0xE1) & (three <= 0xE3)
        plain = (data[at[:-1]] == 32) & ~blank
        if plain.any() and not self._learn_joined(keys[plain], pieces.filter(pa.array(plain))):
            plain[:] = False
        if not plain.all():
            super()._learn(keys[~plain], pieces.filter(pa.array(~plain)))

    def _learn_joined(self, keys: np.ndarray, pieces: pa.LargeBinaryArray) -> bool:
        data, at = piece_bytes(pieces)
        got = self.encode_many(texts(pieces, self.JOINED))
        flat = np.fromiter(chain.from_iterable(got), np.uint32, sum(map(len, got)))
        done = np.cumsum(self.size[flat])
        last = np.searchsorted(done, at[1:])
        if last[-1] != len(flat) - 1 or (done[last] != at[1:]).any():
            return False
        self._add(keys, flat, np.diff(last, prepend=-1))
        return True


def piece_bytes(pieces: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all pieces and the offsets into them."""
    _, off, raw = pieces.buffers()
    off = np.frombuffer(off, np.int64, len(pieces) + 1, pieces.offset * 8)
    return np.frombuffer(raw, np.uint8)[off[0]:off[-1]], off - off[0]


def texts(pieces: pa.LargeBinaryArray, n: int = 1) -> list[str]:
    """Each ``n`` pieces as one text."""
    data, at = piece_bytes(pieces)
    raw, at = data.tobytes(), [*at[:-1:n].tolist(), len(data)]
    return [raw[a:b].decode("utf-8", "replace") for a, b in pairwise(at)]


#: Pre-tokenisers for which the cuts of ``cut`` are exact (fixed values).
KNOWN = ("ByteLevel", "Sequence")
CHUNK = 8192  # pieces that the library encodes at once


@functools.cache
def library_cache(path: str) -> PieceCache:
    """One cache per worker around the tokenizers library's file ``path``."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    steps = (spec["normalizer"] or {}).get("normalizers", [])
    splits = (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
    fold = (any(x["type"] == "Lowercase" for x in steps) and bool(splits)
            and splits[0]["type"] == "Split" and splits[0]["behavior"] == "Removed")
    if (spec["pre_tokenizer"] or {}).get("type") not in KNOWN:
        raise ValueError(f"no exact cuts are known for the pre-tokenizer of {path}")
    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()

    def encode_each(pieces: list[str]) -> list[list[int]]:
        return [e.ids for k in range(0, len(pieces), CHUNK)  # the library's results are large until read
                for e in tok.encode_batch_fast(pieces[k:k + CHUNK], add_special_tokens=False)]

    if spec["normalizer"] or spec["pre_tokenizer"]["type"] != "ByteLevel" or spec["pre_tokenizer"]["add_prefix_space"]:
        return PieceCache(encode_each, fold=fold)
    return JoinedCache(encode_each, token_bytes(spec))


def token_bytes(spec: dict) -> np.ndarray:
    """Bytes of text that each id of a byte-level tokeniser stands for."""
    size = {i: len(t) for t, i in spec["model"]["vocab"].items()}  # one character a byte
    size |= {t["id"]: len(t["content"].encode()) for t in spec["added_tokens"]}
    out = np.zeros(max(size) + 1, np.int64)
    out[list(size)] = list(size.values())
    return out


def vocab_size(path: str) -> int:
    with open(path, encoding="utf-8") as f:
        t = json.load(f)
    return 1 + max([*t["model"]["vocab"].values(), *(x["id"] for x in t["added_tokens"])])
