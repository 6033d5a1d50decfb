"""Byte-pair encoding as a bounded-lookahead transducer, and its decoder
(operator 6).

Encoding.  The pre-tokeniser's pattern runs over a text in blocks and hands
out a match once three more characters are known, which is as far as the
pattern looks past a match.  A match is merged in a window of bytes.  The merge
list fixes how far bytes to the right can matter: the merge (u, v) hinges on
higher-ranked merges (x, y) whose left side x ends where v ends, each of
which may hinge on others.  ``Merges.lookahead`` is the longest such chain in
bytes.  Tokens that end that far before the window's end are stable and are
emitted; the window goes on behind them, so memory does not grow with the text.

Decoding.  A state machine takes ids one block at a time and holds only the
bytes of an unfinished character; invalid bytes become U+FFFD.

A null text counts as empty and has no ids.  Special tokens inside a text are
found first, as the library does.  Rows are independent: repeated rows, null
doc_ids and other columns pass through a row-wise map.
"""

from __future__ import annotations

import codecs
import functools
import hashlib
import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.ship import ship
from tessera.llm.tokens import PieceCache
from tessera.llm.words import slices, text_column

#: The published split pattern of byte-level BPE (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters past a match that the pattern may look at.
PATTERN_LOOKS = 3
BLOCK_CHARS = 1 << 16
DECODE_IDS = 1 << 14


def byte_letters() -> dict[str, int]:
    """The vocabulary file's printable letter of each byte: printable Latin-1
    stands for itself, the rest for the letters from U+0100 on, in order."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


class Merges:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        if spec["normalizer"] is not None or spec["pre_tokenizer"]["type"] != "ByteLevel" \
                or spec["pre_tokenizer"]["add_prefix_space"]:
            raise ValueError(f"{path} is no plain byte-level BPE")
        letters, vocab = byte_letters(), spec["model"]["vocab"]
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.bytes = {i: bytes(letters[c] for c in t) for t, i in vocab.items()}
        self.bytes |= {i: t.encode() for t, i in self.special.items()}
        self.byte_id = [0] * 256
        for c, b in letters.items():
            self.byte_id[b] = vocab[c]
        self.rank: dict[tuple[int, int], tuple[int, int]] = {}
        for r, (a, b) in enumerate(spec["model"]["merges"]):
            self.rank[vocab[a], vocab[b]] = (r, vocab[a + b])
        self.made = [made for _, made in self.rank.values()]  # by rank
        self.none = (len(self.made), -1)
        self.lookahead = self._lookahead()
        self.window = max(4096, 4 * self.lookahead)

    def _lookahead(self) -> int:
        """Bytes to the right of a token boundary that can decide whether a
        merge crosses it (merges in rank order, so chains are complete)."""
        right = {made: pair[1] for pair, (_, made) in self.rank.items()}
        reach: dict[int, int] = {}  # left side -> longest chain of merges so far
        longest = 0
        for (u, v), _ in self.rank.items():
            chain, x = 0, v
            while x is not None:
                chain = max(chain, reach.get(x, 0))
                x = right.get(x)
            far = len(self.bytes[v]) + chain
            reach[u] = max(reach.get(u, 0), far)
            longest = max(longest, far)
        return longest

    def merge(self, data: bytes) -> list[int]:
        """Ids of one match: the best-ranked pair first, leftmost on ties."""
        ids = [self.byte_id[b] for b in data]
        rank, none = self.rank, self.none
        if len(ids) <= 64:
            ranks = [rank.get(p, none)[0] for p in zip(ids, ids[1:])]
            while ranks and (best := min(ranks)) < none[0]:
                k = ranks.index(best)
                ids[k:k + 2] = [self.made[best]]
                del ranks[k]
                if k:
                    ranks[k - 1] = rank.get((ids[k - 1], ids[k]), none)[0]
                if k < len(ranks):
                    ranks[k] = rank.get((ids[k], ids[k + 1]), none)[0]
            return ids
        after = [*range(1, len(ids)), -1]
        before = [*range(-1, len(ids) - 1)]
        heap = [(rank[p][0], k, p) for k, p in enumerate(zip(ids, ids[1:])) if p in rank]
        heapq.heapify(heap)
        while heap:
            _, k, pair = heapq.heappop(heap)
            n = after[k]
            if ids[k] is None or n < 0 or (ids[k], ids[n]) != pair:
                continue
            ids[k], ids[n] = rank[pair][1], None
            after[k] = after[n]
            if after[n] >= 0:
                before[after[n]] = k
            for a in (before[k], k):
                if a >= 0 and after[a] >= 0 and (p := (ids[a], ids[after[a]])) in rank:
                    heapq.heappush(heap, (rank[p][0], a, p))
        return [i for i in ids if i is not None]

    def transduce(self, data: bytes) -> Iterator[int]:
        """Ids of one match, emitted as they become stable."""
        at, width = 0, self.window
        while len(data) - at > width:
            end, stable = 0, []
            for i in self.merge(data[at:at + width]):
                end += len(self.bytes[i])
                if end > width - self.lookahead:
                    break
                stable.append(i)
            yield from stable
            at += sum(len(self.bytes[i]) for i in stable)
            width = self.window if stable else 2 * width
        yield from self.merge(data[at:])

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        for part in self._split(text):
            if part in self.special:
                out.append(self.special[part])
            else:
                for match in matches(part):
                    out.extend(self.transduce(match.encode("utf-8")))
        return out

    def _split(self, text: str) -> list[str]:
        if not any(s in text for s in self.special):
            return [text]
        return _special_pattern(tuple(self.special)).split(text)


@functools.cache
def _special_pattern(special: tuple[str, ...]):
    import regex
    return regex.compile("(" + "|".join(regex.escape(s) for s in sorted(special, key=len, reverse=True)) + ")")


@functools.cache
def _pattern():
    import regex
    return regex.compile(PATTERN)


def matches(text: str, block: int = BLOCK_CHARS) -> Iterator[str]:
    """The pattern's matches, found block by block."""
    at, size = 0, block
    while len(text) - at > size:
        part = text[at:at + size]
        end = 0
        for m in _pattern().finditer(part):
            if m.end() > size - PATTERN_LOOKS:
                break
            yield m.group()
            end = m.end()
        at += end
        size = block if end else 2 * size
    yield from _pattern().findall(text[at:])


@functools.cache
def merges(path: str) -> Merges:
    return Merges(path)


@functools.cache
def piece_cache(path: str) -> PieceCache:
    m = merges(path)
    return PieceCache(lambda pieces: [m.encode(p) for p in pieces])


class Decoder:
    """Ids to text, block by block; holds at most an unfinished character."""

    def __init__(self, table: dict[int, bytes]):
        self.table = table
        self.state = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: list[int], final: bool = False) -> str:
        return self.state.decode(b"".join(map(self.table.__getitem__, ids)), final)


def encode_column(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, ids (array of int) of every text."""
    def run(batches):
        cache = piece_cache(tokenizer)
        for batch in batches:
            for part in slices(batch, "text"):
                ids, off = cache.encode(part.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(ids.astype(np.int32)))],
                    ["doc_id", "ids"])

    return docs.select("doc_id", text_column(docs)).mapInArrow(run, "doc_id long, ids array<int>")


def digests(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Encode and decode every text in one pass; digests of both results."""
    def run(batches):
        cache, table = piece_cache(tokenizer), merges(tokenizer).bytes
        for batch in batches:
            for part in slices(batch, "text"):
                ids, off = cache.encode(part.column("text"))
                raw, a, b = ids.astype("<u4"), [], []
                for lo, hi in zip(off[:-1].tolist(), off[1:].tolist()):
                    a.append(hashlib.sha256(raw[lo:hi].tobytes()).hexdigest())
                    decoder, sha = Decoder(table), hashlib.sha256()
                    for k in range(lo, hi, DECODE_IDS):
                        sha.update(decoder.feed(ids[k:min(hi, k + DECODE_IDS)].tolist()).encode("utf-8"))
                    sha.update(decoder.feed([], True).encode("utf-8"))
                    b.append(sha.hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(np.diff(off), pa.int64()), pa.array(a), pa.array(b)],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_column(docs))
            .mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ship(spark)
    return digests(spark.read.parquet(f"{sf_dir}/documents.parquet"),
                   public_tokenizers.path("byte_bpe_50k.json"))
