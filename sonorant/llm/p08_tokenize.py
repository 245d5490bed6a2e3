"""Problem 8: token ids of a whole corpus by a public byte-level BPE vocabulary."""

from __future__ import annotations

import base64
import heapq
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from ..sources.files import open_input

TOKENIZERS = "/opt/tokenizers"
VOCABULARY = "byte_bpe_50k.tiktoken"

# Fixed value: how this family of vocabularies cuts text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Words and space-delimited parts whose ids a worker keeps. A full store is emptied, so memory is bounded on any corpus.
KEPT_WORDS = 300_000
#: Longer ones are not kept; they hardly ever repeat.
KEPT_CHARS = 40


class BytePairEncoder:
    """Merges by rank with a heap over a doubly linked list of symbols."""

    def __init__(self, vocabulary: bytes):
        self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())}
        self.pieces = {i: piece for piece, i in self.ranks.items()}
        self.cut = regex.compile(PATTERN).findall
        self.words: dict[str, tuple[int, ...]] = {}
        self.chunks: dict[str, tuple[int, ...]] = {}

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one word. Always the pair of least rank first, of equal pairs the leftmost.

        The heap holds (rank, start, end) of pairs, packed into one integer; an
        entry is stale, and skipped, when its first symbol is gone or its pair no
        longer ends there. A word of n bytes takes O(n log n), however long.
        """
        n, rank_of = len(piece), self.ranks.get
        bits = n.bit_length()
        low, both = (1 << bits) - 1, 2 * bits
        after = list(range(1, n + 1))  # start of the next symbol = end of this one
        before = list(range(-1, n))
        alive = bytearray(b"\1") * n
        heap = [
            (r << both) | (i << bits) | (i + 2)
            for i in range(n - 1)
            if (r := rank_of(piece[i : i + 2])) is not None
        ]
        heapq.heapify(heap)
        push, pop = heapq.heappush, heapq.heappop
        while heap:
            entry = pop(heap)
            end, i = entry & low, (entry >> bits) & low
            if not alive[i]:
                continue
            j = after[i]
            if j >= n or after[j] != end:
                continue
            alive[j] = 0
            after[i] = end
            before[end] = i
            if end < n:
                far = after[end]
                r = rank_of(piece[i:far])
                if r is not None:
                    push(heap, (r << both) | (i << bits) | far)
            p = before[i]
            if p >= 0:
                r = rank_of(piece[p:end])
                if r is not None:
                    push(heap, (r << both) | (p << bits) | end)
        out, i, ranks = [], 0, self.ranks
        while i < n:
            j = after[i]
            out.append(ranks[piece[i:j]])
            i = j
        return out

    def _word(self, word: str) -> tuple[int, ...]:
        ids = self.words.get(word)
        if ids is None:
            ids = tuple(self.merge(word.encode("utf-8", "surrogatepass")))
            if len(word) <= KEPT_CHARS:
                if len(self.words) >= KEPT_WORDS:
                    self.words.clear()
                self.words[word] = ids
        return ids

    def _slow(self, text: str) -> tuple[int, ...]:
        return tuple(chain.from_iterable(map(self._word, self.cut(text))))

    def _chunk(self, chunk: str) -> tuple[int, ...]:
        ids = self._slow(" " + chunk)
        if len(chunk) <= KEPT_CHARS:
            if len(self.chunks) >= KEPT_WORDS:
                self.chunks.clear()
            self.chunks[chunk] = ids
        return ids

    def parts(self, text: str) -> list[tuple[int, ...]]:
        """Ids of consecutive parts of a text.

        Where no two spaces meet, no word of the pattern has a space after its
        first character except white space that ends before one, so the text can
        be cut before every space and each part looked up whole.
        """
        if "  " in text:
            return [self._slow(text)]
        first, *rest = text.split(" ")
        known, new = self.chunks.get, self._chunk
        return [self._slow(first), *[known(w) or new(w) for w in rest]]

    def encode(self, text: str | None) -> list[int]:
        return list(chain.from_iterable(self.parts(text))) if text else []

    def count(self, text: str | None) -> int:
        return sum(map(len, self.parts(text))) if text else 0

    def decode(self, ids) -> str:
        return b"".join(self.pieces[int(i)] for i in ids).decode("utf-8", "replace")


def vocabulary(path: str) -> bytes:
    """A vocabulary file, read on the driver from any file system. Its size does not depend on the corpus, so it is broadcast."""
    with open_input(path) as f:
        return f.read()


@lru_cache(maxsize=2)
def _encoder(content: bytes) -> BytePairEncoder:
    """One for each Python worker and vocabulary."""
    return BytePairEncoder(content)


def encoder(path: str) -> BytePairEncoder:
    return _encoder(vocabulary(path))


def encode(df: DataFrame, key: str, text: str = "text", path: str = f"{TOKENIZERS}/{VOCABULARY}") -> DataFrame:
    """(key, ids): the ids of every text exactly as stored, without special tokens.

    Null and empty texts have the empty list; every row comes out, repeated
    ones and rows with a null key too. A map over Arrow batches: no shuffle.
    """

    held = df.sparkSession.sparkContext.broadcast(vocabulary(path))

    def run(batches):
        bpe = _encoder(held.value)
        for batch in batches:
            lists = [np.array(bpe.encode(t), np.int32) for t in batch.column(1).to_pylist()]
            ends = np.zeros(len(lists) + 1, np.int32)
            np.cumsum([len(x) for x in lists], out=ends[1:])
            flat = np.concatenate(lists) if lists else np.zeros(0, np.int32)
            ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], names=["k", "ids"])

    kind = df.schema[key].dataType.simpleString()
    out = df.select(F.col(key).alias("k"), F.col(text).cast("string").alias("t")).mapInArrow(run, f"k {kind}, ids array<int>")
    return out.select(F.col("k").alias(key), "ids")


def sizes(df: DataFrame, key: str, text: str = "text", path: str = f"{TOKENIZERS}/{VOCABULARY}") -> DataFrame:
    """(key, tokens): only the number of ids of every text."""

    held = df.sparkSession.sparkContext.broadcast(vocabulary(path))

    def run(batches):
        bpe = _encoder(held.value)
        for batch in batches:
            n = pa.array([bpe.count(t) for t in batch.column(1).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), n], names=["k", "tokens"])

    kind = df.schema[key].dataType.simpleString()
    out = df.select(F.col(key).alias("k"), F.col(text).cast("string").alias("t")).mapInArrow(run, f"k {kind}, tokens bigint")
    return out.select(F.col("k").alias(key), "tokens")


def decode(df: DataFrame, key: str, ids: str = "ids", path: str = f"{TOKENIZERS}/{VOCABULARY}") -> DataFrame:
    """(key, text): the inverse of encode, by concatenating vocabulary strings. Null ids give null."""

    held = df.sparkSession.sparkContext.broadcast(vocabulary(path))

    def run(batches):
        bpe = _encoder(held.value)
        for batch in batches:
            texts = [None if x is None else bpe.decode(x) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["k", "text"])

    kind = df.schema[key].dataType.simpleString()
    out = df.select(F.col(key).alias("k"), F.col(ids).alias("i")).mapInArrow(run, f"k {kind}, text string")
    return out.select(F.col("k").alias(key), "text")
