"""Encoding of whole texts by a public byte-level BPE vocabulary.

Words are cut by the vocabulary's pattern. A short word is held as one contiguous
array of part boundaries and one of the ranks that joining neighbouring parts would
have: the least rank is looked for, the boundary there is deleted and the two
neighbouring ranks are computed anew, until nothing can be joined. Words too long for scanning are
merged over a heap of the same ranks, to the same parts. Words met before are
remembered up to a bound.

Null and empty texts have no ids (an empty array). Nothing is trimmed or normalised.
"""

from __future__ import annotations

import base64
import heapq
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quaymark.session import heavy_partitions

#: Folder of the vocabulary files; the same path must hold on every executor.
TOKENIZERS = os.environ.get("QUAYMARK_TOKENIZERS", "/opt/tokenizers")
#: The published word pattern of the vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Words of more bytes than this are merged over a heap.
SHORT = 160
_NEVER = 1 << 30


def load_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a vocabulary file of base64 tokens and their ranks."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def merge_short(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a short word by the contiguous rank array."""
    bounds = list(range(len(word) + 1))
    joins = [ranks.get(word[i : i + 2], _NEVER) for i in range(len(word) - 1)]
    while joins:
        least = min(joins)
        if least == _NEVER:
            break
        i = joins.index(least)
        del bounds[i + 1], joins[i]
        if i < len(joins):
            joins[i] = ranks.get(word[bounds[i] : bounds[i + 2]], _NEVER)
        if i:
            joins[i - 1] = ranks.get(word[bounds[i - 1] : bounds[i + 1]], _NEVER)
    return [ranks[word[a:b]] for a, b in zip(bounds, bounds[1:])]


def merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a word of any length, in n log n: the same joins from a heap."""
    n = len(word)
    after, before, gone = list(range(1, n + 1)), list(range(-1, n - 1)), bytearray(n)

    def rank(i: int) -> int:
        j = after[i]
        return ranks.get(word[i : after[j]], _NEVER) if j < n else _NEVER

    heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank(i)) != _NEVER]
    heapq.heapify(heap)
    while heap:
        _, i, end = heapq.heappop(heap)
        # stale entries name a part that was joined meanwhile
        if gone[i] or after[i] >= n or after[after[i]] != end:
            continue
        j = after[i]
        gone[j] = 1
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
        for k in (before[i], i):
            if k >= 0 and (r := rank(k)) != _NEVER:
                heapq.heappush(heap, (r, k, after[after[k]]))
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i : after[i]]])
        i = after[i]
    return out


class Encoder:
    """Texts to ids by one vocabulary; ``remember`` bounds the words kept."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = PATTERN, remember: int = 200_000):
        self.ranks, self.words, self.remember = ranks, regex.compile(pattern), remember
        self.known: dict[str, list[int]] = {}

    def _word(self, word: str) -> list[int]:
        raw = word.encode("utf-8", "replace")
        whole = self.ranks.get(raw)
        ids = [whole] if whole is not None else (merge_short if len(raw) <= SHORT else merge_long)(raw, self.ranks)
        if len(raw) <= SHORT:
            if len(self.known) >= self.remember:
                self.known.clear()
            self.known[word] = ids
        return ids

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        known, out = self.known, []
        for word in self.words.findall(text):
            out += known.get(word) or self._word(word)
        return out


def vocabulary_path(name: str, folder: str | None = None) -> str:
    return f"{folder or TOKENIZERS}/{name}.tiktoken"


def spread(rows: DataFrame, key: str) -> DataFrame:
    """Rows spread over enough tasks for work that is heavy per row; only where reading them leaves cores idle.

    Files are read in at least one task per core as soon as there are so many times the cost of opening one
    (``spark.sql.files.openCostInBytes``), so texts of any size worth it stay where they are read.
    Less than that is moved, by a hash of ``key`` and ``text``, which makes the split the same in every attempt and
    keeps rows without key apart.
    """
    spark = rows.sparkSession
    size = int(str(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    opening = spark._jsparkSession.sessionState().conf().filesOpenCostInBytes()
    if size >= opening * spark.sparkContext.defaultParallelism:
        return rows
    return rows.repartition(heavy_partitions(spark), F.xxhash64(key, "text"))


def _encode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(load_ranks(path))
        for batch in batches:
            lists = [encoder.encode(t) for t in batch.column("text").to_pylist()]
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int32)
            flat = np.fromiter((i for x in lists for i in x), dtype=np.int32, count=int(offsets[-1]))
            yield pa.record_batch({"id": batch.column("id"), "ids": pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))})

    return run


def _count(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(load_ranks(path))
        for batch in batches:
            counts = [len(encoder.encode(t)) for t in batch.column("text").to_pylist()]
            yield pa.record_batch({"id": batch.column("id"), "source": batch.column("source"), "tokens": pa.array(counts, pa.int64())})

    return run


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = "byte_bpe_50k", folder: str | None = None) -> DataFrame:
    """``id_col`` and ``ids`` (array of int) of every document, repeated ids included."""
    rows = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return spread(rows, "id").mapInArrow(_encode(vocabulary_path(vocabulary, folder)), "id long, ids array<int>").withColumnRenamed("id", id_col)


def token_counts(docs: DataFrame, id_col: str, text_col: str, source: Column, vocabulary: str = "byte_bpe_50k", folder: str | None = None) -> DataFrame:
    """``id``, ``source`` and the number of ``tokens`` of every document."""
    rows = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), source.cast("string").alias("source"), F.col(f"`{text_col}`").alias("text"))
    return spread(rows, "id").mapInArrow(_count(vocabulary_path(vocabulary, folder)), "id long, source string, tokens long")
