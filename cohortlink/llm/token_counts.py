"""Token counts of byte-level pair merging, by a heap over a linked list of symbols."""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: how the byte-level scheme splits a text before merging.
PIECE_PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
CACHED_PIECES = 300_000


def byte_letters() -> list[str]:
    """The letter that stands for each byte in vocabulary files.

    Bytes that print in Latin-1 stand for themselves; the others follow from 256 on.
    """
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


def count_after_merges(symbols: list[str], ranks: dict[tuple[str, str], int]) -> int:
    """Symbols left after merging: the adjacent pair of the lowest rank first, the leftmost of equals.

    The heap holds (rank, place); the list of symbols is linked both ways. An
    entry whose pair is no longer there is passed over. No token is looked up.
    """
    n = len(symbols)
    symbols = symbols[:]
    after = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    heap = []
    for i in range(n - 1):
        rank = ranks.get((symbols[i], symbols[i + 1]))
        if rank is not None:
            heap.append((rank, i))
    heapify(heap)
    merges = 0
    while heap:
        rank, i = heappop(heap)
        j = after[i]
        if not symbols[i] or j >= n or ranks.get((symbols[i], symbols[j])) != rank:
            continue
        symbols[i] += symbols[j]
        symbols[j] = ""
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            rank = ranks.get((symbols[i], symbols[k]))
            if rank is not None:
                heappush(heap, (rank, i))
        h = before[i]
        if h >= 0:
            rank = ranks.get((symbols[h], symbols[i]))
            if rank is not None:
                heappush(heap, (rank, h))
        merges += 1
    return n - merges


class TokenCounter(dict):
    """Piece of text to its number of tokens, remembered up to a bound."""

    def __init__(self, file: str):
        super().__init__()
        with open(file, encoding="utf-8") as f:
            spec = json.load(f)
        model, split = spec["model"], spec["pre_tokenizer"] or {}
        if (
            model["type"] != "BPE" or split.get("type") != "ByteLevel" or spec["normalizer"]
            or split.get("add_prefix_space") or not split.get("use_regex", True) or model.get("ignore_merges")
            or model.get("continuing_subword_prefix") or model.get("end_of_word_suffix")
        ):
            raise ValueError(f"{file} is not a plain byte-level merge vocabulary")
        pairs = (tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"])
        self.ranks = {pair: rank for rank, pair in enumerate(pairs)}
        self.letters = byte_letters()
        self.pieces = regex.compile(PIECE_PATTERN).findall
        added = sorted((t["content"] for t in spec.get("added_tokens", [])), key=len, reverse=True)
        self.added = regex.compile("|".join(map(regex.escape, added))) if added else None

    def __missing__(self, piece: str) -> int:
        if len(self) >= CACHED_PIECES:
            self.clear()
        letters = self.letters
        count = self[piece] = count_after_merges([letters[b] for b in piece.encode()], self.ranks)
        return count

    def count(self, text: str) -> int:
        if self.added is None:
            return sum(map(self.__getitem__, self.pieces(text)))
        total = start = 0
        for found in self.added.finditer(text):
            total += 1 + sum(map(self.__getitem__, self.pieces(text[start : found.start()])))
            start = found.end()
        return total + sum(map(self.__getitem__, self.pieces(text[start:] if start else text)))


@lru_cache(maxsize=2)
def _counter(file: str) -> TokenCounter:
    return TokenCounter(SparkFiles.get(file[6:]) if file.startswith("spark:") else file)


def count_tokens(
    docs: DataFrame, vocabulary: str, limit: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) for each row of ``docs``, whole texts, no truncation.

    ``vocabulary`` is a tokenizer file that exists on each machine, or
    ``spark:<name>`` for one sent with ``SparkContext.addFile``. Strings of added
    tokens inside a text count one token each, the default of the library.
    A missing or empty text has no bytes and no tokens; a row without an id is
    counted like any other; repeated rows come out as often as they go in; other
    columns of ``docs`` are not read. No row moves between machines.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(vocabulary)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            counts = [counter.count(t) if t else 0 for t in texts]
            sizes = [len(t.encode()) if t else 0 for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64())],
                names=["id", "n_bytes", "n_tokens"],
            )

    counted = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    counted = counted.mapInArrow(run, "id bigint, n_bytes bigint, n_tokens bigint")
    return counted.select(
        F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
