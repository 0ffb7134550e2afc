"""Substring dedup: fixed-block anchors, extended to maximal exact repeats.

A run of ``width`` words always holds a whole block of its document, when blocks
of (width + 1) / 2 words follow each other without gaps. So each document's
blocks are the index and every rolling window of a block's length is a probe:
both meet in hash ranges, as 31-bit remainders that travel once per chunk, and
the places where another document has the same words come back (``anchors``).
Around anchors the exact runs of ``width`` words are compared under 128-bit
hashes; what a document with a smaller id has too is removed. Overlapping runs
join to the maximal repeat.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (
    Vocabulary,
    broadcast_if_small,
    buckets_of,
    chunks,
    gives_back,
    packed,
    ranges as hash_ranges,
    unpacked,
    window_hashes,
    window_starts,
    written,
)

REQUEST = "bucket int, chunk bigint, first binary, second binary, base bigint, owner binary, places binary, own binary"
ANSWER = "chunk bigint, places binary, own binary"
RANGES = "id bigint, mark bigint, ranges array<int>"
KINDS = [pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]


class Chunk:
    """A chunk of documents as word hashes, and what travels with it to be put together again."""

    def __init__(self, vocabulary: Vocabulary, ids: list[int], texts: list[bytes], marks: list[int]):
        self.ids = np.array(ids, dtype=np.int64)
        self.marks = np.array(marks, dtype=np.int64)
        self.words, self.counts = vocabulary.hashes([t.split() for t in texts])
        self.begins = np.cumsum(self.counts) - self.counts

    def own(self, places: np.ndarray) -> bytes:
        """Documents and places already decided, for the one who gathers the answers."""
        head = np.array([len(self.ids)], dtype=np.int64)
        return b"".join(x.astype(np.int64).tobytes() for x in (head, self.ids, self.marks, self.counts, places))


def _rows(key: int, buckets: int, own: bytes, requests: list[tuple]) -> pa.RecordBatch:
    """One row for the chunk itself, one for each hash range asked."""
    rows = [(key % buckets, key, b"", b"", 0, b"", b"", own), *requests]
    names = ["bucket", "chunk", "first", "second", "base", "owner", "places", "own"]
    columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), KINDS, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names=names)


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[list]]]:
    """Chunks with a key that a task run again gives them again."""
    for k, chunk in enumerate(chunks(batches)):
        yield TaskContext.get().partitionId() << 32 | k, chunk


def ask_anchors(width: int, buckets: int) -> Callable:
    block = (width + 1) // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary()
        for key, (ids, texts, marks) in _numbered(batches):
            c = Chunk(vocabulary, ids, texts, marks)
            starts, doc = window_starts(c.counts, block)
            long = c.counts[doc] >= width
            starts, doc = starts[long], doc[long]
            hashes = window_hashes(c.words, block)[starts]
            indexed = (starts - c.begins[doc]) % block == 0
            order = np.argsort(hashes, kind="stable")
            ordered = hashes[order]
            first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(order) else order
            last = np.append(first[1:], len(order)) - 1
            several = c.ids[doc[order[first]]] != c.ids[doc[order[last]]]
            local = np.zeros(len(order), dtype=bool)
            local[order] = np.repeat(several, last - first + 1)
            has_block = np.logical_or.reduceat(indexed[order], first) if len(first) else several
            common = ordered[first[several]]
            remainder = lambda h, b: (h.astype(np.uint32) & np.uint32(0xFFFFFFFE)) | b.astype(np.uint32)
            common_told = remainder(common, has_block[several])
            alone = np.flatnonzero(~local)
            bucket = buckets_of(hashes[alone], buckets)
            alone = alone[np.argsort(bucket.astype(np.uint32), kind="stable")]
            edges = np.arange(buckets + 1)
            at = np.searchsorted(buckets_of(hashes[alone], buckets), edges)
            upto = np.searchsorted(buckets_of(common, buckets), edges)
            told = remainder(hashes[alone], indexed[alone])
            places = starts[alone]
            requests = []
            for b in range(buckets):
                s, t = slice(at[b], at[b + 1]), slice(upto[b], upto[b + 1])
                if at[b] == at[b + 1] and upto[b] == upto[b + 1]:
                    continue
                base, gaps = packed(np.diff(places[s], prepend=0))
                requests.append((b, key, told[s].tobytes(), common_told[t].tobytes(), base, b"", gaps, b""))
            yield _rows(key, buckets, c.own(starts[local]), requests)

    return run


def answer_anchors(table: pa.Table) -> pa.Table:
    rows = table.to_pylist()
    single = [np.frombuffer(r["first"], dtype=np.uint32) for r in rows]
    common = [np.frombuffer(r["second"], dtype=np.uint32) for r in rows]
    places = [
        np.cumsum(unpacked(r["base"], r["places"], len(s))).astype(np.uint32) for r, s in zip(rows, single, strict=True)
    ]
    sizes = [len(s) for s in single]
    told = np.concatenate([*single, *common])
    total = sum(sizes)
    # Where an entry comes from; one that several documents of a chunk share counts as two sources.
    source = np.concatenate([np.repeat(np.arange(len(rows)), sizes), np.full(len(told) - total, -1)])
    value = told >> np.uint32(1)
    order = np.argsort(value, kind="stable")
    hit = np.zeros(len(told), dtype=bool)
    if len(order):
        ordered = value[order]
        first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
        length = np.diff(np.append(first, len(order)))
        from_ = source[order]
        low, high = np.minimum.reduceat(from_, first), np.maximum.reduceat(from_, first)
        block = np.bitwise_or.reduceat(told[order] & np.uint32(1), first) > 0
        hit[order] = np.repeat(((low != high) | (low < 0)) & block, length)
    return _answers(rows, [p[h] for p, h in zip(places, np.split(hit[:total], np.cumsum(sizes)[:-1]), strict=True)])


def _answers(rows: list[dict], places: list[np.ndarray]) -> pa.Table:
    kept = [(r["chunk"], p.astype(np.uint32).tobytes(), r["own"]) for r, p in zip(rows, places, strict=True) if len(p) or r["own"]]
    columns = list(zip(*kept, strict=True)) or [(), (), ()]
    return pa.table([pa.array(x, k) for x, k in zip(columns, [pa.int64(), pa.binary(), pa.binary()], strict=True)], names=["chunk", "places", "own"])


def gather(width: int, anchors: bool) -> Callable:
    """Per document: ranges of the runs to compare that begin near an anchor, or of the words to remove."""

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        own = np.frombuffer(next(r["own"] for r in rows if r["own"]), dtype=np.int64)
        n = int(own[0])
        ids, marks, counts = own[1 : 1 + n], own[1 + n : 1 + 2 * n], own[1 + 2 * n : 1 + 3 * n]
        total = int(counts.sum())
        hit = np.zeros(total + width, dtype=np.int64)
        hit[own[1 + 3 * n :]] = 1
        for r in rows:
            hit[np.frombuffer(r["places"], dtype=np.uint32)] = 1
        sums = np.concatenate([[0], np.cumsum(hit)])
        at = np.arange(total)
        ends = np.cumsum(counts)
        doc = np.repeat(np.arange(n), counts)
        begins = (ends - counts)[doc] if total else at
        if anchors:
            inside = (sums[at + (width + 1) // 2] > sums[at]) & (at + width <= ends[doc])
        else:
            inside = sums[at + 1] > sums[np.maximum(at - width + 1, begins)]
        edge = np.diff(np.concatenate([[0], inside.astype(np.int8), [0]]))
        fresh = np.concatenate([[False], inside[1:] & inside[:-1] & (doc[1:] != doc[:-1])]) if total else inside
        start = np.flatnonzero((edge[:-1] > 0) | fresh)
        end = np.flatnonzero((edge[1:] < 0) | np.concatenate([fresh[1:], [False]])) + 1 if total else start
        owner = doc[start]
        pairs = np.stack([start - begins[start], end - begins[start]], axis=1).astype(np.int32) if total else np.zeros((0, 2), np.int32)
        which, lengths = np.unique(owner, return_counts=True)
        lists = pa.ListArray.from_arrays(
            pa.array(np.concatenate([[0], np.cumsum(2 * lengths)]), pa.int32()), pa.array(pairs.reshape(-1), pa.int32())
        )
        return pa.table([pa.array(ids[which]), pa.array(marks[which]), lists], names=["id", "mark", "ranges"])

    return run


def ask_runs(width: int, buckets: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary()
        for key, (ids, texts, marks, ranges) in _numbered(batches):
            c = Chunk(vocabulary, ids, texts, marks)
            inside = np.zeros(len(c.words) + 1, dtype=np.int64)
            for begin, r in zip(c.begins.tolist(), ranges, strict=True):
                np.add.at(inside, np.array(r[::2], dtype=np.int64) + begin, 1)
                np.add.at(inside, np.array(r[1::2], dtype=np.int64) + begin, -1)
            places = np.flatnonzero(np.cumsum(inside) > 0)
            doc = np.repeat(np.arange(len(ids)), c.counts)[places]
            one, two = (window_hashes(c.words, width, salt)[places] for salt in (0, 1))
            owner = c.ids[doc]
            order = np.lexsort((owner, two, one))
            one, two, owner, places = one[order], two[order], owner[order], places[order]
            if len(order):
                first = np.flatnonzero(np.concatenate([[True], (one[1:] != one[:-1]) | (two[1:] != two[:-1])]))
                later = owner > np.repeat(owner[first], np.diff(np.append(first, len(order))))
            else:
                later = np.zeros(0, dtype=bool)
            local = places[later]
            one, two, owner, places = one[~later], two[~later], owner[~later], places[~later]
            at = np.searchsorted(buckets_of(one, buckets), np.arange(buckets + 1))
            requests = []
            for b in np.flatnonzero(np.diff(at)).tolist():
                s = slice(at[b], at[b + 1])
                base, packed_ids = packed(owner[s])
                requests.append(
                    (b, key, one[s].tobytes(), two[s].tobytes(), base, packed_ids, places[s].astype(np.uint32).tobytes(), b"")
                )
            yield _rows(key, buckets, c.own(local), requests)

    return run


def answer_runs(table: pa.Table) -> pa.Table:
    rows = table.to_pylist()
    one = [np.frombuffer(r["first"], dtype=np.uint64) for r in rows]
    sizes = [len(x) for x in one]
    owners = [unpacked(r["base"], r["owner"], n) for r, n in zip(rows, sizes, strict=True)]
    one, owner = np.concatenate(one), np.concatenate(owners)
    two = np.concatenate([np.frombuffer(r["second"], dtype=np.uint64) for r in rows])
    order = np.lexsort((owner, two, one))
    later = np.zeros(len(order), dtype=bool)
    if len(order):
        a, b, o = one[order], two[order], owner[order]
        first = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
        later[order] = o > np.repeat(o[first], np.diff(np.append(first, len(order))))
    places = [np.frombuffer(r["places"], dtype=np.uint32) for r in rows]
    return _answers(rows, [p[h] for p, h in zip(places, np.split(later, np.cumsum(sizes)[:-1]), strict=True)])


def repeated_ranges(texts: DataFrame, width: int) -> DataFrame:
    """(id, mark, ranges): the words to remove, as start, end, start, end..., of each (id, text, mark) that has some."""
    # a window's remainder and place take six bytes for some seven of text
    buckets = hash_ranges(texts, 0.85)
    asked = texts.mapInArrow(gives_back(ask_anchors(width, buckets)), REQUEST)
    answers = asked.groupBy("bucket").applyInArrow(gives_back(answer_anchors), ANSWER)
    near = answers.groupBy("chunk").applyInArrow(gives_back(gather(width, True)), RANGES)
    near = written(near.groupBy("id", "mark").agg(F.max("ranges").alias("ranges")), "anchors")
    found = texts.join(broadcast_if_small(near, 16 + 4 * F.size("ranges")), ["id", "mark"])
    asked = found.select("id", "text", "mark", "ranges").mapInArrow(gives_back(ask_runs(width, buckets)), REQUEST)
    answers = asked.groupBy("bucket").applyInArrow(gives_back(answer_runs), ANSWER)
    repeats = answers.groupBy("chunk").applyInArrow(gives_back(gather(width, False)), RANGES)
    return written(repeats.groupBy("id", "mark").agg(F.max("ranges").alias("ranges")), "repeats")


def remove_repeats(docs: DataFrame, width: int = 13, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_removed, kept_text, ranges) for each row of ``docs`` that has an id.

    Words are split at ASCII white space and compared as they are. A word goes if
    a run of ``width`` words around it also occurs in a document with a smaller
    id, whatever is left of that one; ``ranges`` has the words that go, as start, end,
    start, end.... The kept words are joined by one blank.
    A missing or empty text, or one shorter than a run, loses nothing. Rows without an
    id are left out. Several rows of one id are parts of one document, which
    does not lose what only it has; each comes out as often as it goes in. Other
    columns are not read.
    """
    texts = docs.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("bigint").alias("id"),
        F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("text"),
        F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("mark"),
    )
    repeats = repeated_ranges(texts, width)
    joined = texts.join(broadcast_if_small(repeats, 16 + 4 * F.size("ranges")), ["id", "mark"], "left")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts, ranges in chunks(batches):
            words, removed, kept = [], [], []
            for text, r in zip(texts, ranges, strict=True):
                own = text.split()
                words.append(len(own))
                for start, end in zip(r[-2::-2] if r else (), r[::-2] if r else (), strict=True):
                    del own[start:end]
                removed.append(words[-1] - len(own))
                kept.append(b" ".join(own))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()), pa.array(words, pa.int64()), pa.array(removed, pa.int64()),
                    pa.array(kept, pa.binary()).cast(pa.string()), pa.array(ranges, pa.list_(pa.int32())),
                ],
                names=["id", "n_words", "n_removed", "kept_text", "ranges"],
            )

    rows = joined.select("id", "text", "ranges").mapInArrow(
        cut, "id bigint, n_words bigint, n_removed bigint, kept_text string, ranges array<int>"
    )
    return rows.withColumnRenamed("id", id_col)
