"""LM scoring: cross-entropy difference of a target and a background bigram model over one vocabulary.

Both models are p(w | u) = (c(u, w) + a) / (c(u) + a * V), with the same a and V,
over counts of the target documents and of all others; the latter are scaled
to as many words as the target has. V is the size of the vocabulary that both share: the distinct
words of all documents, built in the first scan, and one unknown word. The logarithm parts into a term for the
bigram and one for its context, so each can be computed where the counts of that
one gram come together. Grams meet in hash ranges, packed; what comes back
is a sum per document. Grams that make up more than a given share of all text are counted
in a scan of their own and scored where the text is: they would otherwise pile up.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (
    MULTIPLIER,
    Vocabulary,
    broadcast_if_small,
    buckets_of,
    chunks,
    gives_back,
    mix,
    ranges,
    written,
)

START = np.uint64(0x5BD1E995)
# A gram with this share of all grams of its kind is hot; there are at most
# 1 / share of them. Chunks report what has half the share there, so that none is missed.
HOT_SHARE = 1 / 2000
# Documents of a chunk are numbered in 15 bits, the 16th marks the target.
DOCS = 30_000


@dataclass(frozen=True)
class Settings:
    smoothing: float
    vocabulary: int
    scale: float

    def value(self, grams: np.ndarray, own: np.ndarray, mine: np.ndarray, target, every) -> np.ndarray:
        """Part of the loss difference of grams, 1 for a bigram and 0 for a context, seen ``own`` times in the document.

        ``every`` counts all documents, ``target`` those of the target, ``mine`` is ``own`` in
        one of these and else 0. The document's own occurrences are taken off its model's counts.
        """
        background = every - target - (own - mine)
        flat = np.where(grams == 1, self.smoothing, self.smoothing * self.vocabulary)
        difference = np.log(self.scale * background + flat) - np.log(target - mine + flat)
        return own * np.where(grams == 1, difference, -difference)


def grams_of(words: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word's bigram, the lowest bit 1, and of its context, the lowest bit 0."""
    before = np.empty_like(words)
    before[1:] = words[:-1]
    begins = np.cumsum(counts) - counts
    before[begins[counts > 0]] = START
    one = np.uint64(1)
    return mix(before * MULTIPLIER + words, 13) | one, mix(before, 11) & ~one


# Text that a numpy pass works on, and words remembered: a pass takes some 60 bytes for each of text.
CHUNK, WORDS = 3 * 1024 * 1024, 200_000


def _scan(batches: Iterator[pa.RecordBatch]):
    vocabulary = Vocabulary(WORDS)
    for k, (ids, texts, target) in enumerate(chunks(batches, CHUNK, DOCS)):
        words, counts = vocabulary.hashes([t.lower().split() for t in texts])
        doc = np.repeat(np.arange(len(ids)), counts)
        yield k, np.array(ids, dtype=np.int64), np.array(target, dtype=bool), counts, doc, grams_of(words, counts), words


def word_totals(texts: DataFrame) -> tuple[int, int, int, list[int]]:
    """Words of the target, words of all, distinct words of all, and the grams that may be hot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, target, counts, _, kinds, words in _scan(batches):
            hashes, numbers = [np.zeros(1, np.uint64)], [np.array([counts[target].sum()])]
            for grams in kinds:
                value, n = np.unique(grams, return_counts=True)
                often = n > HOT_SHARE / 2 * max(len(grams), 2 / HOT_SHARE)
                hashes.append(value[often])
                numbers.append(n[often])
            # the hash 0 stands for the words of the target, 1 for all words
            hashes.append(np.ones(1, np.uint64))
            numbers.append(np.array([counts.sum()]))
            # words of the vocabulary, which need no count
            entries = np.unique(words)
            n_grams = sum(map(len, hashes))
            hashes.append(entries)
            numbers.append(np.zeros(len(entries), dtype=np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(n_grams + len(entries)) >= n_grams),
                    pa.array(np.concatenate(hashes).view(np.int64)),
                    pa.array(np.concatenate(numbers), pa.int64()),
                ],
                names=["word", "gram", "n"],
            )

    sums = texts.mapInArrow(gives_back(run), "word boolean, gram bigint, n bigint")
    sums = written(sums.groupBy("word", "gram").agg(F.sum("n").alias("n")), "hot")
    totals = {r[0]: r[1] for r in sums.where("not word and gram in (0, 1)").select("gram", "n").collect()}
    every = totals.get(1, 0)
    # at most 2 / share grams of either kind pass
    hot = sums.where(~F.col("word") & ~F.col("gram").isin(0, 1) & (F.col("n") >= HOT_SHARE / 2 * every)).select("gram")
    return totals.get(0, 0), every, sums.where("word").count(), sorted(r[0] for r in hot.collect())


def hot_counts(texts: DataFrame, hot: list[int]) -> dict[int, tuple[int, int]]:
    """Occurrences of the hot grams in the target and in all documents."""
    if not hot:
        return {}
    wanted = np.sort(np.array(hot, dtype=np.int64).view(np.uint64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((2, len(wanted)), dtype=np.int64)
        for _, _, target, _, doc, kinds, _ in _scan(batches):
            for grams in kinds:
                place = np.minimum(np.searchsorted(wanted, grams), len(wanted) - 1)
                found = wanted[place] == grams
                totals[0] += np.bincount(place[found & target[doc]], minlength=len(wanted))
                totals[1] += np.bincount(place[found], minlength=len(wanted))
        yield pa.RecordBatch.from_arrays(
            [pa.array(wanted.view(np.int64)), pa.array(totals[0]), pa.array(totals[1])], names=["gram", "t", "b"]
        )

    rows = texts.mapInArrow(gives_back(run), "gram bigint, t bigint, b bigint").groupBy("gram").agg(F.sum("t"), F.sum("b"))
    return {r[0]: (r[1], r[2]) for r in rows.collect()}


REQUEST = "bucket int, chunk bigint, low binary, high binary, owner binary, times binary, own binary"
ANSWER = "chunk bigint, owner binary, sums binary, own binary"


def score_documents(
    docs: DataFrame,
    target_ids: DataFrame,
    smoothing: float = 0.1,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id, n_words, loss_difference): nats per word that the target model loses more than the background model.

    Lower is more like the target, which is the documents whose id is in
    ``target_ids``; the background is the rest of ``docs``. Words are lower-cased in A-Z and
    split at ASCII white space; a document's own words are left out of the counts
    of its model. Without other documents the background knows no word. Grams are told apart by hash range and a 40-bit remainder.
    A missing or empty text has no words and difference 0; without target documents
    all differences are finite and unfavourable alike. Rows without an id are left out; repeated rows count
    as documents of their own and come out as often as they go in. Other columns are not read.
    """
    ids = written(target_ids.select(F.col(id_col).cast("bigint").alias("id")).where("id is not null").distinct(), "target")
    texts = docs.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("binary").alias("text")
    )
    marked = broadcast_if_small(ids, 8)
    texts = texts.join(marked.withColumn("target", F.lit(True)), "id", "left")
    texts = texts.select("id", "text", F.coalesce("target", F.lit(False)).alias("target"))
    in_target, every, words, hot = word_totals(texts)
    settings = Settings(smoothing, words + 1, in_target / max(1, every - in_target))
    counted = hot_counts(texts, hot)
    known = np.sort(np.array(list(counted), dtype=np.int64).view(np.uint64))
    hot_target, hot_all = (
        np.array([counted[int(g)][k] for g in known.view(np.int64)], dtype=np.float64) for k in (0, 1)
    )
    # two kinds of gram a word, of some seven bytes of text, and seven bytes each
    buckets = ranges(texts, 2.0)

    def request(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, ids, target, counts, doc, kinds, _ in _scan(batches):
            key = TaskContext.get().partitionId() << 32 | number
            sums = np.zeros(len(ids))
            parts = []
            for grams in kinds:
                order = np.argsort(grams, kind="stable")
                g, d = grams[order], doc[order]
                first = np.flatnonzero(np.concatenate([[True], (g[1:] != g[:-1]) | (d[1:] != d[:-1])])) if len(g) else order
                times = np.diff(np.append(first, len(g)))
                g, d = g[first], d[first]
                if len(known) and len(g):
                    place = np.minimum(np.searchsorted(known, g), len(known) - 1)
                    is_hot = known[place] == g
                    p, own = place[is_hot], times[is_hot].astype(np.float64)
                    mine = own * target[d[is_hot]]
                    kind = (g[is_hot] & np.uint64(1)).astype(np.int64)
                    value = settings.value(kind, own, mine, hot_target[p], hot_all[p])
                    sums += np.bincount(d[is_hot], weights=value, minlength=len(ids))
                    g, d, times = g[~is_hot], d[~is_hot], times[~is_hot]
                parts.append((g, d, times))
            g, d, times = (np.concatenate(x) for x in zip(*parts, strict=True))
            order = np.argsort(buckets_of(g, buckets).astype(np.uint32), kind="stable")
            g, d, times = g[order], d[order], times[order]
            at = np.searchsorted(buckets_of(g, buckets), np.arange(buckets + 1))
            head = np.array([len(ids)], dtype=np.int64)
            own = b"".join(x.tobytes() for x in (head, ids, counts.astype(np.int64), sums))
            rows = [(key % buckets, key, b"", b"", b"", b"", own)]
            owner = (d | np.where(target[d], 0x8000, 0)).astype(np.uint16)
            for b in np.flatnonzero(np.diff(at)).tolist():
                s = slice(at[b], at[b + 1])
                more = np.flatnonzero(times[s] > 1)
                repeats = np.stack([more, times[s][more]]).astype(np.uint32)
                low, high = g[s].astype(np.uint32), (g[s] >> np.uint64(32)).astype(np.uint8)
                rows.append((b, key, low.tobytes(), high.tobytes(), owner[s].tobytes(), repeats.tobytes(), b""))
            types = [pa.int32(), pa.int64(), *[pa.binary()] * 5]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)],
                names=["bucket", "chunk", "low", "high", "owner", "times", "own"],
            )

    def answer(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        high = [np.frombuffer(r["high"], dtype=np.uint8) for r in rows]
        sizes = np.array([len(x) for x in high])
        grams = np.concatenate(high).astype(np.uint64) << np.uint64(32)
        grams |= np.concatenate([np.frombuffer(r["low"], dtype=np.uint32) for r in rows])
        owner = np.concatenate([np.frombuffer(r["owner"], dtype=np.uint16) for r in rows])
        own = np.ones(len(owner))
        for r, start in zip(rows, (np.cumsum(sizes) - sizes).tolist(), strict=True):
            place, times = np.frombuffer(r["times"], dtype=np.uint32).reshape(2, -1)
            own[place + start] = times
        order = np.argsort(grams, kind="stable")
        g = grams[order]
        first = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]])) if len(g) else order
        mine = own * (owner >= 0x8000)
        target, all_ = np.empty(len(g)), np.empty(len(g))
        if len(g):
            length = np.diff(np.append(first, len(g)))
            target[order] = np.repeat(np.add.reduceat(mine[order], first), length)
            all_[order] = np.repeat(np.add.reduceat(own[order], first), length)
        value = settings.value((grams & np.uint64(1)).astype(np.int64), own, mine, target, all_)
        told = []
        for r, o, v in zip(rows, np.split(owner & 0x7FFF, np.cumsum(sizes)[:-1]), np.split(value, np.cumsum(sizes)[:-1]), strict=True):
            sums = np.bincount(o, weights=v) if len(o) else np.zeros(0)
            some = np.flatnonzero(sums)
            told.append((r["chunk"], some.astype(np.uint16).tobytes(), sums[some].tobytes(), r["own"]))
        types = [pa.int64(), *[pa.binary()] * 3]
        return pa.table(
            [pa.array(c, t) for c, t in zip(zip(*told, strict=True), types, strict=True)],
            names=["chunk", "owner", "sums", "own"],
        )

    def gather(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        own = next(r["own"] for r in rows if r["own"])
        n = int(np.frombuffer(own, dtype=np.int64, count=1)[0])
        ids, counts = np.frombuffer(own, dtype=np.int64, offset=8, count=2 * n).reshape(2, n)
        sums = np.frombuffer(own, dtype=np.float64, offset=8 + 16 * n).copy()
        for r in rows:
            sums[np.frombuffer(r["owner"], dtype=np.uint16)] += np.frombuffer(r["sums"], dtype=np.float64)
        return pa.table([pa.array(ids), pa.array(counts), pa.array(sums / np.maximum(counts, 1))], names=["id", "n_words", "loss_difference"])

    asked = texts.mapInArrow(gives_back(request), REQUEST)
    answers = asked.groupBy("bucket").applyInArrow(gives_back(answer), ANSWER)
    scored = answers.groupBy("chunk").applyInArrow(gather, "id bigint, n_words bigint, loss_difference double")
    return scored.withColumnRenamed("id", id_col)
