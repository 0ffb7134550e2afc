"""Benchmark decontamination: test texts are searched in suffix arrays over shards of the corpus."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, gives_back, id_and_bytes, keep_rows

# Benchmark texts searched in one pass over the corpus, in bytes. A larger
# benchmark is searched in several passes, whose results are put together.
BLOCK_BYTES = 16 * 1024 * 1024

# Words are runs of digits, ASCII letters and anything beyond ASCII: A-Z is
# lowered and every other ASCII byte becomes a blank.
WORD_BYTES = bytes(
    b | 0x20 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORD_BYTES).split()


class Queries:
    """A block of test items as word numbers, one after the other: 0 is a word that no item has.

    A window is a run of ``width`` words of an item, or the whole item if it has
    fewer. Windows are kept as places in ``flat``: ``start``, the words ``need``ed
    and those ``left`` in the item from there on. Memory is that of the items.
    """

    def __init__(self, items: list[tuple[int, bytes]], width: int):
        self.numbers: dict[bytes, int] = {}
        self.items: list[int] = []
        flat, item, start, left = [], [], [], []
        for key, text in items:
            found = words_of(text)
            if found:
                n, begin = len(found), len(flat)
                flat.extend(self.numbers.setdefault(w, len(self.numbers) + 1) for w in found)
                windows = max(1, n - width + 1)
                item.extend([len(self.items)] * windows)
                start.extend(range(begin, begin + windows))
                left.extend(range(n, n - windows, -1))
                self.items.append(key)
        self.flat = np.array(flat, dtype=np.int32)
        self.item, self.start, self.left = (np.array(x, dtype=np.int64) for x in (item, start, left))
        self.need = np.minimum(self.left, width)
        self.longest = int(self.need.max(initial=0))
        self.shortest = int(self.need.min(initial=self.longest))


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Positions of ``text`` in the order of their suffixes, compared by ``depth`` numbers at least (prefix doubling)."""
    _, rank = np.unique(text, return_inverse=True)
    rank = rank.astype(np.int64)
    n, width = len(text), 1
    while True:
        later = np.full(n, 0, dtype=np.int64)
        later[: max(0, n - width)] = rank[width:] + 1
        key = rank * (n + 2) + later
        order = np.argsort(key, kind="stable")
        step = np.concatenate([[0], np.cumsum(key[order][1:] != key[order][:-1])]) if n else np.zeros(0, dtype=np.int64)
        rank = np.empty(n, dtype=np.int64)
        rank[order] = step
        width *= 2
        if width >= depth or n == 0 or step[-1] == n - 1:
            return order


def _compare(
    text: np.ndarray, places: np.ndarray, flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Common length of each text suffix and window, up to ``lengths``, and whether the suffix is the smaller one."""
    offset = np.arange(int(lengths.max(initial=1)))[None, :]
    at, asked = places[:, None] + offset, starts[:, None] + offset
    there = np.where(at < len(text), text[np.minimum(at, len(text) - 1)], -2)
    rows = flat[np.minimum(asked, len(flat) - 1)]
    differs = (there != rows) & (offset < lengths[:, None])
    common = np.where(differs.any(axis=1), differs.argmax(axis=1), lengths)
    last = np.minimum(common, offset.shape[1] - 1)
    pick = np.arange(len(starts))
    smaller = (common < lengths) & (there[pick, last] < rows[pick, last])
    return common, smaller


# Words that a match is followed at a time.
FOLLOWED = 32


def match_lengths(text: np.ndarray, places: np.ndarray, flat: np.ndarray, starts: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Words that each text suffix has in common with an item from ``starts`` on, at most ``left``."""
    total = np.zeros(len(places), dtype=np.int64)
    open_ = np.arange(len(places))
    while len(open_):
        step = np.minimum(left[open_] - total[open_], FOLLOWED)
        common, _ = _compare(text, places[open_] + total[open_], flat, starts[open_] + total[open_], step)
        total[open_] += common
        open_ = open_[(common == step) & (total[open_] < left[open_])]
    return total


def lower_bound(
    text: np.ndarray, order: np.ndarray, flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray
) -> np.ndarray:
    """For each window, the first place in ``order`` whose suffix is not smaller; all windows halve their range at once."""
    low = np.zeros(len(starts), dtype=np.int64)
    high = np.full(len(starts), len(order), dtype=np.int64)
    while True:
        open_ = np.flatnonzero(low < high)
        if not len(open_):
            return low
        middle = (low[open_] + high[open_]) // 2
        _, smaller = _compare(text, order[middle], flat, starts[open_], lengths[open_])
        low[open_] = np.where(smaller, middle + 1, low[open_])
        high[open_] = np.where(smaller, high[open_], middle)


def search_shard(queries: Queries, texts: list[bytes]) -> list[tuple[int, np.ndarray, list[int], int]]:
    """(words, hit positions, items found, longest match) for each text of a shard.

    The shard's text is its word numbers. Stretches of known words that are
    shorter than the shortest window can hold no match and shrink to one 0, as
    do unknown words and document ends, before the suffix array is built.
    """
    documents = [words_of(t) for t in texts]
    counts = np.fromiter(map(len, documents), dtype=np.int64, count=len(documents))
    total = int(counts.sum())
    get = queries.numbers.get
    numbers = np.fromiter((get(w, 0) for w in chain.from_iterable(documents)), dtype=np.int32, count=total)
    nothing = np.zeros(0, dtype=np.int64)
    empty = [(int(c), nothing, [], 0) for c in counts]
    if not total or not len(queries.item):
        return empty
    doc = np.repeat(np.arange(len(counts)), counts)
    known = numbers > 0
    first = known & np.concatenate([[True], ~known[:-1] | (doc[1:] != doc[:-1])])
    stretch = np.cumsum(first) - 1
    lengths = np.bincount(stretch[known], minlength=1)
    keep = np.zeros(total, dtype=bool)
    keep[known] = lengths[stretch[known]] >= queries.shortest
    at = np.flatnonzero(keep)
    if not len(at):
        return empty
    gap = np.concatenate([[False], (at[1:] != at[:-1] + 1) | (doc[at[1:]] != doc[at[:-1]])])
    place = np.arange(len(at)) + np.cumsum(gap)
    text = np.zeros(int(place[-1]) + 1, dtype=np.int32)
    text[place] = numbers[at]
    origin = np.full(len(text), -1, dtype=np.int64)
    origin[place] = at
    order = suffix_array(text, queries.longest)
    flat, start, need = queries.flat, queries.start, queries.need
    # all places where a window occurs: from its lower bound on, while it matches
    low = lower_bound(text, order, flat, start, need)
    hits, items, longest = [], [], np.zeros(len(counts), dtype=np.int64)
    live = np.flatnonzero(low < len(order))
    while len(live):
        common, _ = _compare(text, order[low[live]], flat, start[live], need[live])
        live = live[common >= need[live]]
        at = origin[order[low[live]]]
        hits.append(np.stack([at, need[live]], axis=1))
        items.append(np.stack([doc[at], queries.item[live]], axis=1))
        full = match_lengths(text, order[low[live]], flat, start[live], queries.left[live])
        np.maximum.at(longest, doc[at], full)
        low[live] += 1
        live = live[low[live] < len(order)]
    hit = np.zeros(total + 1, dtype=np.int64)
    spans = np.concatenate(hits) if hits else np.zeros((0, 2), dtype=np.int64)
    np.add.at(hit, spans[:, 0], 1)
    np.add.at(hit, spans[:, 0] + spans[:, 1], -1)
    covered = np.flatnonzero(np.cumsum(hit)[:total] > 0)
    found = np.unique(np.concatenate(items), axis=0) if items else np.zeros((0, 2), dtype=np.int64)
    result = empty
    begins = np.cumsum(counts) - counts
    for d in np.unique(found[:, 0]).tolist():
        own = covered[np.searchsorted(covered, begins[d]) : np.searchsorted(covered, begins[d] + counts[d])]
        mine = [queries.items[i] for i in found[found[:, 0] == d, 1].tolist()]
        result[d] = (int(counts[d]), own - begins[d], mine, int(longest[d]))
    return result


def blocks_of(benchmark: DataFrame, item_col: str, text_col: str, block_bytes: int) -> Iterator[list[tuple[int, bytes]]]:
    """Items in blocks of bounded size, fetched a partition at a time."""
    block, size = [], 0
    items = benchmark.where(F.col(item_col).isNotNull() & F.col(text_col).isNotNull())
    for row in items.select(F.col(item_col).cast("bigint"), F.col(text_col).cast("binary")).toLocalIterator():
        block.append((row[0], bytes(row[1])))
        size += len(row[1])
        if size >= block_bytes:
            yield block
            block, size = [], 0
    yield block


SCHEMA = "id bigint, text binary, n_words bigint, hits array<int>, items array<bigint>, longest int"
KINDS = [pa.int64(), pa.binary(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.int32()]


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    width: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(id, n_words, hits, items, longest) for each row of ``docs`` that has an id.

    ``hits`` are the positions of the words inside an occurrence of a window of
    ``width`` item words, ``items`` the items with such a window, ``longest`` the
    most words a verbatim match has that begins with a window.
    An item of fewer words is one window; items without words, text or id are
    never found; an item given twice counts once. A missing or empty text has no
    words. Repeated rows come out as often as they go in. Other columns are not
    read. The corpus is never shuffled: each task sorts shards of its own, and a
    row passes the blocks of items one after the other with what was found.
    """
    rows = id_and_bytes(docs, id_col, text_col)
    nothing = F.array().cast("array<int>"), F.array().cast("array<bigint>")
    rows = rows.select(
        "id", "text", F.lit(0).cast("bigint").alias("n_words"), nothing[0].alias("hits"), nothing[1].alias("items"),
        F.lit(0).alias("longest"),
    )
    spark = docs.sparkSession
    for items in blocks_of(benchmark, item_col, item_text_col, block_bytes):
        shared = spark.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            queries = Queries(shared.value, width)
            for ids, shard, _, hits, found, longest in chunks(batches):
                now = search_shard(queries, shard)
                columns = [
                    ids,
                    shard,
                    [n for n, _, _, _ in now],
                    [sorted({*a, *b.tolist()}) if a else b.tolist() for a, (_, b, _, _) in zip(hits, now, strict=True)],
                    [sorted({*a, *b}) for a, (_, _, b, _) in zip(found, now, strict=True)],
                    [max(a, b) for a, (_, _, _, b) in zip(longest, now, strict=True)],
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, KINDS, strict=True)],
                    names=["id", "text", "n_words", "hits", "items", "longest"],
                )

        rows = rows.mapInArrow(gives_back(run), SCHEMA)
    return rows.drop("text").withColumnRenamed("id", id_col)


def remove_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    width: int = 10,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The rows of ``docs``, all columns, without those that hold a window of an item; cases as in ``find_leaks``."""
    for items in blocks_of(benchmark, item_col, item_text_col, block_bytes):
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def make_judge(shared=shared):
            queries = Queries(shared.value, width)
            return lambda texts: [not found for _, _, found, _ in search_shard(queries, texts)]

        docs = keep_rows(docs, text_col, make_judge)
    return docs
