"""Line dedup by pairwise alignment: documents that share rare lines are aligned by patience diff.

Documents of one text are one class: the copies of its first document lose
everything. Among the classes, a line of at least ``MIN_WORDS`` words that at most
``RARE`` of them hold is rare: every two documents that share one are aligned,
and the later one loses the aligned blocks. A line that more documents hold is
common text; it needs no pair, as an alignment of such a line alone always
succeeds: all documents but the first lose it. So no shared line of that length
goes without a link, a line makes at most RARE * (RARE - 1) / 2 pairs, and a group
of thousands of copies makes none.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, fresh, gives_back, scratch, written

# A shared line links documents, and an aligned block goes with such a line in it, from so many words on.
MIN_WORDS = 5
# Documents that hold a rare line, at most.
RARE = 16
BLANK = 0


def _chain(common: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest part of (place in a, place in b), sorted by a, that rises in both."""
    tops: list[int] = []  # the last place in b of the best chain of each length
    at: list[int] = []
    before: list[int] = []
    for k, (_, j) in enumerate(common):
        n = bisect_left(tops, j)
        before.append(at[n - 1] if n else -1)
        if n == len(tops):
            tops.append(j)
            at.append(k)
        else:
            tops[n], at[n] = j, k
    chain, k = [], at[-1] if at else -1
    while k >= 0:
        chain.append(common[k])
        k = before[k]
    return chain[::-1]


def _places(x: Sequence[int], low: int, high: int) -> dict[int, list[int]]:
    found = defaultdict(list)
    for k in range(low, high):
        if x[k] != BLANK:
            found[x[k]].append(k)
    return found


def _anchors(a: Sequence[int], b: Sequence[int], low_a: int, high_a: int, low_b: int, high_b: int) -> list[tuple[int, int]]:
    """Lines that match, in one order: those that occur once in either range, or if there are none, like occurrences."""
    in_a, in_b = _places(a, low_a, high_a), _places(b, low_b, high_b)
    once = [(p[0], in_b[x][0]) for x, p in in_a.items() if len(p) == 1 and len(in_b.get(x, ())) == 1]
    if not once:
        # the first occurrence with the first, the second with the second, and so on
        once = [pair for x, p in in_a.items() for pair in zip(p, in_b.get(x, ()), strict=False)]
    return _chain(sorted(once))


def aligned_blocks(a: Sequence[int], b: Sequence[int]) -> list[tuple[int, int, int]]:
    """(start in a, start in b, length) of the common blocks of a patience diff, in order.

    A range's common beginning and end are blocks; within, matching lines anchor
    blocks that run on while lines agree, and the ranges between are done in turn.
    Blank lines anchor no block, but a block runs through them.
    """
    blocks: list[tuple[int, int, int]] = []
    ranges = [(0, len(a), 0, len(b))]
    while ranges:
        low_a, high_a, low_b, high_b = ranges.pop()
        n = 0
        while low_a + n < high_a and low_b + n < high_b and a[low_a + n] == b[low_b + n]:
            n += 1
        blocks.append((low_a, low_b, n))
        low_a, low_b, n = low_a + n, low_b + n, 0
        while high_a - n > low_a and high_b - n > low_b and a[high_a - n - 1] == b[high_b - n - 1]:
            n += 1
        high_a, high_b = high_a - n, high_b - n
        blocks.append((high_a, high_b, n))
        end_a, end_b = low_a, low_b
        chain = _anchors(a, b, low_a, high_a, low_b, high_b)
        for i, j in chain:
            if i < end_a or j < end_b:
                continue  # already inside the block before
            start_i, start_j, stop_i, stop_j = i, j, i + 1, j + 1
            while start_i > end_a and start_j > end_b and a[start_i - 1] == b[start_j - 1]:
                start_i, start_j = start_i - 1, start_j - 1
            while stop_i < high_a and stop_j < high_b and a[stop_i] == b[stop_j]:
                stop_i, stop_j = stop_i + 1, stop_j + 1
            ranges.append((end_a, start_i, end_b, start_j))
            blocks.append((start_i, start_j, stop_i - start_i))
            end_a, end_b = stop_i, stop_j
        if chain:
            ranges.append((end_a, high_a, end_b, high_b))
    return _joined(sorted(x for x in blocks if x[2]))


def _joined(blocks: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Blocks that follow each other without a gap on either side, as one."""
    out: list[tuple[int, int, int]] = []
    for i, j, n in blocks:
        if out and out[-1][0] + out[-1][2] == i and out[-1][1] + out[-1][2] == j:
            out[-1] = (out[-1][0], out[-1][1], out[-1][2] + n)
        else:
            out.append((i, j, n))
    return out


def lost_lines(a: Sequence[int], wordy: Sequence[bool], b: Sequence[int]) -> list[int]:
    """Lines of ``a`` in blocks that it shares with ``b``; a block without a wordy line stays."""
    lost = []
    for start, _, n in aligned_blocks(a, b):
        if any(wordy[start : start + n]):
            lost.extend(range(start, start + n))
    return lost


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _hashed(line: Column) -> Column:
    """A line's hash, ``BLANK`` if it has no word."""
    return F.when(line.rlike(r"[^\x20\x09-\x0D]"), F.xxhash64(F.lit(1), line)).otherwise(F.lit(BLANK).cast("bigint"))


LOST = "id bigint, mark bigint, gone array<int>"


def _lists(column: pa.Array) -> Iterator[pa.Array]:
    """The lists of a column, as slices of its one array of values."""
    ends = column.offsets.to_numpy()
    return (column.values.slice(a, b - a) for a, b in zip(ends[:-1], ends[1:], strict=True))


def common_lines(texts: DataFrame, min_words: int, rare: int) -> DataFrame:
    """(id, mark, gone): the lines that each (id, mark, text) loses; ``mark`` is a hash of the text."""
    with scratch(texts.sparkSession):
        return written(_common_lines(texts, min_words, rare), "gone", outside=True)


def _common_lines(texts: DataFrame, min_words: int, rare: int) -> DataFrame:
    lines = _lines(F.col("text"))
    wordy = r"(?:[^\x20\x09-\x0D]+[\x20\x09-\x0D]+){%d}[^\x20\x09-\x0D]" % (min_words - 1)
    # a projection of its own, so that each line is looked at once
    parsed = texts.select(
        "id", "mark", F.xxhash64(F.lit(2), "text").alias("other_mark"), F.length("text").alias("size"),
        F.transform(
            lines, lambda x: F.struct(_hashed(x).alias("p"), F.xxhash64(F.lit(2), x).alias("q"), x.rlike(wordy).alias("w"))
        ).alias("parsed"),
    )
    hashed = parsed.select(
        "id", "mark", "other_mark", "size",
        F.col("parsed.p").alias("lines"),
        F.col("parsed.w").alias("wordy"),
        # the keys of the lines that can link, as two hashes, in order
        F.sort_array(F.transform(
            F.filter("parsed", lambda x: x["w"]), lambda x: F.struct(x["p"].alias("p"), x["q"].alias("q"))
        )).alias("ordered"),
    )
    documents = written(hashed.where(F.size("ordered") > 0).distinct(), "lines")
    # classes of one text
    text_key = ["mark", "other_mark", "size"]
    classes = written(documents.groupBy(*text_key).agg(F.min("id").alias("rep"), F.max("id").alias("last")), "classes")
    copied = broadcast_if_small(classes.where("rep < last"), 40)
    copies = documents.select("id", *text_key, F.size("lines").alias("n")).join(copied, text_key).where("id > rep")
    everything = F.sequence(F.lit(0), F.col("n") - 1)
    copies = copies.select("id", "mark", everything.alias("gone"))
    reps = documents.join(classes.select(*text_key, F.col("rep").alias("id")), [*text_key, "id"])

    # each key once: equal ones are neighbours, where array_distinct would compare all structs with each other
    once = F.filter("ordered", lambda x, k: ~x.eqNullSafe(F.get("ordered", k + 1)))
    keyed = written(reps.select("id", "mark", F.explode(once).alias("key")), "keys")
    held = keyed.groupBy("key").agg(
        F.min("id").alias("first"), F.max("id").alias("last"), F.count(F.lit(1)).alias("n")
    )
    held = written(held.where("first < last"), "held")
    # common text: all but the first lose the line
    often = held.where(F.col("n") > rare).select("key", "first")
    over = keyed.join(broadcast_if_small(often, 24), "key").where(F.col("id") > F.col("first"))
    over = over.groupBy("id", "mark").agg(F.collect_set("key.p").alias("common"))
    # a document loses what it holds itself, so a group has no more than its lines
    shown = over.join(reps.select("id", "mark", "lines"), ["id", "mark"]).select("id", "mark", "lines", "common")

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines, common = ([x.to_numpy(zero_copy_only=False) for x in _lists(batch.column(k))] for k in (2, 3))
            gone = [np.flatnonzero(np.isin(x, y)).astype(np.int32) for x, y in zip(lines, common, strict=True)]
            columns = [batch.column(0), batch.column(1), pa.array(gone, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "mark", "gone"])

    over = shown.mapInArrow(locate, LOST)
    # rare lines: at most ``rare`` documents each, so the pairs of a line are few
    few = keyed.join(held.where(F.col("n") <= rare).select("key"), "key")
    holders = few.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("id", "mark"))).alias("holders"))
    later = holders.select("holders", F.posexplode("holders").alias("k", "x"))
    met = later.select("x", F.explode(F.slice("holders", F.lit(1), F.col("k"))).alias("y"))
    pairs = met.select("x.id", "x.mark", F.col("y.id").alias("first"), F.col("y.mark").alias("first_mark"))
    pairs = written(pairs.where(F.col("id") > F.col("first")).distinct(), "pairs")
    mine = reps.select("id", "mark", F.col("lines").alias("mine"), "wordy")
    theirs = reps.select(F.col("id").alias("first"), F.col("mark").alias("first_mark"), F.col("lines").alias("theirs"))
    both = pairs.join(mine, ["id", "mark"]).join(theirs, ["first", "first_mark"]).select("id", "mark", "mine", "wordy", "theirs")

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lost, counts = [np.zeros(0, dtype=np.int32)], [0]
            for a, wordy, b in zip(*map(_lists, batch.columns[2:]), strict=True):
                found = lost_lines(*(x.to_numpy(zero_copy_only=False).tolist() for x in (a, wordy, b)))
                lost.append(np.array(found, dtype=np.int32))
                counts.append(len(found))
            gone = pa.ListArray.from_arrays(pa.array(np.cumsum(counts), pa.int32()), pa.array(np.concatenate(lost)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), gone], names=["id", "mark", "gone"])

    aligned = both.mapInArrow(gives_back(align), LOST)
    found = aligned.unionByName(over).unionByName(copies).where(F.size("gone") > 0)
    each = found.select("id", "mark", F.explode("gone").alias("k"))
    return each.groupBy("id", "mark").agg(F.array_sort(F.collect_set("k")).alias("gone"))


def remove_common_lines(
    docs: DataFrame,
    min_words: int = MIN_WORDS,
    rare: int = RARE,
    id_col: str = "doc_id",
    text_col: str = "text",
    kept_col: str = "kept_text",
    gone_col: str = "gone_lines",
) -> DataFrame:
    """All rows and columns of ``docs``, with the text that is kept and the numbers of the lines that go.

    Lines of at least ``min_words`` words link documents. A copy of a document
    with a smaller id loses all its lines; a line that more than ``rare``
    different texts hold stays in the one of the smallest id only; documents that share a
    rarer one are aligned, and the one of the larger id loses the common
    blocks that hold a line of that length. All is judged on the given texts.
    A missing text stays missing and an empty one empty; a row without an id
    loses nothing and takes nothing. Rows of one id are not compared with each
    other; repeated rows come out as often as they go in, however long. Where ``docs`` has a column
    named like a new one, in any case, the new one has underscores in front.
    """
    mark, row_id, found_col, kept_col, gone_col = fresh(docs, "mark", "row_id", "found", kept_col, gone_col)
    marked = docs.withColumns({
        row_id: F.col(id_col).cast("bigint"),
        mark: F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit(""))),
    })
    usable = marked.where(F.col(row_id).isNotNull() & (F.length(F.col(text_col)) > 0))
    texts = usable.select(F.col(row_id).alias("id"), F.col(mark).alias("mark"), F.col(text_col).alias("text"))
    found = common_lines(texts, min_words, rare)
    found = found.select(F.col("id").alias(row_id), F.col("mark").alias(mark), F.col("gone").alias(found_col))
    joined = marked.join(broadcast_if_small(found, 16 + 4 * F.size(found_col)), [row_id, mark], "left")
    # a sign per line up to the last that goes; no lambda looks into the text, so none splits it again for each line
    gone = F.col(found_col)
    signs = F.transform(gone, lambda k, i: F.concat(
        F.repeat(F.lit("0"), k - F.coalesce(F.get(gone, i - 1), F.lit(-1)) - 1), F.lit("1")
    ))
    signs = F.split(F.array_join(signs, ""), "")
    # array_join leaves out what is null
    left = F.zip_with(_lines(F.col(text_col)), signs, lambda line, s: F.when(s == "1", None).otherwise(line))
    kept = F.when(gone.isNull(), F.col(text_col)).otherwise(F.array_join(left, "\n"))
    none = F.array().cast("array<int>")
    return joined.select(
        *(F.col(f"`{c}`") for c in docs.columns), kept.alias(kept_col), F.coalesce(F.col(found_col), none).alias(gone_col)
    )
