"""Similarity join of word n-gram sets: prefixes of token combinations, verified, as connected classes.

The tokens are hashed shingles. Steps, each a table in the shared folder:

1. Which shingles occur in one document only? Hashes travel once, packed by
   hash range and counted per chunk beforehand; the answer that comes back is a
   number per document. A document of which more than a quarter is its own can
   link with nothing and is done.
2. The others are reduced to one per set of shingles.
3. Tokens are ordered by document frequency. A rare token is a signature by
   itself. Frequent tokens only sign in pairs within sub-classes, so the prefix
   is extended until no loss of tokens that a link allows can break all
   signatures: two linked sets share a signature in their prefixes.
4. Candidates of a signature are not all paired: they are compared with a few
   pivots, and what is linked by then needs no further comparison. Pairs
   between different components are compared at the end, by sketches and those
   that may link in full, so no link between components is lost, and none
   within one changes the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import (
    MULTIPLIER,
    Vocabulary,
    broadcast_if_small,
    buckets_of,
    chunks,
    gives_back,
    id_and_bytes,
    mix,
    ranges,
    scratch,
    window_hashes,
    window_starts,
    written,
)
from .graph import components

# Sets of fewer tokens sign with single tokens only; from here on, tiers of
# doubling size have 1, 2, 4... sub-classes for pairs.
SMALL_SET = 32
# Tokens of at most so many sets sign alone.
RARE = 16
PIVOT_ORDERS = 4
PIVOT_ROUNDS = 2
FEW, BLOCK = 48, 512
# A pair that a join makes is worth this many comparisons of sketches, at least.
PAIR_COST = 16
# A sketch has so many 64-bit words for small sets, and at most so many doublings of it.
SKETCH_WORDS, SKETCH_DOUBLINGS = 8, 5
# Text that a numpy pass works on, and words remembered: a pass takes some 30 bytes for each of text.
CHUNK, WORDS = 2 * 1024 * 1024, 150_000
# A shingle, of about seven bytes of text, travels as four.
SENT_PER_BYTE = 0.7


def shingle_sets(texts: list[bytes], width: int, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, in hash order, and the text's number for each."""
    documents = [t.lower().split() for t in texts]
    words, counts = vocabulary.hashes(documents)
    starts, doc = window_starts(counts, width)
    hashes = window_hashes(words, width)[starts]
    short = np.flatnonzero((counts > 0) & (counts < width))
    if len(short):
        whole = [xxhash.xxh3_64_intdigest(b" ".join(documents[d]), seed=len(documents[d])) for d in short.tolist()]
        hashes = np.concatenate([hashes, np.array(whole, dtype=np.uint64)])
        doc = np.concatenate([doc, short])
    order = np.argsort(hashes, kind="stable")
    hashes, doc = hashes[order], doc[order]
    if len(hashes):
        first = np.concatenate([[True], (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])])
        hashes, doc = hashes[first], doc[first]
    return hashes, doc


def fingerprints(hashes: np.ndarray, doc: np.ndarray, documents: int) -> np.ndarray:
    """Two 64-bit sums per document that do not depend on the order of its hashes."""
    sums = np.zeros((2, documents), dtype=np.uint64)
    for k in range(2):
        np.add.at(sums[k], doc, mix(hashes, k + 1))
    return sums.view(np.int64)


REQUEST = "bucket int, chunk bigint, single binary, owner binary, each binary, several binary, own binary"
ANSWER = "chunk bigint, owner binary, times binary, own binary"
STATS = ["id", "n", "shared", "f1", "f2"]


def set_statistics(texts: DataFrame, width: int, buckets: int) -> DataFrame:
    """(id, n, shared, f1, f2): set size, tokens that other documents have too, and fingerprint.

    ``shared`` can be too high, by hash remainders that agree and for an id on
    several rows, never too low. Within a chunk each hash is sent once at most, so
    a token that every document has costs no task more than a row per chunk.
    """

    def request(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(WORDS)
        for number, (keys, chunk) in enumerate(chunks(batches, CHUNK)):
            ids = np.array(keys, dtype=np.int64)
            hashes, doc = shingle_sets(chunk, width, vocabulary)
            sizes = np.bincount(doc, minlength=len(ids))
            marks = fingerprints(hashes, doc, len(ids))
            first = np.concatenate([[True], hashes[1:] != hashes[:-1]]) if len(hashes) else np.zeros(0, dtype=bool)
            group = np.cumsum(first) - 1
            several = np.bincount(group, minlength=1)[group] > 1 if len(hashes) else first
            shared = np.bincount(doc[several], minlength=len(ids))
            own = np.stack([ids, sizes, shared, marks[0], marks[1]], axis=1).astype(np.int64)
            key = TaskContext.get().partitionId() << 32 | number
            rows = [(key % buckets, key, b"", b"", b"", b"", own.tobytes())]
            alone, owner = hashes[~several], doc[~several].astype(np.uint16)
            common = hashes[several & first]
            edges = np.arange(buckets + 1)
            at, upto = (np.searchsorted(buckets_of(h, buckets), edges) for h in (alone, common))
            # by owner within a bucket, so that an owner is sent once with a number of hashes
            order = np.argsort(buckets_of(alone, buckets) << np.uint64(16) | owner, kind="stable")
            alone, owner = alone[order], owner[order]
            for b in np.flatnonzero(np.diff(at) + np.diff(upto)).tolist():
                s, c = slice(at[b], at[b + 1]), slice(upto[b], upto[b + 1])
                who = np.flatnonzero(np.diff(owner[s].astype(np.int64), prepend=-1))
                each = np.diff(who, append=s.stop - s.start).astype(np.uint32)
                told = (x.tobytes() for x in (alone[s].astype(np.uint32), owner[s][who], each, common[c].astype(np.uint32)))
                rows.append((b, key, *told, b""))
            kinds = [pa.int32(), pa.int64(), *[pa.binary()] * 5]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                names=["bucket", "chunk", "single", "owner", "each", "several", "own"],
            )

    def answer(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        single = [np.frombuffer(r["single"], dtype=np.uint32) for r in rows]
        owners = [np.repeat(np.frombuffer(r["owner"], np.uint16), np.frombuffer(r["each"], np.uint32)) for r in rows]
        hashes = np.concatenate(single)
        order = np.argsort(hashes, kind="stable")
        ordered = hashes[order]
        same = ordered[1:] == ordered[:-1]
        again = np.zeros(len(hashes), dtype=bool)
        again[order[1:][same]] = True
        again[order[:-1][same]] = True
        common = np.unique(np.concatenate([np.frombuffer(r["several"], dtype=np.uint32) for r in rows]))
        if len(common):
            again |= common[np.minimum(np.searchsorted(common, hashes), len(common) - 1)] == hashes
        told = []
        for r, o, hit in zip(rows, owners, np.split(again, np.cumsum([len(x) for x in single])[:-1]), strict=True):
            who, times = np.unique(o[hit], return_counts=True)
            if len(who) or r["own"]:
                told.append((r["chunk"], who.tobytes(), times.astype(np.uint32).tobytes(), r["own"]))
        columns = list(zip(*told, strict=True)) or [()] * 4
        kinds = [pa.int64(), *[pa.binary()] * 3]
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["chunk", "owner", "times", "own"])

    def gather(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        own = np.frombuffer(next(r["own"] for r in rows if r["own"]), dtype=np.int64).reshape(-1, 5).copy()
        for r in rows:
            own[np.frombuffer(r["owner"], dtype=np.uint16), 2] += np.frombuffer(r["times"], dtype=np.uint32)
        return pa.table({name: own[:, k] for k, name in enumerate(STATS)})

    requests = texts.mapInArrow(gives_back(request), REQUEST)
    answers = requests.groupBy("bucket").applyInArrow(gives_back(answer), ANSWER)
    rows = answers.groupBy("chunk").applyInArrow(gather, ", ".join(f"{c} bigint" for c in STATS))
    merged = rows.groupBy("id").agg(F.max("shared").alias("shared"), F.max(F.struct("n", "f1", "f2")).alias("own"))
    return merged.select("id", "own.n", "shared", "own.f1", "own.f2")


def signatures_of(
    n: int, frequency: np.ndarray, hashes: np.ndarray, percent: int, rare: int
) -> np.ndarray:
    """Signatures of a set of ``n`` tokens, of which those given occur in other sets too."""
    order = np.lexsort((hashes, frequency))
    frequency, hashes = frequency[order], hashes[order]
    alone = n - len(hashes)
    need = n - (percent * n + 99) // 100 + 1  # one more than the tokens that a link may miss
    found = []
    if (percent * n + 99) // 100 < SMALL_SET:
        found.append(mix(hashes[: max(0, need - alone)], 3))
    tier = max(0, (n // SMALL_SET).bit_length() - 1)
    for t in {tier, tier - 1} if n >= SMALL_SET else ():
        if t < 0 or t < tier and (percent * n + 99) // 100 >= SMALL_SET << tier:
            continue
        sub = (hashes >> np.uint64(7)) % np.uint64(1 << t)
        often = frequency > rare
        adds = np.ones(len(hashes), dtype=np.int64)
        places = np.flatnonzero(often)
        adds[places[np.unique(sub[places], return_index=True)[1]]] = 0
        enough = np.flatnonzero(alone + np.cumsum(adds) >= need)
        end = 0 if alone >= need else int(enough[0]) + 1 if len(enough) else len(hashes)
        single, pairs = hashes[:end][~often[:end]], hashes[:end][often[:end]]
        found.append(mix(single, 10 + t))
        group = sub[:end][often[:end]]
        for g in np.unique(group):
            own = np.sort(pairs[group == g])
            i, j = np.triu_indices(len(own), 1)
            found.append(mix(own[i] * MULTIPLIER + own[j], 100 + t))
    return np.unique(np.concatenate(found)) if found else np.zeros(0, dtype=np.uint64)


def postings(sets: DataFrame, percent: int, rare: int) -> DataFrame:
    """(sig, id, n) of all sets (id, n, tokens)."""
    tokens = sets.select("id", "n", F.explode("tokens").alias("h"))
    # Written, so that both sides of the join come from a shuffle and AQE can split a hot token.
    frequency = written(tokens.groupBy("h").count().where("count > 1"), "frequencies")
    shared = tokens.join(frequency, "h")
    lists = shared.groupBy("id", "n").agg(F.collect_list(F.struct("count", "h")).alias("tokens"))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, sizes, signs = [], [], []
            tokens = batch.column(2)
            parts = tokens.flatten()
            counts, hashes = (parts.field(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            ends = np.cumsum(tokens.value_lengths().to_numpy(zero_copy_only=False))
            for k, (key, n) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
                own = slice(ends[k - 1] if k else 0, ends[k])
                found = signatures_of(n, counts[own], hashes[own].view(np.uint64), percent, rare)
                ids.append(np.full(len(found), key))
                sizes.append(np.full(len(found), n))
                signs.append(found.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(x) if x else [], pa.int64()) for x in (signs, ids, sizes)],
                names=["sig", "id", "n"],
            )

    return lists.mapInArrow(gives_back(sign), "sig bigint, id bigint, n bigint")


def parity_sketch(tokens: np.ndarray) -> np.ndarray:
    """Bits that say whether an odd number of tokens falls on each place; longer for larger sets, up to a bound.

    Two sets differ in at least as many tokens as their sketches in bits, so a
    pair whose sketches differ too much cannot link.
    """
    words = SKETCH_WORDS << min(max(0, (len(tokens) // (64 * SKETCH_WORDS)).bit_length()), SKETCH_DOUBLINGS)
    # uint64 tokens: the low bits choose the place, so that a sketch folds to half by xor of its halves
    odd = np.bincount((tokens % np.uint64(64 * words)).astype(np.int64), minlength=64 * words).astype(np.uint8) & 1
    return np.packbits(odd, bitorder="little").view(np.uint64)


def _folded(sketches: np.ndarray, words: int) -> np.ndarray:
    while sketches.shape[-1] > words:
        half = sketches.shape[-1] // 2
        sketches = sketches[..., :half] ^ sketches[..., half:]
    return sketches


def _may_link(n, m, differ, percent: int):
    """Whether sets of n and m tokens that differ in at least so many can be similar enough."""
    return (n + m - differ) * 100 >= percent * (n + m + differ)


def sketches_of(sets: DataFrame) -> DataFrame:
    """(id, n, sketch) of all sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [parity_sketch(x.values.to_numpy().view(np.uint64)).tobytes() for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(made, pa.binary())], names=["id", "n", "sketch"]
            )

    return sets.select("id", "n", "tokens").mapInArrow(gives_back(run), "id bigint, n bigint, sketch binary")


def verified(pairs: DataFrame, sketches: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough; sketches are compared before sets are sent."""
    ends = [sketches.select(*(F.col(c).alias(c + x) for c in ("id", "n", "sketch"))) for x in "ab"]
    near = pairs.join(ends[0], F.col("a") == F.col("ida")).join(ends[1], F.col("b") == F.col("idb"))

    def glance(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for n, m, x, y in zip(*(batch.column(k).to_pylist() for k in range(2, 6)), strict=True):
                x, y = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
                words = min(len(x), len(y))
                differ = int(np.bitwise_count(_folded(x, words) ^ _folded(y, words)).sum())
                keep.append(_may_link(n, m, differ, percent))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    near = near.select("a", "b", "na", "nb", "sketcha", "sketchb").mapInArrow(gives_back(glance), "a bigint, b bigint")
    near = written(near, "near")
    left = sets.select(F.col("id").alias("a"), F.col("tokens").alias("one"))
    right = sets.select(F.col("id").alias("b"), F.col("tokens").alias("two"))
    # only sets that a pair asks for are sent
    asked = written(near.select("b").distinct(), "asked")
    right = right.join(broadcast_if_small(asked, 8), "b", "left_semi")
    both = left.join(broadcast_if_small(near, 16), "a").join(right, "b").select("a", "b", "one", "two")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, two = ([x.values.to_numpy(zero_copy_only=False) for x in batch.column(k)] for k in (2, 3))
            keep = []
            for x, y in zip(one, two, strict=True):
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(gives_back(compare), "a bigint, b bigint")


def _similar_size(percent: int):
    return F.least("n", "m") * 100 >= F.greatest("n", "m") * percent


def pivot_pairs(live: DataFrame, percent: int) -> DataFrame:
    """(a, b): each member of an open signature and its pivot, if they are in different components."""
    met = live.where((F.col("label") != F.col("there")) & _similar_size(percent))
    return met.select(F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b")).distinct()


def remaining_pairs(live: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """(a, b): all pairs of an open signature in different components that can still link.

    Members of signatures are put together by pivot, as signatures of one pivot
    have much the same members: a pair is met once there, not once for each
    signature. Of such a group, those outside its largest component are compared
    with all, block by block: a task has two blocks at a time, however many there
    are, and pairs that the sketches rule out are never made into rows. Only where
    a pivot's signatures of few members have so little in common that their pairs,
    at most ``FEW`` for each member, cost less than those of the group, they come
    from a join.
    """
    small = F.col("members") <= FEW
    # of a pivot, the sum of met is the sum of squares of the sizes of its small signatures
    met = F.sum(F.when(small, F.col("members"))).alias("met")
    around = live.groupBy(F.col("other").alias("pivot"), "id", "label").agg(met, F.max(~small).alias("large"))
    around = written(around, "around")
    costs = around.groupBy("pivot").agg(F.count("met").alias("size"), F.sum("met").alias("met"))
    loose = written(costs.where(F.col("size") * F.col("size") > F.lit(PAIR_COST) * F.col("met")).select("pivot"), "loose")
    few = live.where(small).join(broadcast_if_small(loose, 8), F.col("other") == F.col("pivot"), "left_semi")
    few = few.select("sig", "id", "n", "label")
    other = few.select("sig", F.col("id").alias("other"), F.col("n").alias("m"), F.col("label").alias("there"))
    met = few.join(other, "sig").where((F.col("id") < F.col("other")) & (F.col("label") != F.col("there")))
    met = met.where(_similar_size(percent)).select(F.col("id").alias("a"), F.col("other").alias("b")).distinct()
    around = around.join(broadcast_if_small(loose.withColumn("loose", F.lit(True)), 16), "pivot", "left")
    around = written(around.where("loose is null or large").select("pivot", "id", "label"), "grouped")
    shares = around.groupBy("pivot", "label").agg(F.count(F.lit(1)).alias("size"))
    tops = shares.groupBy("pivot").agg(F.max(F.struct("size", "label")).alias("top"), F.sum("size").alias("members"))
    tops = tops.where("members > top.size").select(
        "pivot",
        F.col("top.label").alias("largest"),
        (F.col("members") <= BLOCK).alias("whole"),
        F.ceil(F.col("top.size") / BLOCK).cast("int").alias("inner"),
        F.ceil((F.col("members") - F.col("top.size")) / BLOCK).cast("int").alias("outer"),
    )
    inside = F.col("label") == F.col("largest")
    dealt = around.join(written(tops, "tops"), "pivot").withColumn("inside", inside)
    dealt = dealt.withColumn("mine", F.pmod(F.xxhash64("id"), F.when(inside, F.col("inner")).otherwise(F.col("outer"))).cast("int"))

    def unit(apart: bool, i: Column, j: Column) -> Column:
        return F.struct(F.lit(apart).alias("apart"), i.alias("i"), j.alias("j"))

    mine = F.col("mine")
    outer = F.sequence(F.lit(0), F.col("outer") - 1)
    met_outside = F.transform(outer, lambda k: unit(False, F.least(mine, k), F.greatest(mine, k)))
    met_inside = F.transform(F.sequence(F.lit(0), F.col("inner") - 1), lambda k: unit(True, k, mine))
    apart = F.when(inside, F.transform(outer, lambda k: unit(True, mine, k))).otherwise(F.concat(met_outside, met_inside))
    units = F.when(F.col("whole"), F.array(unit(False, F.lit(0), F.lit(0)))).otherwise(apart)
    dealt = dealt.select("pivot", F.explode(units).alias("unit"), "inside", "mine", "id", "label")
    dealt = dealt.select("pivot", "unit.*", "inside", "mine", "id", "label").join(sketches, "id")

    def compare(table: pa.Table) -> pa.Table:
        apart, same_block = table.column("apart")[0].as_py(), table.column("i")[0] == table.column("j")[0]
        mine, ids, labels, sizes = (table.column(c).to_numpy() for c in ("mine", "id", "label", "n"))
        inside = table.column("inside").to_numpy()
        bits = [np.frombuffer(x, dtype=np.uint64) for x in table.column("sketch").to_pylist()]
        lengths = np.array([len(x) for x in bits])
        folded = {w: np.stack([_folded(x, w) if len(x) >= w else np.zeros(w, np.uint64) for x in bits]) for w in set(lengths.tolist())}
        places = np.arange(len(ids))
        found = []
        for k in np.flatnonzero(~inside).tolist():
            n = sizes[k]
            fits = (labels != labels[k]) & (np.minimum(n, sizes) * 100 >= np.maximum(n, sizes) * percent)
            if apart:
                fits &= inside
            else:
                fits &= inside | (places > k) if same_block else (places > k) & (mine != mine[k])
            for words in set(lengths[fits].tolist()):
                least = min(words, len(bits[k]))
                other = np.flatnonzero(fits & (lengths == words))
                differ = np.bitwise_count(folded[least][other] ^ _folded(bits[k], least)).sum(axis=1).astype(np.int64)
                other = other[_may_link(n, sizes[other], differ, percent)]
                found.append(np.stack([np.minimum(ids[k], ids[other]), np.maximum(ids[k], ids[other])], axis=1))
        pairs = np.concatenate(found) if found else np.zeros((0, 2), dtype=np.int64)
        return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})

    large = dealt.groupBy("pivot", "apart", "i", "j").applyInArrow(gives_back(compare), "a bigint, b bigint")
    return met.union(large).distinct()


def linked_components(posts: DataFrame, sets: DataFrame, percent: int) -> DataFrame | None:
    """(id, label) of all sets that link with another; the label is the smallest id of the component."""
    sketches = written(sketches_of(sets), "sketches")
    links = labels = tried = None
    for step in range(PIVOT_ROUNDS + 1):
        if labels is None:
            here = posts.withColumn("label", F.col("id"))
        else:
            here = posts.join(broadcast_if_small(labels, 16), "id", "left").select("sig", "id", "n", F.coalesce("label", "id").alias("label"))
        # one of a few orders of all sets, by signature: the same sets become pivots of many signatures; at the end
        # one order only, as a pair is compared under each pivot
        orders = PIVOT_ORDERS if step < PIVOT_ROUNDS else 1
        order = F.xxhash64(F.lit(step), F.pmod("sig", F.lit(orders)), "id")
        first = F.min(F.struct(order.alias("rank"), "id", "n", "label")).alias("pivot")
        ends = F.min("label").alias("low"), F.max("label").alias("high"), F.count(F.lit(1)).alias("members")
        open_ = here.groupBy("sig").agg(first, *ends).where("low < high")
        pivots = open_.select(
            "sig", "members", F.col("pivot.id").alias("other"), F.col("pivot.n").alias("m"), F.col("pivot.label").alias("there")
        )
        # Written, so that both sides of the join come from a shuffle and AQE can split a hot signature.
        live = written(here.join(written(pivots, "pivots"), "sig"), "live")
        pairs = pivot_pairs(live, percent) if step < PIVOT_ROUNDS else remaining_pairs(live, sketches, percent)
        pairs = pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti")
        pairs = written(pairs, "pairs")
        if step < PIVOT_ROUNDS and live.isEmpty():
            break
        found = written(verified(pairs, sketches, sets, percent), "similar")
        links = found if links is None else links.union(found)
        tried = pairs if tried is None else tried.union(pairs)
        labels = components(links)
        posts = live.select("sig", "id", "n")
    return labels


def similarity_classes(
    docs: DataFrame,
    percent: int = 75,
    width: int = 5,
    rare: int = RARE,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id, n_shingles, component_id) per distinct id of ``docs``.

    A text is lower-cased in A-Z and split at ASCII white space; its set holds
    the distinct runs of ``width`` words, or all words as one run if they are
    fewer. Two documents link when the common part of their sets is at least ``percent``
    percent of the union. ``component_id`` is the smallest id that links lead to.
    A missing or empty text, or one without words, has no shingles and links with
    nothing. Rows without an id are left out; of several texts under one id the
    one with the most shingles counts. Other columns are not read.
    """
    spark = docs.sparkSession
    texts = id_and_bytes(docs, id_col, text_col)
    statistics = written(set_statistics(texts, width, ranges(texts, SENT_PER_BYTE)), "sets")
    able = statistics.where((F.col("n") > 0) & (F.col("shared") * 100 >= F.col("n") * percent))
    classes = written(able.groupBy("n", "f1", "f2").agg(F.min("id").alias("rep")), "classes")
    members = able.join(broadcast_if_small(classes, 32), ["n", "f1", "f2"]).select("id", "rep")

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(WORDS)
        for batch in batches:
            for keys, chunk in chunks([batch.select([0, 1])], CHUNK):
                hashes, doc = shingle_sets(chunk, width, vocabulary)
                hashes = hashes[np.argsort(doc, kind="stable")]
                ends = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=len(keys)))])
                tokens = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(hashes.view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.int64()), pa.array(np.diff(ends), pa.int64()), tokens], names=["id", "n", "tokens"]
                )

    reps = classes.select(F.col("rep").alias("id"), "n").distinct()
    with scratch(spark):
        found = texts.join(broadcast_if_small(classes.select(F.col("rep").alias("id")), 8), "id")
        found = found.mapInArrow(gives_back(collect), "id bigint, n bigint, tokens array<bigint>")
        # of several texts under one id, the counted one; written, as the join is asked for six times
        sets = written(found.join(broadcast_if_small(reps, 16), ["id", "n"], "left_semi"), "tokens")
        posts = written(postings(sets, percent, rare), "postings")
        labels = linked_components(posts, sets, percent)
        labels = None if labels is None else written(labels, "labels", outside=True)
    result = statistics.select("id", "n")
    if labels is None:
        joined = result.join(members, "id", "left").withColumn("label", F.lit(None).cast("bigint"))
    else:
        labels = labels.select(F.col("id").alias("rep"), "label")
        joined = result.join(members.join(labels, "rep", "left"), "id", "left")
    return joined.select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("label", "rep", "id").alias("component_id")
    )
