"""Conversation repair, clustering and exact search against direct versions, and on rows that are hard to read."""

import functools
import hashlib
import math
import random
import re
import zlib

import pytest
from cohortlink.llm import clustering, conversation_repair, vector_search
from pyspark.sql import functions as F

TURNS = "conv_id bigint, turn bigint, role string, text string, conv string, symbols binary, segment int"
VECTORS = "vec_id bigint, embedding array<float>, vector string, cluster int, dims int, block int"
SHOWN = re.compile("[^\x20\x09-\x0d]")
NEXT = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
ROLE = {"u": "user", "a": "assistant"}
REPAIR = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def hurt(rows):
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(kind, text)
        for _ in range({0: 0, 3: 2}.get(kind, 1)):
            yield conv, turn, "user" if kind == 4 else role, text


def cheapest(rows, faults):
    """(cost, audit, lines) by trying every edit, least cost first, then least audit."""
    n = len(rows)

    @functools.cache
    def rest(i, state, put):
        found = []
        if i == n:
            if state in ("", "a"):
                found.append((0, "", ()))
        else:
            role, text, more = *rows[i], 3 * (faults[i] == "truncated")
            ways = [("D", 4, state, None)]
            if faults[i] not in ("blank", "duplicate"):
                if role and role[0] in NEXT[state]:
                    ways.append(("K", more, NEXT[state][role[0]], f"{role}:{text}"))
                ways += [("R", 3 + more, t, f"{ROLE[t]}:{text}") for t in NEXT[state] if t in ROLE]
            for letter, cost, to, line in ways:
                c, audit, lines = rest(i + 1, to, 0)
                found.append((c + cost, letter + audit, lines if line is None else (line, *lines)))
        for t in NEXT[state] if put < 2 else ():
            if t in ROLE:
                c, audit, lines = rest(i, t, put + 1)
                found.append((c + 3, "I" + audit, (f"{ROLE[t]}:", *lines)))
        return min(found, default=(10**9, "", ()))

    for i in range(n, -1, -40):  # keeps the recursion shallow
        for state in NEXT:
            rest(i, state, 0)
    return rest(0, "", 0)


def repaired(rows, damage=True):
    out = []
    kept = list(hurt(rows)) if damage else [tuple(" " if x is None and k > 1 else x for k, x in enumerate(r)) for r in rows]
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in kept if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        turns = [r[1] for r in own if r[1] is not None]
        seen, faults = set(), []
        for _, _, role, text in own:
            shown = SHOWN.findall(text)
            fault = "duplicate" if (role, text) in seen else "" if shown and shown[-1] in ".!?" else "truncated"
            faults.append(fault if shown else "blank")
            seen.add((role, text))
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:], strict=False))
        cost, audit, lines = cheapest(tuple(r[2:] for r in own), faults)
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        counts = [faults.count(x) for x in ("blank", "duplicate", "truncated")]
        out.append((conv, gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


def conversations(seed):
    r = random.Random(seed)
    texts = [None, "", "a.", "b", "c!", " \n\t", " x. \n", "d?", "é ", "long " * 3000 + "."]
    roles = ["user", "user", "assistant", "assistant", "system", "tool", "", None, "usher", "Assistant"]
    rows = []
    for conv in [None, *range(40)]:
        n = 300 if conv == 0 else r.choice([1, 2, 3, 6, 30])
        for _ in range(n):
            text = r.choice(texts) if r.random() < 0.5 else f"t{r.randrange(300)}" + r.choice([".", "?", ""])
            rows.append((conv, r.choice([None, *range(n)]), r.choice(roles), text))
    return rows + rows[:25] + [(0, 5, "user", "again.")] * 60


@pytest.mark.parametrize("damage, segment_rows", [(True, 4096), (True, 7), (False, 5)])
def test_repair(spark, damage, segment_rows):
    rows = conversations(segment_rows)
    table = spark.createDataFrame([(*x, "z", b"", 1) for x in rows], TURNS)
    got = conversation_repair.repair_conversations(table, damage=damage, segment_rows=segment_rows)
    assert got.columns == REPAIR
    assert sorted(map(tuple, got.collect()), key=str) == repaired(rows, damage)


def test_repair_of_nothing(spark):
    assert conversation_repair.repair_conversations(spark.createDataFrame([], TURNS)).collect() == []
    gone = next(i for i in range(99) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    only = spark.createDataFrame([(gone, 0, "user", "x.", None, None, None)], TURNS)
    got = [tuple(x) for x in conversation_repair.repair_conversations(only).collect()]
    assert got == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_block_tables():
    t = conversation_repair.Tables()
    assert len(t.vectors) < 100
    r = random.Random(3)
    for n in (0, 1, 3, 4, 5, 50):
        symbols = bytes(r.randrange(1, conversation_repair.SYMBOLS) for _ in range(n))
        for behind in range(len(t.vectors)):
            vector = t.vectors[behind]
            for symbol in reversed(symbols):
                vector = conversation_repair.before(symbol, vector)
            at, cost = t.price(symbols, behind)
            assert tuple(x + cost for x in t.vectors[at[0]]) == vector


def whole(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def clusters(rows, dims, k, rounds, scale):
    kept = [(i, tuple(math.floor(scale * x) for x in v)) for i, v in rows if whole(v) and len(v) == dims]
    start = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    centroids = [v for _, v in start[:k]]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    for n in range(rounds + 1):
        near = [min((far(v, c), j) for j, c in enumerate(centroids)) for _, v in kept]
        if n < rounds:
            for j in range(len(centroids)):
                if own := [v for (_, v), (_, m) in zip(kept, near, strict=True) if m == j]:
                    centroids[j] = tuple(sum(x) // len(own) for x in zip(*own, strict=True))
    sums = [sum(d for d, m in near if m == j) for j in range(len(centroids))]
    code = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted([(i, j, d, sums[j], sum(sums), code[j]) for (i, _), (d, j) in zip(kept, near, strict=True)], key=str)


def vectors(seed, dims, n):
    r = random.Random(seed)
    # few values, so that distances and scores tie
    rows = [(i, [r.choice([-0.5, 0.25, 0.0, 1.0, r.randrange(-8, 8) / 16]) for _ in range(dims)]) for i in range(n)]
    rows += [rows[3], rows[5], rows[5], (7, rows[1][1]), (50, rows[6][1]), (50, rows[0][1]), (0, rows[0][1])]
    odd = [None, [], [None] * dims, [math.nan] * dims, [math.inf] + [0.0] * (dims - 1), [0.1] * (dims + 1), [0.2] * (dims + 1)]
    rows += [(n + i, v) for i, v in enumerate(odd)] + [(None, rows[2][1]), (None, None), (-50, rows[4][1])]
    return rows


@pytest.mark.parametrize("dims, k, n", [(3, 5, 300), (64, 16, 120), (2, 32, 9)])
def test_clusters(spark, dims, k, n):
    rows = vectors(dims, dims, n)
    table = spark.createDataFrame([(*x, "z", 1, 2, 3) for x in rows], VECTORS)
    got = clustering.cluster_vectors(table, dims=dims, k=k, rounds=3).drop("centroid")
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == clusters(rows, dims, k, 3, 64)


def test_clusters_of_nothing(spark):
    for rows in ([], [(1, None)], [(None, [0.0] * 64)]):
        table = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
        assert clustering.cluster_vectors(table).collect() == []


def best(rows, every, k, scale):
    kept = [(n, i, [math.floor(scale * x) for x in v]) for n, (i, v) in enumerate(rows) if whole(v)]
    out = []
    for n, i, v in kept:
        if i is not None and i % every == 0:
            found = [
                (-sum(x * y for x, y in zip(v, w, strict=True)), j is None, j) for m, j, w in kept if m != n and len(w) == len(v)
            ]
            found = sorted(found, key=lambda x: (x[0], x[1], x[2] or 0))[:k]
            out += [(i, rank + 1, j, -s) for rank, (s, _, j) in enumerate(found)]
    return sorted(out, key=str)


@pytest.mark.parametrize("dims, n, every, k", [(64, 3000, 50, 5), (2, 2500, 25, 5), (3, 40, 1, 7), (3, 10, 50, 5)])
def test_top_k(spark, dims, n, every, k):
    rows = vectors(dims + n, dims, n)
    table = spark.createDataFrame([(*x, "z", 1, 2, 3) for x in rows], VECTORS)
    got = vector_search.top_k(table, every=every, k=k)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect()), key=str) == best(rows, every, k, 256)


@pytest.mark.parametrize("scale", [1 << 17, 1 << 28])
def test_top_k_of_large_numbers(spark, scale):
    # products beyond what floating point of 32 bits, and of 64 bits, holds exactly
    rows = vectors(4, 4, 700)
    got = vector_search.top_k(spark.createDataFrame([(*x, "z", 1, 2, 3) for x in rows], VECTORS), every=10, k=4, scale=scale)
    assert sorted(map(tuple, got.collect()), key=str) == best(rows, 10, 4, scale)


def test_top_k_in_waves(spark, monkeypatch):
    searched, waves = vector_search._searched, []
    monkeypatch.setattr(vector_search, "_searched", lambda *x: waves.append(x[1]) or searched(*x))
    monkeypatch.setattr(vector_search, "QUERIES", 16)
    monkeypatch.setattr(vector_search, "BLOCK", 32)
    monkeypatch.setattr(vector_search, "WAVE_BYTES", 600)
    rows = vectors(5, 3, 200) + [(i, [1.0, 0.5]) for i in range(300, 340)]
    got = vector_search.top_k(spark.createDataFrame([(*x, "z", 1, 2, 3) for x in rows], VECTORS), every=3, k=3)
    assert sorted(map(tuple, got.collect()), key=str) == best(rows, 3, 3, 256)
    assert len(waves) > 1 and len({x[:2] for wave in waves for x in wave}) == sum(map(len, waves))


def test_top_k_hands_tasks_no_more_than_the_table(spark, monkeypatch):
    """What reaches the tasks grows with the vectors, not with the pairs of a block of queries and one of vectors."""
    table = spark.createDataFrame([(*x, "z", 1, 2, 3) for x in vectors(9, 64, 1500)], VECTORS)
    handed, run = [], type(table).mapInArrow

    def counted(df, *args):
        width = {"binary": F.octet_length, "array<bigint>": lambda c: 8 * F.size(c)}
        sizes = [width[kind](c) for c, kind in df.dtypes if kind in width]
        handed.append(df.agg(F.sum(sum(sizes, F.lit(0)).cast("bigint"))).first()[0])
        return run(df, *args)

    monkeypatch.setattr(type(table), "mapInArrow", counted)
    monkeypatch.setattr(vector_search, "BLOCK", 64)
    assert vector_search.top_k(table, every=1).count() > 7000
    assert 0 < sum(handed) < 5 * 1500 * 64 * 8


def test_top_k_of_nothing(spark):
    for rows in ([], [(1, None)], [(50, [0.5])]):
        table = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
        assert vector_search.top_k(table).collect() == []
