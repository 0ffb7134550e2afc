"""Operators on the cases that are easy to lose: rare lines, blocks of items, rare languages, clashing names, shuffles."""

import collections
import math
import random
import time

import numpy as np
import pytest
from cohortlink.llm import (
    common,
    decontamination,
    line_dedup,
    lm_scoring,
    ngram_join,
    quality_rules,
    source_mixing,
    substring_dedup,
    toxicity,
)
from cohortlink.plans.stages import session_run
from cohortlink.sources import files
from pyspark.sql import functions as F

DOCS = "doc_id bigint, lang string, text string"


def frame(spark, texts, lang="en"):
    return spark.createDataFrame([(i, lang, x) for i, x in texts], DOCS)


@pytest.fixture
def no_broadcast(spark, monkeypatch):
    """Every join by shuffle, as beyond the broadcast limit."""
    monkeypatch.setattr(common.broadcast_if_small, "__defaults__", (-1,))
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, old)


# --- line dedup

WORDY = 5


def lines_lost(texts, rare):
    """By all pairs of different texts for rare lines; common lines stay in the first; copies lose all."""
    lost = collections.defaultdict(set)
    split = {i: x.split("\n") for i, x in texts}
    wordy = {i: {t for t in x if len(t.split()) >= WORDY} for i, x in split.items()}
    first = {}
    for i, x in texts:
        if wordy[i] and first.setdefault(x, i) != i:
            lost[i] = set(range(len(split[i])))
    reps = [i for i, x in texts if wordy[i] and first[x] == i]
    holders = collections.defaultdict(list)
    for i in reps:
        for t in wordy[i]:
            holders[t].append(i)
    code = collections.defaultdict(lambda: len(code) + 1)
    number = {i: [code[t] if t.strip() else 0 for t in split[i]] for i in reps}
    long = {i: [t in wordy[i] for t in split[i]] for i in reps}
    for i in reps:
        for k, t in enumerate(split[i]):
            if len(holders[t]) > rare and t in wordy[i] and holders[t][0] != i:
                lost[i].add(k)
        for j in reps:
            if j < i and any(len(holders[t]) <= rare for t in wordy[i] & wordy[j]):
                lost[i].update(line_dedup.lost_lines(number[i], long[i], number[j]))
    return {i: sorted(lost[i]) for i, _ in texts}


def line_corpus(seed, n):
    r = random.Random(seed)
    pool = [f"line {k} has six words here" for k in range(60)] + ["", "  ", "short", "two words", "x"]
    texts = []
    for i in range(n):
        if i and r.random() < 0.4:
            own = texts[r.randrange(i)][1].split("\n")
            own = [r.choice(pool) if r.random() < 0.2 else t for t in own]
            if r.random() < 0.3:
                r.shuffle(own)
        else:
            own = [r.choice(pool) for _ in range(r.choice([1, 2, 3, 8, 20]))]
        texts.append((i, "\n".join(own)))
    return texts + [(n, texts[0][1]), (n + 1, texts[3][1])]


@pytest.mark.parametrize("rare", [200, 4])
def test_line_dedup_equals_all_pairs(spark, rare):
    texts = line_corpus(rare, 100)
    got = line_dedup.remove_common_lines(frame(spark, texts), rare=rare)
    assert {r.doc_id: r.gone_lines for r in got.collect()} == lines_lost(texts, rare)


def test_line_dedup_by_shuffle(spark, no_broadcast):
    texts = line_corpus(9, 60)
    got = line_dedup.remove_common_lines(frame(spark, texts))
    assert {r.doc_id: r.gone_lines for r in got.collect()} == lines_lost(texts, line_dedup.RARE)


def test_lines_in_another_order_still_link(spark):
    x, y = "first of the long lines", "second of the long lines"
    texts = [(1, f"{x}\n{y}"), (2, f"{y}\n{x}"), (3, f"{y}\n{x}"), (4, f"{x}\n{x}"), (5, f"{x}\n{x}")]
    got = {r.doc_id: r.gone_lines for r in line_dedup.remove_common_lines(frame(spark, texts)).collect()}
    assert got[1] == [] and len(got[2]) == 1 and got[3] == [0, 1] and got[5] == [0, 1] and got[4] != []


def test_blocks_of_few_words_stay(spark):
    texts = [(1, "a b c d e f\nshort\nx y"), (2, "a b c d e f\nother\nx y")]
    got = {r.doc_id: r.gone_lines for r in line_dedup.remove_common_lines(frame(spark, texts)).collect()}
    assert got == {1: [], 2: [0]}


def test_aligned_blocks_are_common_and_in_order():
    r = random.Random(2)
    for _ in range(300):
        a, b = ([r.randrange(r.choice([3, 30])) for _ in range(r.randrange(25))] for _ in range(2))
        end_a = end_b = 0
        for i, j, n in line_dedup.aligned_blocks(a, b):
            assert n > 0 and i >= end_a and j >= end_b and a[i : i + n] == b[j : j + n]
            end_a, end_b = i + n, j + n
    assert line_dedup.aligned_blocks([1, 1], [1, 1]) == [(0, 0, 2)]
    assert line_dedup.aligned_blocks([9, 1, 1, 8], [7, 1, 1, 6]) == [(1, 1, 2)]


def test_line_dedup_keeps_columns_of_the_new_names(spark):
    docs = spark.createDataFrame([(1, "a b c d e f", "k", 7, "s")], "doc_id long, text string, kept_text string, Gone_Lines int, split string")
    got = line_dedup.remove_common_lines(docs)
    assert got.columns == [*docs.columns, "_kept_text", "_gone_lines"]
    assert tuple(got.first())[:5] == (1, "a b c d e f", "k", 7, "s")


def test_line_dedup_of_a_very_long_text(spark):
    long = "\n".join(f"{k} is a line of its own" for k in range(30_000))
    got = {r.doc_id: len(r.gone_lines) for r in line_dedup.remove_common_lines(frame(spark, [(1, long), (2, long + "\nend")])).collect()}
    assert got == {1: 0, 2: 30_000}


def test_line_dedup_takes_time_in_proportion_to_the_lines(spark):
    # with every key compared with every other one, this would run for hours
    lines = [f"{k % 150_000} is a line of its own" for k in range(200_000)]
    texts = [(1, "\n".join(lines)), (2, "\n".join([*lines, "end"]))]
    got = {r.doc_id: r.gone_lines for r in line_dedup.remove_common_lines(frame(spark, texts)).collect()}
    assert got == {1: [], 2: list(range(200_000))}


# --- decontamination


def test_items_in_several_blocks_give_the_same_rows(spark):
    r = random.Random(4)
    words = [f"w{k}" for k in range(40)]
    item = lambda n: " ".join(r.choice(words) for _ in range(n))
    bench = [(k, item(r.choice([3, 10, 12, 30]))) for k in range(30)]
    texts = [(i, item(20) + " " + r.choice(bench)[1] + " " + item(10)) for i in range(60)]
    # one id on several rows, each with a text of its own
    texts += [(1, "w1 w2 w3"), (1, bench[0][1]), (1, bench[0][1]), (1, "")]
    docs, items = frame(spark, texts), spark.createDataFrame(bench, "item_id bigint, text string")
    one, many = (
        sorted(map(str, decontamination.find_leaks(docs, items, block_bytes=b).collect())) for b in (1 << 20, 1)
    )
    assert one == many and len(one) == len(texts)
    kept = [decontamination.remove_leaks(docs, items, block_bytes=b).count() for b in (1 << 20, 1)]
    assert kept[0] == kept[1]


def test_a_very_long_item_takes_memory_of_its_own_size():
    items = [(k, " ".join(f"a{k}x{j}" for j in range(200)).encode()) for k in range(50)]
    items.append((99, " ".join(f"b{j}" for j in range(20_000)).encode()))
    queries = decontamination.Queries(items, 10)
    arrays = (queries.flat, queries.start, queries.item, queries.left, queries.need)
    assert sum(x.nbytes for x in arrays) < 2_000_000
    text = b"before " + items[-1][1] + b" after"
    (n, hits, found, longest), (_, other, none, _) = decontamination.search_shard(queries, [text, b"b1 b2 b3"])
    assert (n, len(hits), found, longest) == (20_002, 20_000, [99], 20_000) and not len(other) and none == []


# --- quality rules

GOOD = "The people of the town and the men of the hill went to the river in the morning and saw the boats. "


def test_a_rare_language_is_not_judged_by_others(spark):
    english = [(i, GOOD * 4 + f"Number {i} of the list is in the book.") for i in range(200)]
    russian = "Утром люди города пошли к реке и увидели лодки на воде, а потом вернулись домой с рыбой. " * 5
    for n in (2, 3, 20):
        docs = frame(spark, english).unionByName(frame(spark, [(1000 + k, russian + str(k)) for k in range(n)], "ru"))
        got = quality_rules.judge(docs).where("doc_id >= 1000").collect()
        assert {r.kept for r in got} == {not got[0].base_failed}
        assert {r.judged for r in got} == {n * (len(russian) + 1) >= 4000 and n * 85 >= 800}


def histogram(text, common):
    words = [w for w in text.split() if w]
    ascii_ = [c for c in text if ord(c) < 128]
    upper, lower = (sum(f(c) for c in ascii_) for f in (lambda c: c.isupper(), lambda c: c.islower()))
    digit, space = sum(c.isdigit() for c in ascii_), sum(c in " \t\n\v\f\r" for c in ascii_)
    beyond = len(text) - len(ascii_)
    chars = [upper, lower, digit, space, len(ascii_) - upper - lower - digit - space, beyond]
    return chars, [words.count(w) for w in common] + [sum(w not in common for w in words)]


def js_distance(a, b):
    p, q = ([x / sum(v) for x in v] for v in (a, b))
    part = lambda x, m: x * math.log2(x / m) if x > 0 else 0.0
    return math.sqrt(max(0, sum(part(x, (x + y) / 2) + part(y, (x + y) / 2) for x, y in zip(p, q, strict=True)) / 2))


def test_distances_equal_a_direct_computation(spark):
    r = random.Random(8)
    texts = [(i, " ".join(r.choice(GOOD.split()) for _ in range(80))) for i in range(60)]
    texts += [(100, "$#% 77 " * 60), (101, "AAAA BBBB CCCC " * 20), (102, "tiny"), (103, "1 2 3 4 5 " * 40), (104, GOOD * 3)]
    got = {x.doc_id: x for x in quality_rules.judge(frame(spark, texts)).collect()}
    common_words = list(quality_rules.COMMON_WORDS)
    own = {i: histogram(x, common_words) for i, x in texts}
    sums = [[sum(h[k][j] for h in own.values()) for j in range(len(own[0][k]))] for k in (0, 1)]
    for i, x in texts:
        far = [js_distance(own[i][k], sums[k]) for k in (0, 1)]
        assert (got[i].char_distance, got[i].word_distance) == pytest.approx(far, abs=1e-9)
        fails = (len(x) >= 200 and far[0] > 0.2645) or (sum(own[i][1]) >= 50 and far[1] > 0.5)
        assert got[i].kept == (not got[i].base_failed and not fails)


# --- toxicity


def all_segments(scores):
    """Ruzzo and Tompa by definition: the best stretch, then the same left and right of it."""
    best = max(((sum(scores[i:j]), -(j - i), i, j) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)), default=(0, 0, 0, 0))
    if best[0] <= 0:
        return []
    _, _, i, j = best
    return all_segments(scores[:i]) + [(i, j)] + [(a + j, b + j) for a, b in all_segments(scores[j:])]


def test_segments_equal_the_recursive_definition():
    r = random.Random(6)
    for _ in range(200):
        scores = [r.choice([-2.125, -1.0625, -0.5, 0.25, 1.03125, 2.5]) + r.random() / 1024 for _ in range(r.randrange(20))]
        assert [(a, b) for a, b, _ in toxicity.segments(scores, 0.0)] == all_segments(scores)


def test_segments_take_linear_time():
    def seconds(n):
        scores, start = [1.0, -2.0] * (n // 2), time.process_time()
        assert len(toxicity.segments(scores, 0.0)) == n // 2
        return time.process_time() - start

    seconds(1000)
    assert seconds(200_000) < 2.0


def test_several_passages_count_more_than_one(spark):
    model = toxicity.Model({"bad": 2.0}, -0.1, 0.0, 0.2, 0.0, 0.05)
    gap = " fine" * 200
    texts = [(1, "bad bad bad" + gap), (2, "bad bad bad" + gap + " bad bad bad"), (3, "fine"), (4, None)]
    got = {r.doc_id: r for r in toxicity.score(frame(spark, texts), model).collect()}
    assert got[2].best == pytest.approx(2 * got[1].best) and len(got[2].spans) == 2 and got[2].score > got[1].score > got[3].score
    assert got[3].score == pytest.approx(got[4].score)
    kept = {r.doc_id for r in toxicity.reject(frame(spark, texts), model, 0.7).collect()}
    assert kept == {i for i, x in got.items() if x.score < 0.7}


@pytest.mark.parametrize("labels", [[], [(1, 1)], [(1, 0), (2, 0)], [(None, 1), (7, 1), (7, 0)]])
def test_toxicity_without_both_labels(spark, labels):
    docs = frame(spark, [(1, "some text"), (2, None), (2, None), (None, "no id")])
    known = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    model = toxicity.fit(toxicity.labelled_texts(docs, known))
    got = toxicity.score(docs, model).collect()
    assert len(got) == 4 and len({r.score for r in got}) == 1
    assert toxicity.score(docs.limit(0), model).count() == 0


def test_no_word_of_the_model_is_left_out(spark):
    texts = [(i, " ".join(f"{'bad' if i % 2 else 'good'}{k}" for k in range(300)) + f" n{i}") for i in range(60)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id bigint, toxic int")
    labelled = toxicity.labelled_texts(frame(spark, texts), labels)
    assert len([w for w in toxicity.fit(labelled).weights if w.startswith("bad")]) == 300
    fewer = toxicity.fit(labelled, labelled_rows=30)
    assert fewer.weights.keys() <= toxicity.fit(labelled).weights.keys() | fewer.weights.keys()


# --- mixing


def brute_rates(members, targets, share):
    """Projected gradient without momentum, to the end."""
    n = np.array([m.n_tokens for m in members], dtype=float)
    p = np.array([m.posterior for m in members])
    goal = share * n.sum() * np.array(list(targets.values())) / sum(targets.values())
    x = np.ones(len(n))
    a = (p * n[:, None]) / n.sum()
    for _ in range(20_000):
        x = np.maximum(0, x - a @ (a.T @ x - goal / n.sum()) * n.sum() / max(n))
    return (p * n[:, None] * x[:, None]).sum(axis=0)


def test_rates_meet_what_a_plain_descent_meets(spark):
    r = random.Random(1)
    rows = []
    for i in range(200):
        a = r.random()
        rows.append((i, r.randrange(1, 50), [a, 1 - a]))
    members = spark.createDataFrame(rows, "doc_id bigint, n_tokens bigint, posterior array<double>")
    targets = {"one": 0.7, "two": 0.3}
    got = source_mixing.fit_rates(members, targets).collect()
    expected = brute_rates(members.collect(), targets, 0.5)
    reached = [sum(x.rate * x.n_tokens * x[f"p_{d}"] for x in got) for d in targets]
    assert reached == pytest.approx(expected.tolist(), rel=0.02) and all(x.rate >= 0 for x in got)


def test_mixing_keeps_columns_of_the_new_names(spark):
    schema = "doc_id bigint, text string, N_Tokens int, rate string, p_good double, moved int"
    rows = [(i, "word " * i, 7, "r", 0.5, 1) for i in range(5)] + [(None, None, 7, "r", 0.5, 1)] * 2
    labels = spark.createDataFrame([(1, "good"), (2, "poor"), (2, "good")], "doc_id bigint, domain string")
    targets = {"good": 0.5, "poor": 0.5}
    for known in (labels, labels.limit(0)):
        members = source_mixing.posteriors(spark.createDataFrame(rows, schema), known, list(targets))
        got = source_mixing.fit_rates(members, targets)
        assert got.columns == ["doc_id", "_N_Tokens", "_rate", "_p_good", "_moved", "n_tokens", "p_good", "p_poor", "rate"]
        assert got.count() == 7 and {tuple(x)[1:5] for x in got.collect()} == {(7, "r", 0.5, 1)}
    empty = source_mixing.posteriors(spark.createDataFrame([], schema), labels, list(targets))
    assert source_mixing.fit_rates(empty, targets).count() == 0


# --- shared helpers


def test_scratch_tables_go_and_results_stay(spark):
    with common.scratch(spark):
        gone = common.written(spark.range(3), "gone")
        with common.scratch(spark):
            kept = common.written(spark.range(4), "kept", outside=True)
        last = common.written(gone.unionAll(kept), "last", outside=True)
    assert last.count() == 7
    assert not files.exists(spark, gone.inputFiles()[0].rpartition("/")[0]) if gone.inputFiles() else True
    assert session_run(spark).folder in last.inputFiles()[0]


def test_hash_ranges_follow_the_bytes(spark):
    texts = spark.createDataFrame([("x" * 1000,)] * 64, "text string")
    assert common.ranges(texts, 1.0, 1000) == 64 and common.ranges(texts, 0.5, 64_000) == 1
    assert common.ranges(texts.limit(0), 1.0) == 1


def test_joins_by_shuffle_give_the_same(spark, no_broadcast):
    r = random.Random(5)
    words = [f"w{k}" for k in range(50)]
    texts = [(i, " ".join(r.choice(words) for _ in range(60))) for i in range(20)]
    texts += [(20 + i, x.replace("w1 ", "w2 ", 1)) for i, x in texts]
    docs = frame(spark, texts)
    shuffled = [sorted(map(tuple, f(docs).collect())) for f in (ngram_join.similarity_classes, _cut)]
    common.broadcast_if_small.__defaults__ = (1 << 25,)
    assert shuffled == [sorted(map(tuple, f(docs).collect())) for f in (ngram_join.similarity_classes, _cut)]


def _cut(docs):
    return substring_dedup.remove_repeats(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256))


@pytest.mark.parametrize("every", [True, False])
def test_lm_scores_with_one_model_empty(spark, every):
    docs = spark.createDataFrame([(1, "a b a b c"), (2, "a b d"), (3, None), (4, "")], "doc_id bigint, text string")
    ids = spark.createDataFrame([(k,) for k in (1, 2, 3, 4) if every], "doc_id bigint")
    got = {r.doc_id: r for r in lm_scoring.score_documents(docs, ids).collect()}
    assert {i: r.n_words for i, r in got.items()} == {1: 5, 2: 3, 3: 0, 4: 0}
    assert got[3].loss_difference == got[4].loss_difference == 0
    if every:  # the target knows words of the other document, the background none
        assert got[1].loss_difference < 0 and got[2].loss_difference < 0
    else:
        assert got[1].loss_difference == got[2].loss_difference == 0
