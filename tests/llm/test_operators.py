"""Each operator against a direct version on hand-made rows, and on rows that are hard to read."""

import collections
import hashlib
import math
import random
import re
import zlib

import public_tokenizers
import pytest
from cohortlink.llm import (
    decontamination,
    line_dedup,
    lm_scoring,
    ngram_join,
    quality_rules,
    secrets,
    source_mixing,
    substring_dedup,
    token_counts,
    toxicity,
)
from pyspark.sql import functions as F

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
WORD = re.compile("[^\x20\x09-\x0d]+")
ALNUM = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
# names that operators use inside, here as other columns of the table
SCHEMA = "doc_id bigint, lang string, text string, id string, n int, label int, words string, mark string, part int"


def table(spark, texts, schema=SCHEMA):
    width = len(schema.split(",")) - 3
    return spark.createDataFrame([(i, "en", x, *[None] * width) for i, x in texts], schema)


def corpus():
    """Texts with exact and near copies, shared passages and lines, short ones and long ones."""
    r = random.Random(7)
    words = [f"w{k}" for k in range(300)] + ["The", "Éa", "x-y"]
    text = lambda n: " ".join(r.choice(words) for _ in range(n))
    passage, line = text(60), "one line that many documents hold"
    out = [(0, None), (1, ""), (2, " \n\t"), (3, "two Words"), (4, "two words"), (5, text(6000))]
    base = text(80)
    for k in range(6, 18):
        w = base.split()
        for _ in range(k % 3):
            w[r.randrange(len(w))] = f"z{r.randrange(9)}"
        out.append((k, " ".join(w)))
    out += [(k, base) for k in range(18, 40)]
    out += [(k, f"{text(20)}\n{line}\n{passage} {text(15)}\n{line}") for k in range(40, 60)]
    out += [(k, text(r.randrange(1, 120))) for k in range(60, 90)]
    return out


@pytest.fixture(scope="module")
def texts():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, texts):
    return table(spark, texts).repartition(5).cache()


def by_id(df):
    found = df.collect()
    return {r[0]: r for r in found}


@pytest.mark.parametrize("blocks", [False, True])
def test_ngram_join_equals_all_pairs(docs, texts, blocks, monkeypatch):
    if blocks:  # no pivots and tiny blocks, so that all links come from the block step
        for name, value in (("PIVOT_ROUNDS", 0), ("FEW", 1), ("BLOCK", 3)):
            monkeypatch.setattr(ngram_join, name, value)
    sets = {}
    for i, x in texts:
        w = WORD.findall((x or "").translate(LOWER))
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in sets:
        for j in sets:
            if j < i and sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    got = by_id(ngram_join.similarity_classes(docs))
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == {i: (len(s), find(i)) for i, s in sets.items()}


@pytest.mark.parametrize("block", [512, 7])
def test_ngram_join_makes_no_rows_of_pairs_ruled_out(spark, block, monkeypatch):
    """Sets alike by a third share twenty signatures; only the pair that may link becomes a row, whatever their number."""
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    r = random.Random(3)
    token = lambda: r.getrandbits(63)
    for members in (8, 16, 48):
        common = [token() for _ in range(50)]
        sets = [[*common, *(token() for _ in range(50))] for _ in range(members)]
        sets[5] = [token(), *sets[2][1:]]
        # the largest component has three sets, which are not compared with one another
        label = [0 if k in (0, 1, 7) else k for k in range(members)]
        live = [(s, k, 100, label[k], members, 1, 100, 0) for s in range(20) for k in range(members)]
        live = spark.createDataFrame(live, "sig long, id long, n long, label long, members long, other long, m long, there long")
        frame = spark.createDataFrame([(k, 100, x) for k, x in enumerate(sets)], "id long, n long, tokens array<long>")
        got = ngram_join.remaining_pairs(live, ngram_join.sketches_of(frame), 75)
        assert [tuple(x) for x in got.collect()] == [(2, 5)]


def test_ngram_join_of_a_set_that_shares_each_token_with_another(spark):
    """A set that meets each of many others under a signature of its own meets them only, and they not one another."""
    r = random.Random(4)
    sets = [[r.getrandbits(63) for _ in range(100)] for _ in range(301)]
    live = [(s, k, 100, k, 2, 0, 100, 0) for s in range(1, 301) for k in (0, s)]
    live = spark.createDataFrame(live, "sig long, id long, n long, label long, members long, other long, m long, there long")
    frame = spark.createDataFrame([(k, 100, x) for k, x in enumerate(sets)], "id long, n long, tokens array<long>")
    got = ngram_join.remaining_pairs(live, ngram_join.sketches_of(frame), 75)
    assert sorted(tuple(x) for x in got.collect()) == [(0, k) for k in range(1, 301)]


def test_substring_dedup_equals_window_table(docs, texts):
    first, words = {}, {}
    for i, x in sorted(texts):
        w = words[i] = WORD.findall(x or "")
        for k in range(len(w) - 12):
            first.setdefault(tuple(w[k : k + 13]), i)
    got = by_id(substring_dedup.remove_repeats(docs))
    assert set(got) == set(words)
    for i, w in words.items():
        gone = set()
        for k in range(len(w) - 12):
            if first[tuple(w[k : k + 13])] < i:
                gone |= set(range(k, k + 13))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        assert (got[i].n_words, got[i].n_removed, got[i].kept_text) == (len(w), len(gone), kept)


def test_lm_scores_equal_direct_losses(spark, docs, texts):
    target = {i for i, _ in texts if i % 2}
    ids = spark.createDataFrame([(i, 1) for i in target], "doc_id bigint, n int")
    got = by_id(lm_scoring.score_documents(docs, ids, 0.1))
    words = {i: (x or "").translate(LOWER).encode().split() for i, x in texts}

    def grams(w):
        before = [None, *w[:-1]] if w else []
        return collections.Counter(zip(before, w, strict=True)), collections.Counter(before)

    rest, mine = [collections.Counter(), collections.Counter()], [collections.Counter(), collections.Counter()]
    for i, w in words.items():
        for k, c in enumerate(grams(w)):
            (mine if i in target else rest)[k].update(c)
    share = sum(len(words[i]) for i in target) / sum(len(w) for i, w in words.items() if i not in target)
    size = len(set().union(*words.values())) + 1
    for i, w in words.items():
        total = 0.0
        for k, (sign, add) in enumerate(((1, 0.1), (-1, 0.1 * size))):
            for g, n in grams(w)[k].items():
                other = math.log(share * (rest[k][g] - n * (i not in target)) + add)
                total += sign * n * (other - math.log(mine[k][g] - n * (i in target) + add))
        assert got[i].loss_difference == pytest.approx(total / max(1, len(w)), abs=1e-5)


def test_token_counts_equal_the_library(spark):
    from tokenizers import Tokenizer

    file = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(file)
    texts = corpus() + [(100, "naïve 東京 🙂 it's  <|endoftext|> a\r\n\n b"), (101, "a" * 5000), (102, " " * 700)]
    got = by_id(token_counts.count_tokens(table(spark, texts), file, 512))
    for i, x in texts:
        n = len(library.encode(x or "", add_special_tokens=False).ids)
        assert (got[i].n_bytes, got[i].n_tokens, got[i].over_limit) == (len((x or "").encode()), n, n > 512)


def test_decontamination_equals_window_table(spark, docs, texts):
    long = WORD.findall(texts[5][1])
    items = [(1, " ".join(long[50:75])), (2, "TWO words"), (3, None), (4, ""), (5, "never seen anywhere"), (2, "TWO words")]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    windows = collections.defaultdict(set)
    for i, x in items:
        w = ALNUM.findall((x or "").translate(LOWER))
        k = min(10, len(w))
        for j in range(len(w) - k + 1 if w else 0):
            windows[tuple(w[j : j + k])].add(i)
    got = by_id(decontamination.find_leaks(docs, bench))
    for i, x in texts:
        w, hit, found = ALNUM.findall((x or "").translate(LOWER)), set(), set()
        for k in {len(g) for g in windows}:
            for j in range(len(w) - k + 1):
                if tuple(w[j : j + k]) in windows:
                    found |= windows[tuple(w[j : j + k])]
                    hit |= set(range(j, j + k))
        assert (got[i].n_words, len(got[i]["hits"]), set(got[i]["items"])) == (len(w), len(hit), found)
    assert {5, 3, 4}.isdisjoint(r.doc_id for r in decontamination.remove_leaks(docs, bench).collect())


def test_line_dedup_cuts_from_the_later_document(docs, texts):
    got = {r.doc_id: r for r in line_dedup.remove_common_lines(docs).collect()}
    assert len(got) == len(texts)
    source = dict(texts)
    assert not got[40].gone_lines and got[0].kept_text is None and got[1].kept_text == ""
    for i, x in texts:
        gone = set(got[i].gone_lines)
        if x is not None:
            assert got[i].kept_text == "\n".join(t for k, t in enumerate(x.split("\n")) if k not in gone)
        if 18 < i < 40:
            assert source[i] == source[18] and got[i].kept_text == ""
        if i < 6 or i >= 60:
            assert not gone


def test_secret_scans_find_the_fixed_patterns(spark):
    texts = [
        (1, 'api_key = "abcd1234efgh" and PASSWORD:short1'),
        (2, "AKIA" + "Q" * 12 + " " + "0f" * 16 + " AKIA123"),
        (3, None),
        (4, ""),
        (5, "é 🙂 token: abcdefgh"),
    ]
    got = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans] for r in secrets.find_secrets(table(spark, texts)).collect()}
    base = {i: [s for s in x if s[0] in secrets.BASE_KINDS] for i, x in got.items()}
    assert base == {1: [("assign", 0, 23)], 2: [("access", 0, 16), ("hex", 17, 49)], 3: [], 4: [], 5: [("assign", 4, 19)]}


def test_quality_statistics_equal_a_direct_count(docs, texts):
    extra = [(200, "a b a b a b # * \U0001f642\n\nx\nx\n \nx"), (201, "q " * 400)]
    spark = docs.sparkSession
    got = by_id(quality_rules.judge(table(spark, texts + extra)))
    for i, x in texts + extra:
        x = x or ""
        w = WORD.findall(x)
        count = collections.Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
        repeated = {k + d for k in range(len(w) - 2) if count[tuple(w[k : k + 3])] > 1 for d in range(3)}
        seen, again = set(), 0
        for t in x.split("\n"):
            if WORD.search(t):
                again += t in seen
                seen.add(t)
        failed = len(w) < 50 or 100 * len(repeated) > 50 * len(w)
        signs = sum(c in "#*$%&|<>" for c in x)
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == (
            len(w), sum(map(len, w)), signs, again, len(repeated), failed,
        )
        assert not (r.base_failed and r.kept)


def test_toxicity_on_held_out_rows(spark):
    r = random.Random(3)
    texts = []
    for i in range(600):
        w = [f"w{r.randrange(80)}" for _ in range(60)]
        if i % 3 == 0:
            w[20:26] = [f"bad{r.randrange(4)}" for _ in range(6)]
        texts.append((i, " ".join(w)))
    texts += [(1000, None), (1001, "")]
    frame = table(spark, texts)
    seen = [(i, int(i % 3 == 0)) for i in range(600) if zlib.crc32(str(i).encode()) % 3 != 1]
    labels = spark.createDataFrame(seen, "doc_id bigint, toxic int")
    model = toxicity.fit(toxicity.labelled_texts(frame, labels))
    got = by_id(toxicity.score(frame, model))
    assert len(got) == len(texts) and all(0 <= x.score <= 1 for x in got.values())
    held = [i for i in range(600) if zlib.crc32(str(i).encode()) % 3 == 1]
    assert sum((got[i].score >= 0.7) == (i % 3 == 0) for i in held) >= 0.97 * len(held)
    kept = {x.doc_id for x in toxicity.reject(frame, model).collect()}
    assert kept == {i for i, x in got.items() if x.score < 0.7}


def test_mixing_meets_reachable_targets(spark):
    r = random.Random(5)
    kinds = {"good": "alpha", "poor": "beta"}
    texts = [(i, " ".join(f"{kinds['good' if i % 4 else 'poor']}{r.randrange(30)}" for _ in range(50))) for i in range(400)]
    frame = table(spark, [*texts, (900, None), (901, "")]).withColumn("source", F.lit("web"))
    labels = spark.createDataFrame([(i, "good" if i % 4 else "poor") for i in range(200)], "doc_id bigint, domain string")
    targets = {"good": 0.6, "poor": 0.4}
    found = source_mixing.fit_rates(source_mixing.posteriors(frame, labels, list(targets)), targets).collect()
    assert len(found) == 402 and all(x.rate >= 0 for x in found)
    mass = {d: sum(x.rate * x.n_tokens * x[f"p_{d}"] for x in found) for d in targets}
    for d, share in targets.items():
        assert mass[d] / sum(mass.values()) == pytest.approx(share, abs=0.02)


def test_empty_tables(spark):
    none = table(spark, []).withColumn("source", F.lit("web"))
    bench = spark.createDataFrame([], "item_id bigint, text string")
    ids = none.select("doc_id")
    file = public_tokenizers.path("byte_bpe_50k.json")
    for result in (
        ngram_join.similarity_classes(none),
        substring_dedup.remove_repeats(none),
        lm_scoring.score_documents(none, ids),
        token_counts.count_tokens(none, file, 512),
        decontamination.find_leaks(none, bench),
        line_dedup.remove_common_lines(none),
        secrets.find_secrets(none),
        quality_rules.judge(none),
    ):
        assert result.count() == 0


def test_repeated_rows_and_rows_without_an_id(spark):
    text = "seven words stand here in one line again and then some more of them to the end"
    frame = table(spark, [(1, text), (1, text), (None, text), (2, text)])
    assert {(r.doc_id, r.component_id) for r in ngram_join.similarity_classes(frame).collect()} == {(1, 1), (2, 1)}
    cut = sorted((r.doc_id, r.n_removed) for r in substring_dedup.remove_repeats(frame).collect())
    assert cut == [(1, 0), (1, 0), (2, 17)]
    lines = line_dedup.remove_common_lines(frame).collect()
    assert sorted((r.doc_id or 0, len(r.gone_lines)) for r in lines) == [(0, 0), (1, 0), (1, 0), (2, 1)]
    assert quality_rules.judge(frame).count() == 4 and secrets.find_secrets(frame).count() == 4


def test_digest_is_of_the_kept_text(docs):
    row = substring_dedup.remove_repeats(docs).where("doc_id = 3").select("kept_text", F.sha2("kept_text", 256).alias("h")).first()
    assert row.h == hashlib.sha256(row.kept_text.encode()).hexdigest()
