"""Each stage of the pipeline against a direct version, on what its predecessor kept."""

import re

import corpus_pipeline
import pytest
from cohortlink.llm import toxicity
from cohortlink.llm.common import load, written
from cohortlink.llm.queries import DOMAIN_TARGETS, learning_labels

DIRECTORY = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile("[^\x20\x09-\x0d]+")
ALNUM = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


@pytest.fixture(scope="module")
def stages(spark):
    """Documents and the result of each stage."""
    tables = [load(spark, DIRECTORY, "documents")]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        tables.append(written(stage(spark, tables[-1], DIRECTORY), f"tested{k}"))
    return tables


def texts(df):
    return {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}


def test_stages_keep_the_columns(stages):
    assert [df.columns for df in stages[1:5]] == [stages[0].columns] * 4


def test_toxic_documents_go(spark, stages):
    model = toxicity.fit(toxicity.labelled_texts(stages[0], learning_labels(load(spark, DIRECTORY, "labels"))))
    low = {r.doc_id for r in toxicity.score(stages[0], model).where("score < 0.7").collect()}
    before = texts(stages[0])
    assert texts(stages[1]) == {i: before[i] for i in low}


def test_lines_go_and_no_others_come(stages):
    before, after = texts(stages[1]), texts(stages[2])
    assert set(after) <= set(before)
    for i, text in after.items():
        rest = iter(before[i].split("\n"))
        assert all(line in rest for line in text.split("\n"))  # a subsequence of the lines
    kept_lines = {line for text in after.values() for line in text.split("\n")}
    for i in set(before) - set(after):  # what goes whole is held elsewhere, or was blank
        assert all(line in kept_lines or not line.strip() for line in before[i].split("\n"))


def test_one_document_of_each_class_stays(stages):
    sets = {}
    for i, text in texts(stages[2]).items():
        w = WORD.findall(text.translate(LOWER))
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    least = {i: i for i in sets}
    links = [(i, j) for i in sets for j in sets if j < i and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]) > 0]
    for _ in sets:
        before = dict(least)
        for i, j in links:
            least[i] = least[j] = min(least[i], least[j])
        if least == before:
            break
    assert set(texts(stages[3])) == {i for i, j in least.items() if i == j}


def test_documents_with_benchmark_windows_go(spark, stages):
    windows = set()
    for (text,) in load(spark, DIRECTORY, "benchmark").select("text").collect():
        w = ALNUM.findall((text or "").translate(LOWER))
        windows |= {tuple(w[k : k + 10]) for k in range(max(1, len(w) - 9))} if w else set()
    sizes = {len(w) for w in windows}

    def clean(text):
        w = ALNUM.findall(text.translate(LOWER))
        return not any(tuple(w[k : k + n]) in windows for n in sizes for k in range(len(w) - n + 1))

    assert texts(stages[4]) == {i: x for i, x in texts(stages[3]).items() if clean(x)}


def test_rates_meet_the_targets(stages):
    found = stages[5].collect()
    assert sorted(r.doc_id for r in found) == sorted(texts(stages[4]))
    every = sum(r.n_tokens for r in found)
    assert all(r.rate >= 0 for r in found)
    for domain, share in DOMAIN_TARGETS.items():
        got = sum(r.rate * r.n_tokens * r[f"p_{domain}"] for r in found) / every
        assert got == pytest.approx(share / 2, abs=0.05)
