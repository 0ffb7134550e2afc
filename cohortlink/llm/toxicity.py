"""Toxicity: maximum-scoring segments over token log-odds, calibrated by the extreme values of clean text."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, chunks, gives_back, keep_rows, written

# The model is fitted on at most about so many labelled documents, those of the lowest id hashes, whatever
# the size of the corpus. That bounds its words, of which none is left out, and so what is sent to every task.
LABELLED_ROWS = 200_000
MIN_Z = 3.0
# With many documents small effects are significant, too; a word of the model is this much likelier in toxic ones.
MIN_ODDS = math.log(4.0)
PRIOR_DOCS = 10.0
# Score of a word that the model does not know: stretches end where such words go on.
REST = -0.1
SEGMENT_P = 0.01


@dataclass(frozen=True)
class Model:
    """Log-odds by word (others take ``rest``), location and scale of clean extremes, and a logistic curve.

    The best stretch of a clean document of n words follows a Gumbel law about
    ``location`` + ``scale`` * ln n: a longer text has more chances.
    """

    weights: dict[str, float]
    rest: float
    location: float
    scale: float
    intercept: float
    slope: float

    def threshold(self, n_words: int) -> float:
        """The score that the best stretch of a clean document exceeds with probability ``SEGMENT_P``."""
        return self.location + self.scale * (math.log(max(n_words, 1)) - math.log(-math.log1p(-SEGMENT_P)))

    def excess(self, best: float, n_words: int) -> float:
        """How many scales a score is beyond the law's location."""
        return (best - self.location) / self.scale - math.log(max(n_words, 1))


def surprise(z: float) -> float:
    """-log P(a clean document's best segment reaches z) under the Gumbel law."""
    if z > 30:
        return min(z, 60.0)
    return -math.log(max(-math.expm1(-math.exp(-max(z, -30.0))), 1e-26))


def segments(scores: list[float], least: float) -> list[tuple[int, int, float]]:
    """All maximal-scoring stretches (start, end, score) of at least ``least``, in linear time.

    Each stretch on the list keeps the running sum before and after it and the
    place of the last stretch with a lower sum before. A new one joins with that
    one, unless its sum after is not lower; places in between are never visited again.
    """
    found: list[list[float]] = []  # start, end, sum before, sum after, place of the last with a lower sum before
    total = 0.0
    for i, s in enumerate(scores):
        before = total
        total += s
        if s <= 0:
            continue
        new = [i, i + 1, before, total, -1]
        j = len(found) - 1
        while True:
            while j >= 0 and found[j][2] >= new[2]:
                j = found[j][4]
            if j < 0 or found[j][3] >= new[3]:
                new[4] = j
                found.append(new)
                break
            new = [found[j][0], new[1], found[j][2], new[3], -1]
            after = found[j][4]
            del found[j:]
            j = after
    return [(int(a), int(b), high - low) for a, b, low, high, _ in found if high - low >= least]


def combined(best: float, scores: list[float]) -> float:
    """What a document is judged by: the sum of its significant stretches, at least its best stretch."""
    return max(best, sum(scores))


# ASCII signs and controls are blanks; letters and digits of all scripts stay.
SIGNS = bytes(b if b >= 0x80 or chr(b).isalnum() or b == 0x27 else 0x20 for b in range(256))
# A word that is not in the model is judged by its first letters, if they are.
STEM_LETTERS = 5
STEM_MARK = b"^"


def tokens(text: bytes) -> list[bytes]:
    """Lower-cased words without the signs around them."""
    return text.decode(errors="replace").lower().encode().translate(SIGNS).split()


def stem_of(word: bytes) -> bytes | None:
    """The first letters of a longer word, marked so that they differ from any word."""
    letters = word.decode()
    return STEM_MARK + letters[:STEM_LETTERS].encode() if len(letters) > STEM_LETTERS else None


class Weights(dict):
    """Word to score, by the word itself, else its stem, else ``rest``; remembered up to a bound."""

    def __init__(self, weights: dict[str, float], rest: float):
        super().__init__()
        self.known = {k.encode(): v for k, v in weights.items()}
        self.rest = rest

    def __missing__(self, word: bytes) -> float:
        if len(self) > 300_000:
            self.clear()
        value = self.known.get(word)
        if value is None:
            value = self.known.get(stem_of(word), self.rest)
        self[word] = value
        return value


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("binary").alias("text"))


def word_counts(labelled: DataFrame) -> DataFrame:
    """(word, bad0, good0, bad1, good1): documents holding each word or stem, by label and half of the corpus.

    ``labelled`` has (mark, text), where mark is 2 * half + toxic. Documents are
    counted, not repetitions, and per chunk before anything is shuffled.
    """
    names = ("good0", "bad0", "good1", "bad1")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for marks, texts in chunks(batches):
            counts: tuple[Counter, ...] = tuple(Counter() for _ in names)
            for mark, text in zip(marks, texts, strict=True):
                words = set(tokens(text))
                stems = set(map(stem_of, words))
                stems.discard(None)
                counts[mark].update(words)
                counts[mark].update(stems)
            words = list(set().union(*counts))
            columns = [pa.array([c[w] for w in words], pa.int64()) for c in counts]
            yield pa.RecordBatch.from_arrays(
                [pa.array(words, pa.binary()).cast(pa.string()), *columns], names=["word", *names]
            )

    rows = labelled.mapInArrow(gives_back(run), "word string, " + ", ".join(f"{n} bigint" for n in names))
    return rows.groupBy("word").agg(*(F.sum(n).alias(n) for n in names))


def log_odds(
    counts: DataFrame, bad: Column, good: Column, n_bad: int, n_good: int, min_z: float, prior: float
) -> dict[str, float]:
    """Weights of the words and stems that mark toxic documents.

    The Dirichlet prior of a word is its share of all documents times ``prior``;
    a word counts if its log-odds are ``MIN_ODDS`` at least and ``min_z`` standard deviations above none.
    """
    if not n_bad or not n_good:
        return {}
    share = F.lit(prior / (n_bad + n_good)) * (bad + good)
    odds_bad = F.log((bad + share) / (F.lit(n_bad + prior) - bad - share))
    odds_good = F.log((good + share) / (F.lit(n_good + prior) - good - share))
    error = F.sqrt(1 / (bad + share) + 1 / (good + share))
    scored = (
        counts.where(bad > 0)
        .select("word", (odds_bad - odds_good).alias("w"), ((odds_bad - odds_good) / error).alias("z"))
        .where((F.col("z") >= min_z) & (F.col("w") >= MIN_ODDS))
    )
    return {r["word"]: r["w"] for r in scored.collect()}


def best_segments(docs: DataFrame, model: Model, all_segments: bool = False) -> DataFrame:
    """(id, n_words, best, spans) for (id, text) rows; a span is (start, end, score) in words.

    With ``all_segments`` the spans are the significant stretches and ``best`` is
    what they sum up to (``combined``), else ``best`` is the best stretch alone.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        weights = Weights(model.weights, model.rest)
        for ids, texts in chunks(batches):
            words = [tokens(t) for t in texts]
            counts = list(map(len, words))
            scores = np.fromiter(
                map(weights.__getitem__, chain.from_iterable(words)), dtype=np.float64, count=sum(counts)
            )
            best, spans, start = [], [], 0
            for n in counts:
                own = scores[start : start + n]
                start += n
                high = _best(own)
                least = model.threshold(n) if all_segments else 0.0
                found = segments(own.tolist(), least) if all_segments and high >= least and high > 0 else []
                best.append(combined(high, [s for _, _, s in found]))
                spans.append([{"start": a, "end": b, "score": s} for a, b, s in found])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(counts, pa.int64()), pa.array(best, pa.float64()), pa.array(spans, SPANS)],
                names=["id", "n_words", "best", "spans"],
            )

    return docs.mapInArrow(
        gives_back(run), "id bigint, n_words bigint, best double, spans array<struct<start bigint, end bigint, score double>>"
    )


SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))


def _best(scores: np.ndarray) -> float:
    """The highest sum of a stretch, 0 if none is positive."""
    if not len(scores):
        return 0.0
    sums = np.concatenate([[0.0], np.cumsum(scores)])
    return max(0.0, float((sums - np.minimum.accumulate(sums)).max()))


def fit(
    labelled: DataFrame, min_z: float = MIN_Z, prior: float = PRIOR_DOCS, labelled_rows: int = LABELLED_ROWS
) -> Model:
    """Learn from (id, text, toxic) rows.

    The calibration comes from one half of the rows, parted by the id's hash,
    scored with weights of the other half; the final weights come from all rows.
    Of more than ``labelled_rows`` rows about so many are taken, those of the
    lowest id hashes. Of rows with equal texts the one of the lowest id is taken, with the highest label. Without rows, or with one label only, every text
    scores alike. Rows without an id, and of a missing text count like others.
    """
    # copies of a text are one witness of its words
    text = F.coalesce("text", F.lit(b""))
    coded = labelled.select("id", "toxic", F.xxhash64(F.lit(1), text).alias("p"), F.xxhash64(F.lit(2), text).alias("q"))
    firsts = written(coded.groupBy("p", "q").agg(F.min("id").alias("id"), F.max("toxic").alias("toxic")), "witnesses")
    given = firsts.count()
    if given > labelled_rows:
        place = F.pmod(F.xxhash64(F.lit(1), "id"), F.lit(1 << 30))
        firsts = firsts.where(place < int((1 << 30) * labelled_rows / given))
    known = firsts.groupBy("id").agg(F.max("toxic").alias("toxic"))
    labelled = labelled.select("id", "text").join(broadcast_if_small(known, 12), "id")
    half = F.coalesce(F.pmod(F.xxhash64("id"), F.lit(2)), F.lit(0))
    marked = labelled.select((2 * half + F.col("toxic")).cast("bigint").alias("mark"), "text")
    counts = written(word_counts(marked), "word-counts")
    n = {r[0]: r[1] for r in marked.groupBy("mark").count().collect()}
    good0, bad0, good1, bad1 = (n.get(i, 0) for i in range(4))
    one = log_odds(counts, F.col("bad0"), F.col("good0"), bad0, good0, min_z, prior)
    model = Model(one, REST, 0.0, 1.0, 0.0, 1.0)
    rows = labelled.where(half == 1)
    # the label rides in the lowest bit of the id
    coded = rows.select((F.shiftleft("id", 1) + F.col("toxic")).alias("id"), "text")

    def steps(model: Model) -> list[tuple[int, int, float, int]]:
        scored = best_segments(coded, model, model.scale > 0)
        # Few distinct values matter: scores are counted in steps of a tenth, lengths in doublings.
        length = F.floor(F.log2(F.col("n_words") + 1)).cast("int").alias("length")
        counted = scored.groupBy(F.col("id").bitwiseAND(F.lit(1)).alias("toxic"), length, F.round("best", 1).alias("best"))
        return [tuple(r) for r in counted.count().collect()]

    # the law of single stretches in clean text says which stretches are significant; documents are judged by their sum
    model = extremes(replace(model, scale=0.0), steps(replace(model, scale=0.0)))
    model = calibrate(model, steps(model))
    both = log_odds(
        counts, F.col("bad0") + F.col("bad1"), F.col("good0") + F.col("good1"), bad0 + bad1, good0 + good1,
        min_z, prior,
    )
    return replace(model, weights=both)


# Clean documents of a length class that make its quartiles known, and the least scale of the law.
CLASS_DOCS, LEAST_SCALE = 20, 0.5


def _words_of_class(length: int) -> float:
    return 1.5 * 2.0**length


def _quartiles(values: list[tuple[float, int]]) -> list[float]:
    values = sorted(values)
    upto = np.cumsum([n for _, n in values])
    return [values[int(np.searchsorted(upto, share * upto[-1]))][0] for share in (0.25, 0.5, 0.75)]


def extremes(model: Model, steps: list[tuple[int, int, float, int]]) -> Model:
    """The Gumbel law of clean documents' best stretches, by quartiles; scale 0 where labels tell nothing.

    Quartiles are not moved by the few documents whose label or length is odd.
    """
    by_length: dict[int, list[tuple[float, int]]] = {}
    for toxic, length, best, n in steps:
        if toxic == 0:
            by_length.setdefault(length, []).append((best, n))
    if not by_length or not any(t for t, _, _, _ in steps):
        return replace(model, location=0.0, scale=0.0)
    sizes = {k: sum(n for _, n in v) for k, v in by_length.items()}
    chosen = [k for k, n in sizes.items() if n >= CLASS_DOCS] or list(sizes)
    quartiles = {k: _quartiles(by_length[k]) for k in chosen}
    total = sum(sizes[k] for k in chosen)
    spread = sum(sizes[k] * (quartiles[k][2] - quartiles[k][0]) for k in chosen) / total
    # quartiles of a Gumbel law of scale 1 lie 1.5725 apart, its median 0.3665 above its location
    scale = max(LEAST_SCALE, spread / 1.5725)
    middle = sum(sizes[k] * (quartiles[k][1] - scale * math.log(_words_of_class(k))) for k in chosen) / total
    return replace(model, location=middle - 0.3665 * scale, scale=scale)


def calibrate(model: Model, steps: list[tuple[int, int, float, int]]) -> Model:
    """A logistic curve on the surprise of what documents are judged by, by Newton steps."""
    if model.scale <= 0:
        bad, total = (sum(n for t, _, _, n in steps if t == k) for k in (1, 0))
        share = (bad + 0.5) / (bad + total + 1.0)
        return replace(model, intercept=math.log(share / (1 - share)), slope=0.0)
    x = np.array([surprise(model.excess(b, int(_words_of_class(k)))) for _, k, b, _ in steps])
    y = np.array([t for t, _, _, _ in steps], dtype=float)
    n = np.array([c for _, _, _, c in steps], dtype=float)
    beta = np.zeros(2)
    design = np.stack([np.ones_like(x), x], axis=1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (n * (y - p)) - 0.01 * beta
        curvature = (design * (n * p * (1 - p))[:, None]).T @ design + 0.01 * np.eye(2)
        step = np.linalg.solve(curvature, gradient)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return replace(model, intercept=float(beta[0]), slope=max(float(beta[1]), 0.0))


def labelled_texts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """(id, text, toxic) of the documents that carry a label of 0 or 1; of several labels the highest counts."""
    marks = (
        labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1))
        .groupBy(F.col(id_col).cast("bigint").alias("id"))
        .agg(F.max(F.col(label_col).cast("int")).alias("toxic"))
    )
    return _texts(docs, id_col, text_col).join(broadcast_if_small(marks, 12), "id")


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score, n_words, best, spans) for each row of ``docs``.

    ``score`` is the label probability, from 0 to 1; ``spans`` are all stretches
    of words that a clean document would hardly show. A missing or empty text has no
    words and takes the score of a best segment of 0. A row without an id is
    scored like any other; repeated rows come out as often as they go in; other
    columns are not read. No row moves between machines.
    """
    scored = best_segments(_texts(docs, id_col, text_col), model, all_segments=True)
    if model.scale <= 0:
        x = F.lit(float(model.intercept))
    else:
        length = F.log(F.greatest(F.col("n_words"), F.lit(1)).cast("double"))
        z = (F.col("best") - F.lit(model.location)) / F.lit(model.scale) - length
        tail = -F.expm1(-F.exp(-F.greatest(z, F.lit(-30.0))))
        x = F.lit(model.intercept) + F.lit(model.slope) * F.when(z > 30, F.least(z, F.lit(60.0))).otherwise(
            -F.log(F.greatest(tail, F.lit(1e-26)))
        )
    chance = 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), x))))
    return scored.select(F.col("id").alias(id_col), chance.alias("score"), "n_words", "best", "spans")


def reject(
    docs: DataFrame, model: Model, threshold: float = 0.7, text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs``, all columns, whose score is below ``threshold``; scores and odd cases as in ``score``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make_judge():
        model = shared.value
        weights = Weights(model.weights, model.rest)

        def judge(texts: list[bytes]) -> list[bool]:
            scores = (np.fromiter(map(weights.__getitem__, tokens(t)), dtype=np.float64) for t in texts)
            return [chance(model, total(model, own), len(own)) < threshold for own in scores]

        return judge

    return keep_rows(docs, text_col, make_judge)


def total(model: Model, scores: np.ndarray) -> float:
    """What a document with these word scores is judged by."""
    high, least = _best(scores), model.threshold(len(scores))
    if model.scale <= 0 or high < least or high <= 0:
        return high
    return combined(high, [s for _, _, s in segments(scores.tolist(), least)])


def chance(model: Model, best: float, n_words: int) -> float:
    """Label probability of a document by what it is judged by."""
    x = model.intercept
    if model.scale > 0:
        x += model.slope * surprise(model.excess(best, n_words))
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, x))))
