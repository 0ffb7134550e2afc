"""Mixing sources to target weights: soft domain membership and document rates; built-in functions only."""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, giving_way, written

# The classifier is fitted on at most so many labelled documents, those of the
# lowest id hashes, whatever the size of the corpus.
SAMPLE_ROWS = 20_000
FEATURES = 8192
REGULARISATION = 0.02
REPLAY = 10
MAX_STEPS = 60
TOLERANCE = 1e-3


def domain_of(quality: Column, toxic: Column) -> Column:
    """The domain a label row names; null if it names none."""
    return F.when(toxic == 1, "toxic").when(quality == 1, "good").when(quality == 0, "poor")


def _words(text: Column) -> Column:
    """Lower-cased ASCII letters and all beyond ASCII make words."""
    lowered = F.lower(F.coalesce(text.cast("string"), F.lit("")))
    return F.array_remove(F.split(lowered, r"[\x00-\x60\x7B-\x7F]+"), "")


def _traits(text: Column, words: Column) -> list[Column]:
    """Marks of the text's form, written as words that no text has: length, variety and share of signs, in steps."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    # signs are few, so cutting them out is far cheaper than cutting out the rest
    signs = F.length(text) - F.length(F.regexp_replace(text, r"[\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]+", ""))
    steps = {
        "#length": F.floor(F.log2(F.size(words) + 1)),
        "#variety": F.floor(10 * F.size(F.array_distinct(words)) / F.greatest(F.size(words), F.lit(1))),
        "#signs": F.floor(F.log2(1 + 100 * signs / F.greatest(F.length(text), F.lit(1)))),
    }
    return [F.concat(F.lit(name), step.cast("string")) for name, step in steps.items()]


def _tokens(text: Column, words: Column) -> Column:
    return F.concat(F.array_distinct(words), F.array(*_traits(text, words)))


def posteriors(
    docs: DataFrame,
    labels: DataFrame,
    domains: list[str],
    id_col: str = "doc_id",
    text_col: str = "text",
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """All columns of ``docs`` but the text, with n_tokens and an array ``posterior`` over ``domains``.

    ``labels`` has (id, domain); of several domains of an id the first in
    alphabetical order counts, and domains that are not listed count for nothing. A missing or empty text
    has no words and is judged by its form; a row without an id, and each of repeated rows, is judged like any other.
    A column of ``docs`` named n_tokens or posterior, in any case, stays, with an underscore in front. The
    classifier is a multinomial logistic regression on hashed words. Without labelled documents
    the posterior is even; with one domain only it is that one.
    """
    docs = giving_way(docs, ["n_tokens", "posterior"])
    code = F.array_position(F.array(*map(F.lit, domains)), F.col("domain"))
    known = labels.where(F.col(id_col).isNotNull() & F.col("domain").isin(*domains))
    known = known.groupBy(F.col(id_col).cast("bigint").alias("id")).agg(F.min("domain").alias("domain"))
    known = known.select("id", (code - 1).cast("double").alias("label"))
    known = written(known.orderBy(F.xxhash64("id"), "id").limit(sample_rows), "labelled")
    seen = [int(r[0]) for r in known.select("label").distinct().collect()]
    hashing = HashingTF(inputCol="words", outputCol="features", numFeatures=FEATURES, binary=True)
    n = len(domains)
    if len(seen) > 1:
        texts = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
        sample = texts.join(broadcast_if_small(known, 16), "id").withColumn("all_words", _words(F.col("text")))
        sample = sample.select("label", _tokens(F.col("text"), F.col("all_words")).alias("words"))
        sample = written(hashing.transform(sample).select("features", "label"), "sample")
        seen = sorted(int(r[0]) for r in sample.select("label").distinct().collect())
    if len(seen) > 1:
        model = LogisticRegression(family="multinomial", regParam=REGULARISATION, maxIter=30).fit(sample)
        named = docs.columns
        inner = [f"c{k}" for k in range(len(named))]
        plain = docs.select(
            *(F.col(f"`{c}`").alias(i) for c, i in zip(named, inner, strict=True)),
            _words(F.col(text_col)).alias("all_words"),
        )
        text = F.col(inner[named.index(text_col)])
        kept = [c for c, name in zip(inner, named, strict=True) if name != text_col]
        n_tokens = F.size("all_words").cast("bigint").alias("n_tokens")
        plain = plain.select(*kept, n_tokens, _tokens(text, F.col("all_words")).alias("words"))
        scored = model.transform(hashing.transform(plain))
        found = vector_to_array("probability")
        # the model knows classes up to the highest one seen
        filled = [F.get(found, F.lit(k)) if k <= max(seen) else F.lit(0.0) for k in range(n)]
        kept = [F.col(i).alias(c) for c, i in zip(named, inner, strict=True) if c != text_col]
        return scored.select(*kept, "n_tokens", F.array(*filled).alias("posterior"))
    even = [1.0 if seen == [k] else 0.0 if seen else 1.0 / n for k in range(n)]
    return docs.select(
        *(f"`{c}`" for c in docs.columns if c != text_col),
        F.size(_words(F.col(text_col))).cast("bigint").alias("n_tokens"),
        F.array(*map(F.lit, even)).alias("posterior"),
    )


def _dot(array: Column, numbers: list[float]) -> Column:
    total = F.lit(0.0)
    for k, x in enumerate(numbers):
        total = total + F.get(array, F.lit(k)) * F.lit(float(x))
    return total


def _replayed(steps: list[tuple[list[float], float]]) -> Column:
    """(rate, ahead) after the given gradient steps and momenta, from the columns of the same names."""
    size = len(steps[0][0]) if steps else 0
    path = F.array(*(F.array(*(F.lit(float(x)) for x in [*g, momentum])) for g, momentum in steps))

    def step(s: Column, g: Column) -> Column:
        slope = F.lit(0.0)
        for k in range(size):
            slope = slope + F.get("posterior", F.lit(k)) * F.get(g, F.lit(k))
        rate = F.greatest(F.lit(0.0), s["ahead"] - slope)
        return F.struct(rate.alias("rate"), (rate + F.get(g, F.lit(size)) * (rate - s["rate"])).alias("ahead"))

    return F.aggregate(path, F.struct("rate", "ahead"), step)


def fit_rates(
    members: DataFrame,
    targets: Mapping[str, float],
    budget_share: float = 0.5,
    max_steps: int = MAX_STEPS,
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """The rows of ``members`` with a nonnegative ``rate``; the posterior becomes columns p_<domain>.

    ``members`` has n_tokens and posterior over the domains of ``targets`` in their
    order. The rates minimise the squared distance between the expected tokens
    of each domain, the sum of rate * n_tokens * posterior, and its share of the
    budget, ``budget_share`` of all tokens. They start at 1 and follow the
    projected gradient with momentum; a step needs the totals of the domains
    only, so what reaches the driver is one number per domain. The rates of a
    row follow from its own posterior and the steps so far, and are written every
    ``REPLAY`` steps. Rows without tokens get rate 0. An empty table stays empty. Other columns stay; one
    named rate, ahead, moved or p_<domain>, in any case, has an underscore in front.
    """
    domains = list(targets)
    members = giving_way(members, ["rate", "ahead", "moved", *(f"p_{d}" for d in domains)])
    weight = np.array([targets[d] for d in domains], dtype=float)
    weight = budget_share * weight / weight.sum()
    n = len(domains)
    table = written(members, "members")
    cross = [
        F.sum(F.col("n_tokens") * F.get("posterior", F.lit(i)) * F.get("posterior", F.lit(j)))
        for i in range(n)
        for j in range(i, n)
    ]
    sums = table.agg(F.sum("n_tokens"), *cross).first()
    tokens = sums[0] or 0
    final = F.lit(1.0)
    state = table.withColumns({"rate": F.lit(1.0), "ahead": F.lit(1.0)})
    if tokens:
        square = np.zeros((n, n))
        square[np.triu_indices(n)] = [x / tokens for x in sums[1:]]
        square = square + np.triu(square, 1).T
        stride = 1.0 / max(float(np.linalg.eigvalsh(square).max()), 1e-12)
        steps: list[tuple[list[float], float]] = []
        momentum = 1.0
        for k in range(max_steps):
            if len(steps) == REPLAY:
                moved = state.withColumn("moved", _replayed(steps))
                state = written(
                    moved.withColumns({"rate": F.col("moved.rate"), "ahead": F.col("moved.ahead")}).drop("moved"), "rates"
                )
                steps = []
            ahead = _replayed(steps)["ahead"] if steps else F.col("ahead")
            expected = [F.sum(F.col("a") * F.col("n_tokens") * F.get("posterior", F.lit(i))) for i in range(n)]
            totals = state.select("n_tokens", "posterior", ahead.alias("a")).agg(*expected).first()
            off = np.array([x / tokens for x in totals]) - weight
            if np.abs(off).max() <= tolerance * weight.sum():
                break
            later = (1 + (1 + 4 * momentum**2) ** 0.5) / 2
            steps.append(((stride * off).tolist(), (momentum - 1) / later))
            momentum = later
        # the point the totals were taken at can dip below 0 by its momentum
        final = F.greatest(F.lit(0.0), _replayed(steps)["ahead"] if steps else F.col("ahead"))
    chosen = F.when(F.col("n_tokens") > 0, final).otherwise(F.lit(0.0))
    kept = [c for c in members.columns if c != "posterior"]
    shares = [F.get("posterior", F.lit(k)).alias(f"p_{d}") for k, d in enumerate(domains)]
    return state.select(*kept, *shares, chosen.alias("rate"))
