"""Quality rules by distribution divergence; built-in functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

# Common words of some languages, the bins of the word histogram.
COMMON_WORDS = (
    "the", "of", "and", "to", "in",
    "der", "die", "und", "von", "zu",
    "de", "la", "le", "et", "les",
    "que", "el", "los", "las", "del",
)
CHAR_CLASSES = ("upper", "lower", "digit", "space", "sign", "beyond")
BLANKS = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
FEW_REPEATS = 64

# A language has a reference if its documents hold so many characters and words in all.
REFERENCE_CHARS, REFERENCE_WORDS = 4_000, 800
MIN_CHARS, MIN_WORDS = 200, 50
# Bounds of the distance, the root of the divergence in bits.
MAX_CHAR_DISTANCE, MAX_WORD_DISTANCE = 0.2645, 0.5


def _left(text: Column, removed: str) -> Column:
    """Characters of a text that are left when those of a pattern go."""
    return F.length(F.regexp_replace(text, removed, "")).cast("bigint")


def _without_blanks(text: Column) -> Column:
    for blank in "\x20\x09\x0a\x0b\x0c\x0d":
        text = F.replace(text, F.lit(blank), F.lit(""))
    return text


def with_repeated_words(rows: DataFrame) -> DataFrame:
    """``rows`` with n_repeat_words: words in a run of three that occurs twice or more.

    ``runs`` has the hashes of the runs in text order. Repeated hashes are looked
    for one by one where they are few; beyond ``FEW_REPEATS`` the hashes are sorted
    with their places, so that equal ones are neighbours. The result is the same.
    """
    rows = rows.withColumn("ordered", F.sort_array("runs"))
    rows = rows.withColumn("twice", F.array_distinct(F.filter("ordered", lambda x, k: x == F.get("ordered", k + 1))))
    sorted_runs = F.array_sort(F.transform("runs", lambda x, k: F.struct(x.alias("h"), k.alias("k"))))
    rows = rows.withColumn("placed", F.when(F.size("twice") > FEW_REPEATS, sorted_runs))
    few = F.transform("runs", lambda x, k: F.when(F.array_contains("twice", x), k).otherwise(F.lit(-1)))

    def marked(x: Column, k: Column) -> Column:
        # an equal neighbour on either side marks a place
        same = (x["h"] == F.get("placed", k + 1)["h"]) | (x["h"] == F.get("placed", k - 1)["h"])
        return F.when(same, x["k"]).otherwise(F.lit(-1))

    found = F.when(F.size("twice") == 0, F.array().cast("array<int>"))
    found = found.when(F.size("twice") <= FEW_REPEATS, F.array_remove(few, F.lit(-1)))
    found = found.otherwise(F.sort_array(F.array_remove(F.transform("placed", marked), F.lit(-1))))
    rows = rows.withColumn("again", found)
    covered = F.aggregate(
        "again",
        F.struct(F.lit(-3).alias("last"), F.lit(0).cast("bigint").alias("total")),
        lambda s, i: F.struct(i.alias("last"), (s["total"] + F.least(F.lit(3), i - s["last"])).alias("total")),
        lambda s: s["total"],
    )
    return rows.withColumn("n_repeat_words", covered)


def statistics(texts: DataFrame, common: Sequence[str]) -> DataFrame:
    """Rows with ``text`` get the base statistics and the histograms ``chars`` and ``words``.

    Each step is a projection of its own, as a lambda would else evaluate what
    it refers to again for each element.
    """
    common = list(dict.fromkeys(common))
    empty = F.array().cast("array<string>")
    trimmed = F.btrim("text", F.lit("\x20\x09\x0a\x0b\x0c\x0d"))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    rows = texts.withColumns({
        "split": F.when(F.length(trimmed) > 0, F.split(trimmed, BLANKS)).otherwise(empty),
        "lines": lines,
        "signs": F.regexp_replace("text", r"[A-Za-z0-9\x20\x09-\x0D\x80-\x{10FFFF}]+", ""),
        "marks": F.regexp_replace("text", "[^A-Z0-9]+", ""),
        "n_chars": F.length("text").cast("bigint"),
        "word_chars": F.length(_without_blanks(F.col("text"))).cast("bigint"),
        "beyond": _left(F.col("text"), r"[\x00-\x7F]+"),
    })
    listed = F.array(*map(F.lit, common))
    runs = F.transform(
        F.sequence(F.lit(0), F.size("split") - 3),
        lambda i: F.xxhash64(F.get("split", i), F.get("split", i + 1), F.get("split", i + 2)),
    )
    rows = rows.withColumns({
        "runs": F.when(F.size("split") >= 3, runs).otherwise(F.array().cast("array<bigint>")),
        "known": F.array_remove(F.transform("split", lambda w: F.array_position(listed, w)), F.lit(0).cast("bigint")),
        "n_words": F.size("split").cast("bigint"),
        "n_symbols": _left(F.col("signs"), f"[^{SYMBOLS}]+"),
        "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint"),
        "sign": F.length("signs").cast("bigint"),
        "digit": _left(F.col("marks"), "[^0-9]+"),
        "capital": F.length("marks").cast("bigint"),
    })
    counts = [F.size("known") - F.size(F.array_remove("known", F.lit(k + 1).cast("bigint"))) for k in range(len(common))]
    upper, space = F.col("capital") - F.col("digit"), F.col("n_chars") - F.col("word_chars")
    lower = F.col("word_chars") - F.col("capital") - F.col("sign") - F.col("beyond")
    rows = rows.withColumns({
        "chars": F.array(upper, lower, F.col("digit"), space, F.col("sign"), F.col("beyond")),
        "words": F.array(*(c.cast("bigint") for c in counts), (F.size("split") - F.size("known")).cast("bigint")),
    })
    rows = with_repeated_words(rows)
    return rows.select("id", "lang", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "chars", "words")


def distance(histogram: Column, reference: Sequence[float]) -> Column:
    """Jensen-Shannon distance, the root of the divergence in bits, of a histogram and a reference; 0 for an empty one."""
    total = F.aggregate(histogram, F.lit(0.0), lambda s, x: s + x)
    pairs = F.arrays_zip(histogram.alias("p"), F.array(*(F.lit(float(q)) for q in reference)).alias("q"))

    def part(x: Column, middle: Column) -> Column:
        return F.when(x > 0, x * F.log2(x / middle)).otherwise(0.0)

    def add(s: Column, z: Column) -> Column:
        p, q = z["p"] / total, z["q"]
        return s + part(p, (p + q) / 2) / 2 + part(q, (p + q) / 2) / 2

    divergence = F.greatest(F.lit(0.0), F.aggregate(pairs, F.lit(0.0), add))
    return F.when(total > 0, F.sqrt(divergence)).otherwise(F.lit(0.0))


def _total(histogram: Column) -> Column:
    return F.aggregate(histogram, F.lit(0).cast("bigint"), lambda s, x: s + x)


def judge(
    docs: DataFrame,
    common: Sequence[str] = COMMON_WORDS,
    max_char_distance: float = MAX_CHAR_DISTANCE,
    max_word_distance: float = MAX_WORD_DISTANCE,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """One row per row of ``docs``: the base statistics, ``char_distance``, ``word_distance``, judged, base_failed, kept.

    References are the summed histograms of each language whose documents hold
    ``REFERENCE_CHARS`` characters and ``REFERENCE_WORDS`` words, however large the
    table. A document's distance is the least over the references: it
    is compared with each language, not with the one it claims. It fails above either
    bound. Not judged, and so not failed by distance, are histograms of fewer than
    ``MIN_CHARS`` characters or ``MIN_WORDS`` words and documents whose language
    has no reference: a rare language is not measured by others.
    A missing text is empty and fails by length. Rows without a language are
    compared like others; rows without an id are judged; repeated rows come out as often as they go in; other
    columns are not read.
    """
    texts = docs.select(
        F.col(id_col).cast("bigint").alias("id"),
        F.col(lang_col).cast("string").alias("lang"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    rows = written(statistics(texts, common), "histograms")
    sums = rows.where("lang is not null").groupBy("lang").agg(
        F.array(*(F.sum(F.get("chars", F.lit(k))) for k in range(len(CHAR_CLASSES)))).alias("chars"),
        F.array(*(F.sum(F.get("words", F.lit(k))) for k in range(len(dict.fromkeys(common)) + 1))).alias("words"),
    )
    enough = (_total(F.col("chars")) >= REFERENCE_CHARS) & (_total(F.col("words")) >= REFERENCE_WORDS)
    references = sums.where(enough).orderBy("lang").collect()

    def least(column: str) -> Column:
        shares = [[x / max(1, sum(r[column])) for x in r[column]] for r in references]
        found = [distance(F.col(column), s) for s in shares] or [F.lit(0.0)]
        return F.array_min(F.array(*found))

    known = F.col("lang").isNull() | F.col("lang").isin([r["lang"] for r in references])
    judged = rows.withColumns({
        "char_distance": least("chars"), "word_distance": least("words"), "judged": known & F.lit(bool(references)),
    })
    fails = F.col("judged") & (
        ((_total(F.col("chars")) >= MIN_CHARS) & (F.col("char_distance") > max_char_distance))
        | ((_total(F.col("words")) >= MIN_WORDS) & (F.col("word_distance") > max_word_distance))
    )
    base_failed = (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    return judged.select(
        F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "char_distance", "word_distance", "judged", base_failed.alias("base_failed"), (~base_failed & ~fails).alias("kept"),
    )
