"""From raw documents to weighted training text: five stages, each written as a table for the next.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame. All but the last return the columns of documents. A stage
works on all that its predecessor kept. Rows without an id pass; empty tables
stay empty; a column more in documents is carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlink.llm import decontamination, line_dedup, ngram_join, source_mixing, toxicity
from cohortlink.llm.common import broadcast_if_small, fresh, load, ship, written
from cohortlink.llm.queries import DOMAIN_TARGETS, domain_labels, learning_labels


def toxic_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below 0.7."""
    ship(spark)
    model = toxicity.fit(toxicity.labelled_texts(docs, learning_labels(load(spark, sf_dir, "labels"))))
    return toxicity.reject(docs, model)


def common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that they share with an earlier one; those of which nothing is left go."""
    ship(spark)
    kept, gone = fresh(docs, "kept_text", "gone_lines")
    rows = line_dedup.remove_common_lines(docs, kept_col=kept, gone_col=gone)
    rows = rows.where((F.size(gone) == 0) | F.col(kept).rlike(r"[^\x20\x09-\x0D]"))
    text = F.col(kept).alias("text")
    length = F.when(F.size(gone) == 0, F.col("n_chars")).otherwise(F.length(kept)).cast(docs.schema["n_chars"].dataType)
    changed = {"text": text, "n_chars": length.alias("n_chars")}
    return rows.select(*(changed.get(c, F.col(f"`{c}`")) for c in docs.columns))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each class of similar ones."""
    ship(spark)
    classes = ngram_join.similarity_classes(docs)
    copies = written(classes.where("component_id <> doc_id").select("doc_id"), "copies")
    return docs.join(broadcast_if_small(copies, 8), "doc_id", "left_anti").select(*(f"`{c}`" for c in docs.columns))


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    ship(spark)
    return decontamination.remove_leaks(docs, load(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents, without their text, with token counts, domain posteriors and a rate."""
    labels = domain_labels(load(spark, sf_dir, "labels"))
    members = source_mixing.posteriors(docs, labels, list(DOMAIN_TARGETS))
    return source_mixing.fit_rates(members, DOMAIN_TARGETS)


STAGES = [
    ("toxicity", toxic_documents),
    ("line dedup", common_lines),
    ("n-gram jaccard join", near_copies),
    ("benchmark decontamination", benchmark_leaks),
    ("mixing sources", mixed),
]

# The scores, the alignment and the fit are not expressible in SQL; the tests
# compare each stage with a direct version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows, over documents; every stage is written and read again."""
    docs = load(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = written(stage(spark, docs, sf_dir), f"stage{k + 1}")
    return docs
