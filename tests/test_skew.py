"""A third of all rows share one key: AQE must be able to split the join that meets it."""

from datetime import date, datetime

from collections import Counter

import pytest
from pyspark.sql import functions as F

from cohortlink.config import Concepts
from cohortlink.operators import exports, linkage, registry, roster
from cohortlink import schemas

C = Concepts()
N = 30_000
LOW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
    "spark.sql.shuffle.partitions": "12",
}


@pytest.fixture
def low_thresholds(spark):
    old = {k: spark.conf.get(k) for k in LOW}
    for k, v in LOW.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def split_joins(df):
    """How many joins of the final plan AQE has split, and the rows."""
    rows = df.collect()
    return df._jdf.queryExecution().executedPlan().toString().count("skew=true"), rows


def spread(spark, n=N, partitions=12):
    return spark.range(0, n, 1, partitions)


def hot(value, other):
    return F.when(F.col("id") % 3 == 0, F.lit(value)).otherwise(other)


def name(prefix):
    return F.concat(F.lit(prefix), F.col("id").cast("string"))


def filled(df, schema):
    have = set(df.columns)
    return df.select(*[
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema
    ])


def cohort(spark):
    return spread(spark).select(
        name("P").alias("pmi_id"),
        hot("Test", name("F")).alias("first_name"),
        hot("Patient", name("L")).alias("last_name"),
        F.lit(date(1980, 5, 1)).alias("birth_date"),
        F.lit("555").alias("phone"),
        F.lit(None).cast("string").alias("email"),
        F.sha2(name("a"), 256).alias("address"),
    )


def person(spark, copies=False):
    """Persons with the cohort's names; the hot name belongs to person 0 alone unless ``copies``."""
    df = spread(spark).where("id = 0 or id % 3 <> 0") if not copies else spread(spark)
    return filled(
        df.select(
            F.col("id").alias("master_id"),
            hot("Test", name("F")).alias("first_name"),
            hot("Patient", name("L")).alias("surname"),
            F.lit(date(1980, 5, 1)).alias("birth_date"),
        ),
        schemas.PHI_PERSON,
    )


def test_many_participants_of_one_name(spark, low_thresholds):
    telecom = spread(spark, 1000).select(
        F.col("id").alias("master_id"), F.lit("555").alias("value"), F.lit(C.telecom_home).alias("use_concept_id")
    )
    keys = registry.contact_keys(telecom)
    first = linkage.exact_name_match(cohort(spark), person(spark), keys)
    n_split, got = split_joins(first)
    assert n_split >= 2
    assert len(got) == N
    assert sum(r.phone_match for r in got) == N // 3 + sum(1 for i in range(1000) if i % 3)


def test_status_of_a_hot_name(spark, low_thresholds):
    n_split, got = split_joins(linkage.match_status(cohort(spark), person(spark, copies=True)))
    assert n_split >= 1
    assert sum(r.status == "several" for r in got) == N // 3
    assert sum(r.status == "one" for r in got) == N - N // 3


def test_block_members_of_a_hot_name(spark, low_thresholds):
    n_split, got = split_joins(linkage.exact_name_blocks(cohort(spark), person(spark, copies=True)))
    assert n_split >= 2
    # every shared name is listed, member by member, the hot one with all its rows
    hot = Counter(r.k_first for r in got).most_common(1)[0][1]
    assert len(got) == 2 * N and hot == 2 * (N // 3)


def roster_rows(spark, key, schema, offset=0):
    return filled(
        spread(spark).select(
            key.alias("study_id"),
            F.concat(F.lit("m"), (F.col("id") + offset).cast("string")).alias("mrn"),
            F.lit("Ann").alias("first_name"),
            F.lit("Lee").alias("last_name"),
            F.sha2(name("c"), 256).alias("city"),
        ),
        schema,
    )


@pytest.mark.parametrize("hot_key", ["7", None])
def test_sync_of_a_roster_with_one_hot_key(spark, low_thresholds, hot_key):
    master = roster_rows(spark, hot(hot_key, F.col("id").cast("string")), schemas.ROSTER_MASTER)
    staging = roster_rows(spark, F.col("id").cast("string"), schemas.ROSTER_STAGING, offset=N)
    merged = roster.sync(master, staging, datetime(2018, 5, 14))
    n_split, got = split_joins(merged.snapshot.select("study_id", "mrn", "source"))
    assert n_split >= 1
    third = N // 3
    if hot_key is None:
        assert len(got) == N
    else:
        # Source row 7 updates its third of the master and its own row.
        assert len(got) == N + third
        assert sum(r.mrn == f"m{N + 7}" for r in got) == third + 1


def test_repeated_key_holding_a_third(spark, low_thresholds):
    staging = roster_rows(spark, F.col("id").cast("string"), schemas.ROSTER_STAGING).withColumn(
        "mrn", F.when(F.col("study_id").cast("int") % 3 == 0, "hot").otherwise(F.col("mrn"))
    )
    df = roster.duplicate_keys(staging, "mrn")
    n_split, got = split_joins(df.select("study_id"))
    assert n_split >= 1
    assert len(got) == N // 3


def test_person_with_a_third_of_all_contact_points(spark, low_thresholds):
    telecom = spread(spark).select(
        hot(1, F.col("id")).cast("bigint").alias("master_id"),
        F.sha2(name("v"), 256).alias("value"),
        F.lit(C.telecom_home).alias("use_concept_id"),
    )
    got = registry.contact_rows(telecom).collect()
    assert len(got) == N
    assert sum(r.master_id == 1 for r in got) >= N // 3


def test_person_with_a_third_of_all_clinical_rows(spark, low_thresholds):
    facts = filled(
        spread(spark).select(
            F.col("id").alias("condition_occurrence_id"), hot(1, F.col("id")).cast("bigint").alias("person_id")
        ),
        schemas.CONDITION_OCCURRENCE,
    )
    walk = spread(spark).select(F.col("id").alias("local_person_id"), (F.col("id") + 7).alias("participant_id"))
    n_split, got = split_joins(exports.cdm_condition(facts, walk))
    assert n_split >= 1
    assert len(got) == N
