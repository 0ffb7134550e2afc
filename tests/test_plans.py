"""The three jobs end to end on the smallest tables, and what must hold after them."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from checks.views import Inputs
from cohortlink import schemas
from cohortlink.functions.text import number_without_p
from cohortlink.operators import linkage, roster, vocabulary
from cohortlink.plans.participant_mapping import map_participants
from cohortlink.plans.roster_sync import sync_roster
from cohortlink.plans.stages import Run, shared_folder
from cohortlink.plans.submission import write_submission

from .conftest import rows

DIRECTORY = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def v(spark):
    return Inputs(spark, DIRECTORY)


@pytest.fixture(scope="module")
def run(spark):
    with Run(spark) as run:
        yield run


def test_map_participants(spark, v, run):
    got = map_participants(
        run, v.workqueue, v.phi_person, v.phi_telecom, v.phi_location, v.phi_identifier,
        vocabulary.seed(v.concept, vocabulary.seed_concepts(spark)),
    )
    accepted = rows(got.accepted, "pmi_id", "master_id")
    review = {r[0] for r in rows(got.review, "pmi_id")}
    assert accepted and review
    assert len({p for p, _ in accepted}) == len(accepted)
    assert not {p for p, _ in accepted} & review
    low = {r[0] for r in rows(got.low_score, "pmi_id")}
    members = {r[0] for r in rows(got.review_blocks.where("pmi_id is not null"), "pmi_id")}
    assert members | low == review
    new = got.new_identifiers
    assert set(rows(new, "identifier", "master_id")) <= set(accepted)
    # Once registered, the persons are mapped and the job has nothing to add.
    registry_after = v.phi_identifier.unionByName(new)
    again = map_participants(
        run, v.workqueue, v.phi_person, v.phi_telecom, v.phi_location, registry_after,
        vocabulary.seed_concepts(spark),
    )
    assert again.new_identifiers.count() == 0


def test_acceptance_makes_no_pairs(spark, run):
    """Of 1,001 participants and 1,001 persons of one name not one pair is made; one clear match is accepted."""
    n = 1001
    queue = spark.range(n + 1).select(
        F.concat(F.lit("P"), F.col("id").cast("string")).alias("pmi_id"),
        F.lit("Ann").alias("first_name"),
        F.when(F.col("id") == n, "Sole").otherwise("Lee").alias("last_name"),
        F.lit("1980-05-01").cast("date").alias("birth_date"),
        F.lit("a@x").alias("email"),
        *[F.lit("").alias(c) for c in ("phone", "street_address", "city", "state", "zip")],
        F.lit("home_clinic").alias("physical_measurements_location"),
        F.lit("").alias("biospecimens_location"),
    )
    person = spark.range(n + 1).select(
        F.col("id").alias("master_id"),
        F.lit("ANN").alias("first_name"),
        F.when(F.col("id") == n, "Sole ").otherwise("lee").alias("surname"),
        F.lit("1980-05-01").cast("date").alias("birth_date"),
    )
    telecom = spark.createDataFrame([(n, "A@x ", 2000000405)], schemas.PHI_TELECOM)
    nothing = spark.createDataFrame([], schemas.PHI_IDENTIFIER)
    location = spark.createDataFrame([], schemas.PHI_LOCATION)
    got = map_participants(run, queue, person, telecom, location, nothing, vocabulary.seed_concepts(spark))
    assert rows(got.accepted, "pmi_id", "master_id") == [(f"P{n}", n)]
    status = linkage.match_status(got.cohort, person)
    keys = spark.createDataFrame([], "master_id bigint, kind string, value_key string")
    assert linkage.sole_candidates(got.cohort, person, keys, status).count() == 1
    assert got.low_score.count() == 0
    assert got.review_blocks.where("k_first is not null").count() == 2 * n


def test_sync_roster(spark, v, run):
    got = sync_roster(
        run, v.roster_master, v.roster_staging, v.phi_person, v.phi_telecom, v.phi_identifier,
        datetime(2018, 5, 14),
    )
    assert rows(got.roster, "study_id") == rows(v.roster_staging, "study_id")
    actions = dict(got.changes.groupBy("action").count().collect())
    assert actions["INSERT"] + actions["UPDATE"] == v.roster_staging.count()
    assert got.recovered.count() > 0
    missing = lambda df: df.where("mrn is null").count()
    assert missing(got.roster) == missing(v.roster_staging) - got.recovered.where("phi_mrn is not null").count()
    checks = dict(got.checks.collect())
    assert checks["staging_ids_missing_from_master"] == 0
    named = got.roster.where("first_name is null or last_name is null").count()
    assert checks["master_ids_missing_from_registry"] <= named
    top = roster.next_study_id(got.roster).first()[0]
    assert top > max(int(r[0]) for r in rows(got.roster, "study_id"))
    # A second run with the same input changes no registry row.
    again = sync_roster(
        run, got.roster, v.roster_staging, v.phi_person, v.phi_telecom, got.identifier, datetime(2018, 5, 15)
    )
    assert set(r.action for r in again.changes.collect()) == {"UPDATE"}
    assert again.identifier.count() == got.identifier.count()


def test_write_submission(spark, v, run, tmp_path):
    names = ["phi_person", "phi_telecom", "phi_identifier", *(
        "person visit_occurrence condition_occurrence procedure_occurrence measurement drug_exposure".split()
    )]
    paths = write_submission(run, {n: getattr(v, n) for n in names}, str(tmp_path), "1")
    assert len(paths) == 13
    for name in ("pii_name", "pii_email", "pii_phone_number", "pii_address", "pii_mrn"):
        written = spark.read.parquet(paths[name])
        assert written.schema == getattr(schemas, name.upper())
        assert written.count() > 0
    visits = spark.read.parquet(paths["visit_occurrence"])
    known = v.phi_identifier.select(number_without_p(F.col("identifier")).alias("person_id"))
    assert visits.count() > 0 and visits.join(known, "person_id", "left_anti").count() == 0
    people = spark.read.parquet(paths["person"])
    assert people.count() > 0


def test_block_sizes_show_hot_keys(spark, v):
    sizes = linkage.name_block_sizes(
        spark.createDataFrame([("P1", "A", "B", None, None, None, None)],
                              "pmi_id string, first_name string, last_name string, birth_date date,"
                              " email string, phone string, address string"),
        v.phi_person,
    )
    assert sizes.count() == 0
