"""Reconciliation counts from key presence, against plain counting."""

from collections import Counter
from datetime import datetime

from cohortlink import schemas
from cohortlink.operators import quality, roster

from .conftest import rows

LINKS = "study_id string, mrn string, master_id bigint, source_id bigint"


def filled(spark, schema, *given):
    return spark.createDataFrame([tuple(g.get(n) for n in schema.names) for g in given], schema)


def tables(spark):
    staging = filled(spark, schemas.ROSTER_STAGING, *({"study_id": x} for x in ("1", "2 ", "2", "x", None, None)))
    master = filled(
        spark, schemas.ROSTER_MASTER,
        {"study_id": "1", "mrn": "m"}, {"study_id": "2"}, {"study_id": "X ", "mrn": ""}, {"study_id": "9"}, {"mrn": "n"},
    )
    study = {"id_type_concept_id": 2000000814}
    identifier = filled(
        spark, schemas.PHI_IDENTIFIER,
        {"identifier": "1", **study}, {"identifier": "9 ", **study}, {"identifier": "2", "id_type_concept_id": 1}, study,
    )
    return staging, master, identifier


def test_key_presence(spark):
    staging, master, identifier = tables(spark)
    got = quality.key_presence(master, staging, identifier)
    assert rows(got, "study_key", "held", "n_staging", "n_master", "n_registry", "n_master_with_mrn") == [
        (None, 0, 2, 1, 1, 1), ("1", 7, 1, 1, 1, 1), ("2", 3, 2, 1, 0, 0), ("9", 6, 0, 1, 1, 0), ("x", 3, 1, 1, 0, 1),
    ]


def test_reconcile_counts(spark):
    staging, master, identifier = tables(spark)
    data = [("1", "M", 1, 1), ("2", "m ", 1, 1), ("3", "n", None, None), ("4", None, 2, 2), ("5", None, None, None)]
    links = spark.createDataFrame(data, LINKS)
    got = dict(quality.reconcile(master, staging, identifier, links).collect())
    assert got == {
        "staging_rows": 6, "master_rows": 5, "master_rows_with_mrn": 3,
        "staging_ids_missing_from_master": quality.missing_from_master(staging, master).count(),
        "master_ids_missing_from_registry": quality.unregistered(master, identifier).count(),
        "link_rows": 5, "link_rows_with_mrn": 3, "link_rows_with_person": 3,
        "link_rows_unmatched": quality.unmatched_links(links).count(),
        "persons_linked_repeatedly": 1, "mrns_linked_repeatedly": 1,
    }
    assert rows(quality.repeated_links(links), "kind", "link_key", "n_rows") == [("mrn", "m", 2), ("person", "1", 2)]


def test_reconcile_of_nothing(spark):
    empty = [filled(spark, s) for s in (schemas.ROSTER_MASTER, schemas.ROSTER_STAGING, schemas.PHI_IDENTIFIER)]
    got = quality.reconcile(*empty, spark.createDataFrame([], LINKS))
    assert Counter(r.value for r in got.collect()) == {0: 11}


def test_candidates_show_the_contact_values_that_agree(spark):
    master = filled(
        spark, schemas.ROSTER_MASTER,
        {"study_id": "1", "first_name": "Ann", "last_name": "Lee", "phone_number": "(858) 555", "email_address": "A@x"},
        {"study_id": "2", "first_name": "Bob", "last_name": "Ray", "phone_number": "1"},
    )
    person = filled(spark, schemas.PHI_PERSON, *({"master_id": k, "first_name": "ann", "surname": "LEE "} for k in (1, 2)))
    telecom = spark.createDataFrame(
        [(1, "858-555", 2000000400), (1, "858 555", 2000000400), (1, "858555", 2000000401), (1, "a@x ", 2000000405),
         (2, "859", 2000000400), (2, "A@X", 2000000401)],
        schemas.PHI_TELECOM,
    )
    got = roster.mrn_candidates(master, person, telecom, filled(spark, schemas.PHI_IDENTIFIER))
    shown = "study_id", "master_id", "home_phone", "work_phone", "email", "phone_match", "email_match"
    assert rows(got, *shown) == [
        ("1", 1, "858 555", "858555", "a@x ", 1, 1), ("1", 2, None, None, None, 0, 0), ("2", None, None, None, None, 0, 0),
    ]


def test_soft_deleted_rows(spark):
    staging, master, _ = tables(spark)
    known = staging.dropDuplicates(["study_id"]).where("study_id is not null")
    got = roster.sync(master, known.where("study_id <> '2 '"), datetime(2018, 5, 14), soft_delete=True)
    assert rows(roster.deleted(got.snapshot), "study_id", "mrn") == [(None, "n"), ("9", None)]
    assert rows(got.changes, "action", "deleted_study_id") == [
        ("UPDATE", None), ("UPDATE", "1"), ("UPDATE", "2"), ("UPDATE", "9"), ("UPDATE", "X "),
    ]
