from datetime import date

import pytest
from pyspark.sql import functions as F

from cohortlink import schemas
from cohortlink.config import Concepts
from cohortlink.operators import registry, vocabulary

from .conftest import rows

C = Concepts()
FROM, TO = date(1970, 1, 1), date(2099, 12, 31)


def identifiers(spark, *items):
    """Registry rows from (master_id, source_id, identifier, type, use)."""
    return spark.createDataFrame(
        [(0, m, s, use, "u", use, i, kind, "t", kind, "sys", FROM, TO, "a") for m, s, i, kind, use in items],
        schemas.PHI_IDENTIFIER,
    )


def telecom(spark, *items):
    return spark.createDataFrame(list(items), schemas.PHI_TELECOM)


def test_contact_keys_are_distinct_and_not_blank(spark):
    tel = telecom(
        spark,
        (1, "(1) 2", C.telecom_home),
        (1, "12", C.telecom_work),
        (1, "A@x ", C.telecom_email),
        (1, "a@X", C.telecom_email),
        (1, " ", C.telecom_email),
        (1, "99", 2000000404),
        (None, "5", C.telecom_home),
    )
    loc = telecom(spark, (1, "1 A St", C.postal_address), (1, "2 B St", 2000000503))
    assert rows(registry.contact_keys(tel, loc)) == [
        (1, "address", "1 a st"),
        (1, "email", "a@x"),
        (1, "phone", "12"),
    ]


def test_person_wide_has_one_row_per_contact(spark):
    person = spark.createDataFrame(
        [(m, f"m{m}", "A", None, "B", None, None, None, None, None) for m in (1, 2, 3)], schemas.PHI_PERSON
    )
    many = [(1, f"{i:04d}", C.telecom_home) for i in range(1500)]
    tel = telecom(spark, *many, *many, (2, "b", C.telecom_home), (2, "a", C.telecom_home), (2, "e", C.telecom_email))
    loc = telecom(spark, (2, "addr", C.postal_address))
    wide = registry.person_wide(person, tel, loc)
    assert rows(wide.where("master_id = 1"), "slot", "value") == [("home_phone", f"{i:04d}") for i in range(1500)]
    assert rows(wide.where("master_id = 2"), "slot", "value") == [
        ("address", "addr"), ("email", "e"), ("home_phone", "a"), ("home_phone", "b")
    ]
    assert rows(wide.where("master_id = 3"), "slot", "value") == [(None, None)]


def test_unmapped_is_decided_per_person(spark):
    person = spark.createDataFrame([(1,), (2,)], "master_id bigint")
    ids = identifiers(spark, (1, 1, "P1", C.id_type_participant, 0), (2, 1, "x", C.id_type_mrn, 0),
                      (None, 1, "P9", C.id_type_participant, 0))
    assert rows(registry.unmapped(person, ids)) == [(2,)]


def test_crosswalk_keeps_each_pair(spark):
    ids = identifiers(
        spark,
        (1, 1, "10", C.id_type_local_person, 0),
        (1, 1, "P1", C.id_type_participant, 0),
        (1, 1, "P2", C.id_type_participant, 0),
        (2, 1, "20", C.id_type_local_person, 0),
        (None, 1, "30", C.id_type_local_person, 0),
        (None, 1, "P3", C.id_type_participant, 0),
    )
    got = registry.crosswalk(ids, C.id_type_local_person, C.id_type_participant)
    assert rows(got) == [("10", 1, "P1"), ("10", 1, "P2")]


def test_register_identifiers(spark):
    concept = vocabulary.seed_concepts(spark)
    ids = identifiers(
        spark,
        (1, 71, "m1", C.id_type_mrn, C.id_use_ehr_mrn),
        (1, 72, "m2", C.id_type_mrn, C.id_use_ehr_mrn),
        (1, 72, "m3", C.id_type_mrn, C.id_use_ehr_mrn),
        (2, 73, "m4", C.id_type_mrn, C.id_use_ehr_mrn),
        (9, 74, "p2", C.id_type_participant, C.id_use_participant),
        (3, 75, "m5", C.id_type_mrn, 2000000714),
    )
    accepted = spark.createDataFrame(
        [("P1", 1), ("P1", 1), ("P2", 2), ("P3", 3)], "pmi_id string, master_id bigint"
    )
    new = registry.register_identifiers(accepted, ids, concept)
    assert new.schema.names == schemas.PHI_IDENTIFIER.names
    assert rows(new) == [
        (0, 1, s, 2000000704, "All of Us", 2000000704, "P1", 2000000813, "PMI_ID", 2000000813, "HealthPro", FROM, TO,
         "HealthPro")
        for s in (71, 72)
    ]
    assert registry.register_identifiers(accepted, ids.unionByName(new), concept).count() == 0


def links(spark, *items):
    return spark.createDataFrame(list(items), "study_id string, master_id bigint, source_id bigint")


def test_merge_study_ids(spark):
    ids = identifiers(
        spark,
        (None, None, "1", C.id_type_study, C.id_use_study),
        (5, 75, "2", C.id_type_study, C.id_use_study),
        (None, None, "3", C.id_type_study, C.id_use_study),
        (1, 71, "1", C.id_type_mrn, C.id_use_ehr_mrn),
    )
    link = links(spark, ("1", 10, 100), ("1", 10, 100), ("2", 20, 200), ("4", None, None), ("6", 60, 600))
    merged = registry.merge_study_ids(ids, link)
    assert rows(merged, "identifier", "id_type_concept_id", "master_id", "source_id") == [
        ("1", C.id_type_mrn, 1, 71),
        ("1", C.id_type_study, 10, 100),
        ("2", C.id_type_study, 5, 75),
        ("3", C.id_type_study, None, None),
        ("4", C.id_type_study, None, None),
        ("6", C.id_type_study, 60, 600),
    ]
    inserted = merged.where("identifier = '6'").first()
    assert inserted[3:6] == (2000000720, "Redcap Study ID", 2000000720)
    assert inserted[7:] == (2000000814, "Redcap Study ID", 2000000814, "UCSD Redcap", FROM, TO, "UCSD Redcap")
    again = registry.merge_study_ids(merged, link)
    assert rows(again) == rows(merged)


def test_merge_study_ids_raises_only_if_two_links_would_update_one_row(spark):
    two = links(spark, ("1", 10, 100), ("1", 11, 110))
    empty = identifiers(spark, (None, None, "1", C.id_type_study, C.id_use_study))
    with pytest.raises(Exception, match="more than one source row"):
        registry.merge_study_ids(empty, two).collect()
    taken = identifiers(spark, (5, 75, "1", C.id_type_study, C.id_use_study))
    assert rows(registry.merge_study_ids(taken, two), "master_id") == [(5,)]
    absent = identifiers(spark, (5, 75, "2", C.id_type_study, C.id_use_study))
    assert rows(registry.merge_study_ids(absent, two), "identifier", "master_id") == [("1", 10), ("1", 11), ("2", 5)]


def test_find(spark):
    ids = identifiers(spark, *[(i, i, str(i), C.id_type_study, 0) for i in range(9)], (1, 1, "1", C.id_type_mrn, 0))
    assert rows(registry.find(ids, C.id_type_study, ["1", "3", "x"]), "master_id") == [(1,), (3,)]
    wanted = spark.range(3).select(F.col("id").cast("string"))
    assert rows(registry.find(ids, C.id_type_study, wanted), "master_id") == [(0,), (1,), (2,)]
    assert rows(registry.find(ids, C.id_type_study, wanted, limit=2), "master_id") == [(0,), (1,)]
