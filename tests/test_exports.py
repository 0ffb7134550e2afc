from datetime import date, datetime

from cohortlink import schemas
from cohortlink.config import Concepts
from cohortlink.operators import exports, quality

from .conftest import rows
from .test_registry import identifiers

C = Concepts()


def ids(spark):
    return identifiers(
        spark,
        (1, 1, "10", C.id_type_local_person, 0),
        (1, 1, "P1", C.id_type_participant, 0),
        (2, 1, "20", C.id_type_local_person, 0),
        (2, 1, "P2", C.id_type_participant, 0),
        (2, 1, "P22", C.id_type_participant, 0),
        (3, 1, "thirty", C.id_type_local_person, 0),
        (3, 1, "P3", C.id_type_participant, 0),
        (4, 1, "40", C.id_type_local_person, 0),
        (4, 1, "A1", C.id_type_participant, 0),
        (5, 1, "50", C.id_type_local_person, 0),
    )


def one(spark, schema, **values):
    return spark.createDataFrame([tuple(values.get(n) for n in schema.names)], schema)


def test_pii_name_suffix_and_raw_identifier_grouping(spark):
    person = spark.createDataFrame(
        [
            (1, "m", "A", None, "X", None, "MD", "Hon", "Dr", "S"),
            (4, "m", "A", None, "X", None, None, "Hon", None, "S"),
            (1, "m", "A", None, "X", None, "MD", "Hon", "Dr", "S"),
        ],
        schemas.PHI_PERSON,
    )
    got = exports.pii_name(person, ids(spark))
    assert got.schema.names == schemas.PII_NAME.names
    assert rows(got) == [(1, "A", None, "X", "Hon", None), (1, "A", None, "X", "MD", "Dr")]
    # P1 and A1 publish equal rows; both stay.
    assert rows(exports.pii_mrn(person, ids(spark))) == [(1, "S", "m"), (1, "S", "m")]
    assert rows(quality.shared_numbers(ids(spark))) == [(1, "A1", "P1")]


def test_pii_contact_tables(spark):
    tel = spark.createDataFrame(
        [(1, "a@x", C.telecom_email), (1, "1", C.telecom_home), (1, "1", C.telecom_work), (1, "2", C.telecom_work),
         (1, "3", 2000000404), (9, "z", C.telecom_email)],
        schemas.PHI_TELECOM,
    )
    assert rows(exports.pii_email(tel, ids(spark))) == [(1, "a@x")]
    assert rows(exports.pii_phone(tel, ids(spark))) == [(1, "1"), (1, "2")]


def test_pii_address_goes_over_the_crosswalk(spark):
    person = spark.createDataFrame([(10, 7), (20, None), (30, 8), (40, 9)], "person_id bigint, location_id bigint")
    assert rows(exports.pii_address(person, ids(spark))) == [(1, 7), (1, 9), (2, None), (22, None)]


def test_person_births_and_rejects(spark):
    parts = [(10, 1980, 5, 17), (20, 1980, 5, None), (10, 2001, 2, 30)]
    names = schemas.PERSON.names
    person = spark.createDataFrame(
        [tuple({"person_id": p, "year_of_birth": y, "month_of_birth": m, "day_of_birth": d}.get(n) for n in names)
         for p, y, m, d in parts],
        schemas.PERSON,
    )
    got = exports.cdm_person(person, exports.participant_crosswalk(ids(spark)))
    assert got.schema.names == names[:5] + ["birth_datetime"] + names[5:]
    assert rows(got, "person_id", "birth_datetime") == [(1, None), (1, date(1980, 5, 17)), (2, None), (22, None)]
    assert rows(exports.impossible_births(person)) == [(10, 2001, 2, 30)]


def test_visit_dates_repeat_as_datetimes(spark):
    visit = one(spark, schemas.VISIT_OCCURRENCE, visit_occurrence_id=1, person_id=10,
                visit_start_date=date(2018, 1, 2), visit_end_date=date(2018, 1, 3))
    walk = exports.participant_crosswalk(ids(spark))
    got = exports.cdm_visit(visit, walk)
    assert got.schema.names == [
        "visit_occurrence_id", "person_id", "visit_concept_id", "visit_start_date", "visit_start_datetime",
        "visit_end_date", "visit_end_datetime", "visit_type_concept_id", "provider_id", "care_site_id",
        "visit_source_value", "visit_source_concept_id", "admitting_source_concept_id", "admitting_source_value",
        "discharge_to_concept_id", "discharge_to_source_value", "preceding_visit_occurrence_id",
    ]
    assert got.first()["visit_start_datetime"] == date(2018, 1, 2)
    assert exports.cdm_visit(visit, walk, as_timestamp=True).first()["visit_end_datetime"] == datetime(2018, 1, 3)


def test_fact_tables_columns_and_constants(spark):
    walk = exports.participant_crosswalk(ids(spark))
    cases = [
        (exports.cdm_condition, schemas.CONDITION_OCCURRENCE, ["provider_id"]),
        (exports.cdm_procedure, schemas.PROCEDURE_OCCURRENCE, ["modifier_concept_id", "provider_id"]),
        (exports.cdm_measurement, schemas.MEASUREMENT,
         ["operator_concept_id", "value_as_concept_id", "provider_id"]),
        (exports.cdm_drug, schemas.DRUG_EXPOSURE, ["provider_id"]),
    ]
    for export, schema, added in cases:
        got = export(one(spark, schema, person_id=20), walk)
        assert sorted(got.schema.names) == sorted([*schema.names, *added])
        # Two participant ids on one person publish the row twice.
        assert rows(got, "person_id", *added) == [(2, *[0] * len(added)), (22, *[0] * len(added))]
        assert export(one(spark, schema, person_id=50), walk).count() == 0


def test_rejects_and_fanout(spark):
    extra = ids(spark).unionByName(identifiers(spark, (6, 1, "PP6", C.id_type_participant, 0)))
    assert rows(exports.unreadable_ids(extra), "identifier", "rule") == [
        ("A1", "without_p"),
        ("PP6", "after_first_char"),
        ("thirty", "local_person_id"),
    ]
    assert rows(quality.crosswalk_fanout(extra)) == [(2, 1, 2)]


def test_too_long(spark):
    df = spark.createDataFrame([("x" * 51, "y"), ("x" * 50 + "  ", None)], "mrn string, health_system string")
    assert dict(quality.too_long(df, schemas.PII_LENGTHS["pii_mrn"]).collect()) == {"mrn": 1, "health_system": 0}
