"""Roster jobs on hand-written rows, and record recovery against all name pairs."""

import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from cohortlink import schemas
from cohortlink.config import Concepts
from cohortlink.operators import linkage, quality, registry, roster

from .conftest import rows
from .test_registry import identifiers, telecom

C = Concepts()
D = date(1980, 5, 1)
TS = datetime(2018, 5, 14, 12)


def staging(spark, *items):
    """Roster rows from dicts of the columns that matter."""
    names = schemas.ROSTER_STAGING.names
    return spark.createDataFrame([tuple(i.get(n) for n in names) for i in items], schemas.ROSTER_STAGING)


def master(spark, *items):
    names = schemas.ROSTER_MASTER.names
    return spark.createDataFrame([tuple(i.get(n) for n in names) for i in items], schemas.ROSTER_MASTER)


def row(study_id, **more):
    return {"study_id": study_id, "first_name": "Ann", "last_name": "Lee", "dob": D, **more}


def test_next_study_id(spark):
    df = staging(spark, row("7"), row("12"), row("9"), row("x"), row(None))
    assert roster.next_study_id(df).first()[0] == 13


def test_duplicates(spark):
    df = staging(
        spark,
        row("1", phone_number="1", email_address="a"),
        row("2", phone_number="1", email_address="A ", first_name="ann"),
        row("3", phone_number="9", email_address="z"),
        row("4", first_name="Bob", duplicate_record___yes=1),
        row("4", first_name="Bob", duplicate_record___yes=1),
        row("5", first_name="Bob", phone_number="5"),
        row("6", first_name="Cat"),
        row("7", first_name=None),
        row("8", first_name=None),
        row("9", first_name="Dan", dob=None),
        row("10", first_name="Dan", dob=None),
    )
    # 3 and 5 come in through the wider name and birth date test; 4 once.
    assert rows(roster.duplicates(df), "study_id") == [("1",), ("2",), ("3",), ("4",), ("5",)]


def test_duplicate_keys_ignore_nulls(spark):
    df = staging(spark, row("1", mrn="a"), row("2", mrn="A"), row("3"), row("4"), row("5", mrn="b"))
    assert rows(roster.duplicate_keys(df, "mrn"), "study_id") == [("1",), ("2",)]


def test_sync(spark):
    old = master(
        spark,
        row("1", mrn="m1", pmi_id="P1", source="first", city="Old"),
        row("2", mrn="m2", pmi_id="P2"),
        row(None, mrn="m0"),
    )
    new = staging(
        spark,
        row("1", mrn="n1", pmi_id="Q1", city="New", first_name="Changed", withdrawn___yes=1, withdrawn_date=D),
        row("3", mrn="m3", pmi_id="P3", city="C"),
        row(None, mrn="m9"),
    )
    merged = roster.sync(old, new, TS)
    assert merged.snapshot.schema.names == schemas.ROSTER_MASTER.names
    assert rows(
        merged.snapshot, "study_id", "mrn", "pmi_id", "first_name", "city", "withdrawn___yes", "withdrawn_date",
        "update_date", "source",
    ) == [
        (None, "m9", None, "Ann", None, None, None, TS, "Sync CTRI Redcap"),
        ("1", "n1", "Q1", "Ann", "Old", 1, D, TS, "Sync CTRI Redcap"),
        ("3", "m3", "P3", "Ann", "C", None, None, TS, "Sync CTRI Redcap"),
    ]
    assert rows(merged.changes) == [
        ("DELETE", None, "m0", None, None, None, None),
        ("DELETE", "2", "m2", "P2", None, None, None),
        ("INSERT", None, None, None, None, "m9", None),
        ("INSERT", None, None, None, "3", "m3", "P3"),
        ("UPDATE", "1", "m1", "P1", "1", "n1", "Q1"),
    ]


def test_sync_of_repeated_keys(spark):
    twice = staging(spark, row("1", mrn="a"), row("1", mrn="b"))
    with pytest.raises(Exception, match="more than one source row"):
        roster.sync(master(spark, row("1")), twice, TS).snapshot.collect()
    with pytest.raises(Exception, match="more than one source row"):
        roster.sync(master(spark, row("1")), twice, TS).changes.collect()
    merged = roster.sync(master(spark, row("2")), twice, TS)
    assert rows(merged.snapshot, "study_id", "mrn") == [("1", "a"), ("1", "b")]
    # One source row may update several target rows.
    merged = roster.sync(master(spark, row("1", mrn="x"), row("1", mrn="y")), staging(spark, row("1", mrn="a")), TS)
    assert rows(merged.snapshot, "study_id", "mrn") == [("1", "a"), ("1", "a")]


def test_sync_every_match_logs_an_update_even_if_equal(spark):
    same = row("1", mrn="a", pmi_id="P1")
    changes = roster.sync(master(spark, same), staging(spark, same), TS).changes
    assert rows(changes) == [("UPDATE", "1", "a", "P1", "1", "a", "P1")]


def test_pad_adds_exactly_one_zero(spark):
    df = staging(spark, *[row(str(i), mrn=m) for i, m in enumerate(["1234567", "123456", "12345678", None, "1234567 "])])
    got = dict(roster.pad_mrn(df).select("study_id", "mrn").collect())
    assert got == {"0": "01234567", "1": "0123456", "2": "12345678", "3": None, "4": "01234567 "}


def test_short_mrn_audit(spark):
    df = staging(spark, row("1", mrn="1234567"), row("2", mrn="7654321"), row("3", mrn="12345678"))
    src = spark.createDataFrame([("01234567", "A", "B", D)], schemas.PATIENT_SRC)
    assert rows(roster.short_mrn_audit(df, src), "study_id", "src_mrn") == [("1", "01234567"), ("2", None)]


def person(spark, *items):
    return spark.createDataFrame(
        [(m, None, f, None, s, d, None, None, None, None) for m, f, s, d in items], schemas.PHI_PERSON
    )


def test_mrn_candidates_and_best(spark):
    df = master(
        spark,
        row("1", phone_number="(1) 2", email_address="a@x"),
        row("2", first_name="Nobody"),
        row("3", mrn="has one"),
        row("4", dob=date(1999, 1, 1), phone_number="12", email_address="A@x"),
        row("5", dob=date(1999, 1, 1), phone_number="12"),
    )
    people = person(spark, (1, "Ann", "Lee", D), (2, "ann", "lee ", D), (3, "Ann", "Lee", None))
    tel = telecom(
        spark,
        (1, "1-2", C.telecom_work),
        (2, "12", C.telecom_home),
        (2, "a@x", C.telecom_email),
        (3, "12", C.telecom_home),
    )
    ids = identifiers(
        spark, (2, 72, "m2b", C.id_type_mrn, 0), (2, 73, "m2a", C.id_type_mrn, 0), (1, 71, "m1", C.id_type_mrn, 0)
    )
    got = roster.mrn_candidates(df, people, tel, ids)
    columns = ["study_id", "master_id", "phi_mrn", "dob_match", "phone_match", "email_match", "total_identifiers_matched"]
    assert [r for r in rows(got, *columns) if r[0] in ("1", "2")] == [
        ("1", 1, "m1", 1, 1, 0, 4),
        ("1", 2, "m2a", 1, 1, 1, 5),
        ("1", 2, "m2b", 1, 1, 1, 5),
        ("1", 3, None, 0, 1, 0, 3),
        ("2", None, None, 0, 0, 0, 2),
    ]
    best = roster.best_mrn(df, people, tel, ids)
    assert rows(best, *columns) == [("1", 2, "m2a", 1, 1, 1, 5), ("4", 2, "m2a", 0, 1, 1, 4)]
    fixed = roster.apply_recovered_mrn(df, best)
    assert rows(fixed, "study_id", "mrn") == [("1", "m2a"), ("2", None), ("3", "has one"), ("4", "m2a"), ("5", None)]


@pytest.mark.parametrize("seed", [1, 2, 3, 4])
def test_best_mrn_equals_best_of_all_name_pairs(spark, seed):
    """A third of the rows share one name, and placeholders are shared by many."""
    rng = random.Random(seed)

    def who():
        if rng.random() < 0.34:
            return "Test", "Patient", rng.choice([D, date(1900, 1, 1), None])
        return rng.choice(["Ann", "Bob"]), rng.choice(["Lee", "lee ", None]), rng.choice([D, None])

    def phone():
        return "000" if rng.random() < 0.4 else rng.choice(["1", "(2)", "3", "", None])

    def email():
        return "none@x" if rng.random() < 0.3 else rng.choice(["a@x", "B@x", "c@x", None])

    items = []
    for i in range(60):
        f, s, d = who()
        items.append(row(str(i), first_name=f, last_name=s, dob=d, phone_number=phone(), email_address=email(),
                         mrn="m" if rng.random() < 0.1 else None))
    people = person(spark, *[(i, *who()) for i in range(60)])
    tel = telecom(
        spark,
        *[(rng.randrange(60), phone(), rng.choice([C.telecom_home, C.telecom_work])) for _ in range(90)],
        *[(rng.randrange(60), email(), C.telecom_email) for _ in range(90)],
    )
    ids = identifiers(spark, *[(rng.randrange(60), i, f"m{i}", C.id_type_mrn, 0) for i in range(60)])
    df = master(spark, *items)
    pairs = roster.mrn_candidates(df, people, tel, ids)
    expected = linkage.best_match(
        pairs, "study_id", "total_identifiers_matched", ["master_id", "phi_mrn", "source_id"]
    )
    best = roster.best_mrn(df, people, tel, ids)
    assert best.count() > 5
    assert rows(best) == rows(expected.select(*best.columns))


def test_links_by_mrn(spark):
    df = master(
        spark,
        row("1", mrn="123"),
        row("2", mrn="0123"),
        row("3", mrn="999"),
        row("4"),
        row("5", mrn="123", last_name=None),
    )
    ids = identifiers(
        spark, (1, 71, "0123", C.id_type_mrn, 0), (2, 72, "123", C.id_type_mrn, 0), (3, 73, "999", C.id_type_study, 0)
    )
    links = roster.study_links(df, ids)
    assert rows(links) == [
        ("1", "123", 1, 71),
        ("1", "123", 2, 72),
        ("2", "0123", 1, 71),
        ("3", "999", None, None),
        ("4", None, None, None),
    ]
    people = person(spark, (1, "Ann", "Lee", D))
    tel = telecom(spark, (1, "8", C.telecom_home), (1, "7", C.telecom_home), (1, "a@x", C.telecom_email))
    wide = roster.link_by_mrn(df, ids, people, tel).where("study_id = '2'").collect()
    assert sorted((r.master_id, r.phi_mrn, r.mrn_first_name, r.slot, r.value) for r in wide) == [
        (1, "0123", "Ann", "email", "a@x"), (1, "0123", "Ann", "home_phone", "7"), (1, "0123", "Ann", "home_phone", "8")
    ]
    counts = dict(quality.reconcile(df, df.select(*schemas.ROSTER_STAGING.names), ids, links).collect())
    assert counts == {
        "staging_rows": 5,
        "master_rows": 5,
        "master_rows_with_mrn": 4,
        "link_rows": 5,
        "link_rows_with_mrn": 4,
        "link_rows_with_person": 3,
        "link_rows_unmatched": 1,
        "staging_ids_missing_from_master": 0,
        "master_ids_missing_from_registry": 5,
        "persons_linked_repeatedly": 1,
        "mrns_linked_repeatedly": 1,
    }


def test_a_record_number_shared_by_many_links_all_of_them(spark):
    n = 1001
    df = master(spark, *[row(str(i), mrn="0") for i in range(n)], row("x", mrn="7"), row("y"))
    ids = identifiers(spark, *[(i, i, "0", C.id_type_mrn, 0) for i in range(n)], (-1, 99, "7", C.id_type_mrn, 0))
    links = roster.study_links(df, ids)
    assert links.count() == n * n + 2
    assert rows(links.where("mrn is null or mrn = '7'")) == [("x", "7", -1, 99), ("y", None, None, None)]
    members = roster.mrn_link_blocks(df, ids)
    assert members.count() == 2 * n + 2 and set(rows(members, "k_mrn")) == {("0",), ("7",)}
    empty = identifiers(spark, (1, 1, "z", C.id_type_mrn, 0)).where("false")
    merged = registry.merge_study_ids(empty, links)
    assert merged.where(F.col("identifier").isin("x", "y")).count() == 2
    assert merged.select("identifier").distinct().count() == n + 2


def test_a_name_shared_by_many_has_all_candidates(spark):
    n = 1001
    df = master(spark, *[row(str(i), mrn=None) for i in range(n)])
    first, last = df.select("first_name", "last_name").first()
    people = person(spark, *[(i, first, last, D) for i in range(n)])
    found = roster.mrn_candidates(df, people, telecom(spark, (0, "1", C.telecom_home)), identifiers(spark, (0, 0, "5", C.id_type_mrn, 0)))
    assert found.count() == n * n
