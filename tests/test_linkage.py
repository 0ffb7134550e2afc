"""Linkage on hand-written rows, and against brute force on skewed random rows."""

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from cohortlink import schemas
from cohortlink.config import Concepts
from cohortlink.operators import linkage, registry

from .conftest import rows

C = Concepts()
D = date(1980, 5, 1)
COHORT = "pmi_id string, first_name string, last_name string, birth_date date, email string, phone string, address string"


def people(spark, *items):
    return spark.createDataFrame(
        [(m, None, f, None, s, d, None, None, None, None) for m, f, s, d in items], schemas.PHI_PERSON
    )


def contacts(spark, *items):
    telecom = [(m, v, u) for m, v, u in items if u != C.postal_address]
    location = [(m, v, u) for m, v, u in items if u == C.postal_address]
    return registry.contact_keys(
        spark.createDataFrame(telecom, schemas.PHI_TELECOM),
        spark.createDataFrame(location, schemas.PHI_LOCATION),
    )


def run(cohort, person, keys):
    status = linkage.match_status(cohort, person)
    first = linkage.exact_name_match(cohort, person, keys)
    return first, linkage.decide(first, status), linkage.partial_name_match(cohort, person, keys)


def test_score_and_decisions(spark):
    cohort = spark.createDataFrame(
        [
            ("P1", "Ann ", "Lee", D, "ANN@X", "(1) 2-3", "1 A St"),
            ("P2", "Bob", "Ray", D, "bob@x", "9", "2 B St"),
            ("P3", "Cat", "Fox", D, "", "", ""),
            ("P4", "Dan", "Else", D, None, "77", None),
            ("P5", "Eve", "None", None, None, None, None),
            (None, "Ann", "Lee", D, None, None, None),
        ],
        COHORT,
    )
    person = people(
        spark,
        (1, "ann", "LEE", D),
        (2, "Bob", "Ray", D),
        (3, "Bob", "Ray", D),
        (4, "Cat", "Fox", D),
        (5, "Dan", "Orr", D),
        (6, "Dan", "Elseq", date(1980, 5, 2)),
        (7, "Eve", "None", None),
    )
    keys = contacts(
        spark,
        (1, "123", C.telecom_work),
        (1, "ann@x", C.telecom_email),
        (1, "1 a st", C.postal_address),
        (2, "bob@x", C.telecom_email),
        (4, "", C.telecom_home),
        (4, "", C.telecom_email),
        (5, "77", C.telecom_home),
        (5, "7-7", C.telecom_home),
    )
    first, decided, second = run(cohort, person, keys)
    flags = ["phone_match", "email_match", "address_match", "count_identifiers_matched", "decision"]
    assert rows(decided, "pmi_id", "master_id", *flags) == [
        ("P1", 1, 1, 1, 1, 6, "accepted"),
        ("P2", 2, 0, 1, 0, 4, "ambiguous"),
        ("P2", 3, 0, 0, 0, 3, "ambiguous"),
        ("P3", 4, 0, 0, 0, 3, "low_score"),
    ]
    assert rows(linkage.accepted(decided), "pmi_id") == [("P1",)]
    assert rows(linkage.ambiguous(decided), "master_id") == [(2,), (3,)]
    assert rows(linkage.low_score(first), "master_id") == [(3,), (4,)]
    assert rows(
        second, "pmi_id", "master_id", "first_name_match", "last_name_match",
        "count_identifiers_matched", "score_reference",
    ) == [("P4", 5, 1, 0, 3, 4)]
    review = linkage.review_queue(decided, second)
    assert [(r.pmi_id, r.master_id, r.reason) for r in review.collect()] == [
        ("P2", 2, "ambiguous"),
        ("P2", 3, "ambiguous"),
        ("P3", 4, "low_score"),
        ("P4", 5, "partial_name"),
    ]
    only_contact = linkage.partial_name_match(cohort, person, keys, require_contact=True)
    assert rows(only_contact, "pmi_id") == [("P4",)]


def test_null_name_still_matches_on_the_other(spark):
    cohort = spark.createDataFrame([("P1", None, "Lee", D, None, None, None)], COHORT)
    person = people(spark, (1, "Ann", "Lee", D), (2, None, "Lee", D), (3, None, None, D))
    _, decided, second = run(cohort, person, contacts(spark))
    assert decided.count() == 0
    assert rows(second, "master_id", "first_name_match", "last_name_match") == [(1, 0, 1), (2, 0, 1)]


def random_sides(seed, n=60):
    """A third of each side shares one name and birth date."""
    rng = random.Random(seed)

    def who():
        if rng.random() < 0.34:
            return "Test", "Patient", D
        return (
            rng.choice(["Ann", "Bob", None, "ann "]),
            rng.choice(["Lee", "Ray", "lee"]),
            rng.choice([D, date(1980, 5, 2), None]),
        )

    def contact():
        return rng.choice(["1", "2", "(1)", "", None])

    cohort = [(f"P{i % 50}", *who(), contact(), contact(), contact()) for i in range(n)]
    person = [(i, *who()) for i in range(n)]
    uses = [C.telecom_home, C.telecom_work, C.telecom_email, C.postal_address]
    points = [(rng.randrange(n), contact(), rng.choice(uses)) for _ in range(2 * n)]
    return cohort, person, points


def key(x):
    return None if x is None else x.rstrip(" ").lower()


def digits(x):
    return None if x is None else (key("".join(ch for ch in x if ch not in "() -")) or None)


def brute(cohort, person, points):
    """All pairs by definition: (pmi_id, cohort row, master_id) -> flags."""
    held = {"phone": set(), "email": set(), "address": set()}
    for m, v, use in points:
        if use in (C.telecom_home, C.telecom_work):
            held["phone"].add((m, digits(v)))
        elif use == C.telecom_email:
            held["email"].add((m, key(v)))
        else:
            held["address"].add((m, key(v)))
    out = set()
    for p, f, s, d, email, phone, address in cohort:
        for m, pf, ps, pd in person:
            same_f = int(f is not None and key(f) == key(pf))
            same_s = int(s is not None and key(s) == key(ps))
            if d is None or d != pd or not (same_f or same_s):
                continue
            contact = tuple(
                int(bool(v) and (m, v) in held[kind])
                for kind, v in (("phone", digits(phone)), ("email", key(email)), ("address", key(address)))
            )
            out.add((p, m, f, s, email, phone, address, same_f, same_s, *contact))
    return out


@pytest.mark.parametrize("seed", [1, 2, 3, 4])
def test_against_brute_force(spark, seed):
    cohort, person, points = random_sides(seed)
    expected = brute(cohort, person, points)
    c, p, k = spark.createDataFrame(cohort, COHORT), people(spark, *person), contacts(spark, *points)
    first, decided, second = run(c, p, k)
    columns = [
        "pmi_id", "master_id", "first_name", "last_name", "email", "phone", "address",
        "first_name_match", "last_name_match", "phone_match", "email_match", "address_match",
    ]
    exact = {r for r in expected if r[7] and r[8]}
    assert rows(first, *columns) == sorted(exact, key=lambda t: [(v is not None, v) for v in t])
    in_first = {r[0] for r in exact}
    partial = {r for r in expected if r[0] not in in_first}
    assert rows(second, *columns) == sorted(partial, key=lambda t: [(v is not None, v) for v in t])

    persons_of = {}
    for r in exact:
        persons_of.setdefault(r[0], set()).add(r[1])
    several = {p for p, ms in persons_of.items() if len(ms) > 1}
    accepted = {(r[0], r[1]) for r in exact if r[0] not in several and 3 + sum(r[9:]) >= 4}
    assert set(rows(linkage.accepted(decided), "pmi_id", "master_id")) == accepted
    # the way without pairs comes to the same decisions
    status = linkage.match_status(c, p)
    sole = linkage.decide_sole(linkage.sole_candidates(c, p, k, status))
    rivals = linkage.decide_rivals(linkage.rival_candidates(c, p, k, status))
    assert rows(sole.unionByName(rivals)) == rows(decided.select(*sole.columns))
    assert {r[0] for r in rows(linkage.ambiguous(decided), "pmi_id")} == several


def test_block_members_cover_the_same_pairs(spark):
    cohort, person, points = random_sides(7)
    expected = brute(cohort, person, points)
    c, p, k = spark.createDataFrame(cohort, COHORT), people(spark, *person), contacts(spark, *points)

    def covered(members, keys):
        got, blocks = set(), {}
        for r in members.collect():
            left, right = blocks.setdefault(tuple(r[k] for k in keys), (set(), set()))
            (left if r.pmi_id is not None else right).add(r.pmi_id if r.pmi_id is not None else r.master_id)
        for left, right in blocks.values():
            assert min(len(left), len(right)) > 0
            got |= {(a, b) for a in left for b in right}
        return got

    exact = {(r[0], r[1]) for r in expected if r[7] and r[8]}
    assert covered(linkage.exact_name_blocks(c, p), linkage.NAME_KEYS) == exact
    in_first = {a for a, _ in exact}
    second = {(r[0], r[1]) for r in expected if r[0] not in in_first}
    assert set(rows(linkage.partial_name_match(c, p, k), "pmi_id", "master_id")) == second
    assert covered(linkage.partial_name_blocks(c, p), linkage.ONE_NAME_KEYS) == second


def crowd(spark, n, first="Test"):
    """As many participants and persons of one name and birth date."""
    cohort = spark.range(n).select(
        F.concat(F.lit("P"), "id").alias("pmi_id"), F.lit(first).alias("first_name"), F.lit("Patient").alias("last_name"),
        F.lit(D).alias("birth_date"), F.lit(None).cast("string").alias("email"), F.lit("1").alias("phone"),
        F.lit(None).cast("string").alias("address"),
    )
    person = spark.range(n).select(
        F.col("id").alias("master_id"), F.lit("Test").alias("first_name"), F.lit("Patient").alias("surname"),
        F.lit(D).alias("birth_date"),
    )
    return cohort, person


@pytest.mark.parametrize("n", [300, 1001])
def test_a_large_block_is_complete_and_never_accepted(spark, n):
    cohort, person = crowd(spark, n)
    keys = contacts(spark, (0, "1", C.telecom_home))
    first = linkage.exact_name_match(cohort, person, keys)
    assert first.count() == n * n
    assert linkage.exact_name_blocks(cohort, person).count() == 2 * n
    status = linkage.match_status(cohort, person)
    assert rows(status.groupBy("status").count()) == [("several", n)]
    assert linkage.accepted(linkage.decide(first, status)).count() == 0
    other, _ = crowd(spark, n, "Other")
    assert linkage.partial_name_match(other, person, keys).count() == n * n


def test_best_match_breaks_ties_by_lowest_person(spark):
    df = spark.createDataFrame(
        [("s1", 9, 4), ("s1", 3, 4), ("s1", 1, 3), ("s2", 5, 5), ("s2", 2, 4), ("s3", 1, 3)],
        "study_id string, master_id bigint, score int",
    )
    assert rows(linkage.best_match(df, "study_id", "score", ["master_id"])) == [("s1", 3, 4), ("s2", 5, 5)]
