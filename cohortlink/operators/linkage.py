"""Linking participants to registry persons by counting matching identifiers.

Candidates share a birth date and both names (first match) or one name (second
match). Phone, e-mail and address are then tested by an equi-join on person and
value, so no contact list is ever gathered per person.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..config import MIN_SCORE
from ..functions.match import flag
from ..functions.text import contact_key, match_key, phone_key
from .blocks import block_members, block_pairs, block_sizes, skew_join

NAME_KEYS = ["k_first", "k_last", "k_dob"]
ONE_NAME_KEYS = ["k_part", "k_name", "k_dob"]

_IDENTITY = [
    "pmi_id",
    "master_id",
    "first_name",
    "last_name",
    "identity_first_name",
    "identity_last_name",
    "birth_date",
    "identity_birth_date",
    "phone",
    "email",
    "address",
]
_NAME_FLAGS = ["first_name_match", "last_name_match", "dob_match"]
CONTACT_KINDS = ("phone", "email", "address")
CANDIDATE_COLUMNS = [
    *_IDENTITY,
    *_NAME_FLAGS,
    *[f"{k}_match" for k in CONTACT_KINDS],
    "count_identifiers_matched",
    "score_reference",
]


def participants(cohort: DataFrame) -> DataFrame:
    """Distinct cohort rows with their join keys."""
    return cohort.where(F.col("pmi_id").isNotNull()).select(
        "pmi_id",
        "first_name",
        "last_name",
        "birth_date",
        "phone",
        "email",
        "address",
        match_key(F.col("first_name")).alias("k_first"),
        match_key(F.col("last_name")).alias("k_last"),
        F.col("birth_date").alias("k_dob"),
    ).distinct()


def persons(person: DataFrame) -> DataFrame:
    """Registry persons with their join keys."""
    return person.select(
        "master_id",
        F.col("first_name").alias("identity_first_name"),
        F.col("surname").alias("identity_last_name"),
        F.col("birth_date").alias("identity_birth_date"),
        match_key(F.col("first_name")).alias("k_first"),
        match_key(F.col("surname")).alias("k_last"),
        F.col("birth_date").alias("k_dob"),
    )


def reachable(right: DataFrame, left: DataFrame, keys: Sequence[str], broadcast_left: bool) -> DataFrame:
    """Right rows whose key occurs on the left, filtered during the scan by a broadcast of the left keys.

    Without ``broadcast_left`` the rows are returned as they are: filtering by
    shuffle would cost as much as the join to come.
    """
    if not broadcast_left:
        return right
    keys = list(keys)
    return right.join(F.broadcast(left.dropna(subset=keys).select(*keys).distinct()), keys, "left_semi").select(*right.columns)


def _asks(wanted: Mapping[str, Column]) -> Column:
    """The given contact values that are not missing, as an array of (kind, value_key)."""
    asks = F.array(*[
        F.struct(F.lit(kind).alias("kind"), key.alias("value_key")) for kind, key in wanted.items()
    ])
    return F.filter(asks, lambda a: a["value_key"].isNotNull())


def _wanted() -> dict[str, Column]:
    return {
        "phone": phone_key(F.col("phone")),
        "email": contact_key(F.col("email")),
        "address": contact_key(F.col("address")),
    }


def asked_values(rows: DataFrame, wanted: Mapping[str, Column] | None = None) -> DataFrame:
    """All (kind, value_key) that the rows of a cohort will look up."""
    asked = rows.select(F.explode(_asks(_wanted() if wanted is None else wanted)).alias("_ask"))
    return asked.select("_ask.kind", "_ask.value_key")


def contact_matches(pairs: DataFrame, contacts: DataFrame, wanted: Mapping[str, Column]) -> DataFrame:
    """Add to distinct pairs, for each wanted contact value, a column with what the person has: null if nothing.

    ``wanted`` maps a contact kind to the key to look for. Each pair is asked
    once per value it has; ``contacts`` is distinct on (master_id, kind,
    value_key) and has what to show in ``value``, so the lookup adds no rows.
    """
    columns = pairs.columns
    asked = pairs.withColumn("_ask", F.explode_outer(_asks(wanted))).select(
        *columns, "_ask.kind", "_ask.value_key"
    )
    found = skew_join(asked, contacts.withColumnRenamed("value", "_hit"), ["master_id", "kind", "value_key"], "left")
    return found.groupBy(*columns).agg(*[
        F.max(F.when(F.col("kind") == kind, F.col("_hit"))).alias(kind) for kind in wanted
    ])


def contact_flags(pairs: DataFrame, contacts: DataFrame, wanted: Mapping[str, Column]) -> DataFrame:
    """Add a 0/1 ``<kind>_match`` column to distinct pairs for each wanted contact value.

    ``contacts`` is ``registry.contact_keys``.
    """
    names = {kind: f"_{kind}" for kind in wanted}
    prefixed = contacts.withColumns({"kind": F.concat(F.lit("_"), "kind"), "value": F.lit(True)})
    found = contact_matches(pairs, prefixed, {names[k]: key for k, key in wanted.items()})
    return found.select(*pairs.columns, *[flag(F.col(n)).alias(f"{k}_match") for k, n in names.items()])


def _scored(pairs: DataFrame, contacts: DataFrame) -> DataFrame:
    flagged = contact_flags(pairs.select(*_IDENTITY, *_NAME_FLAGS), contacts, _wanted())
    contact_score = sum((F.col(f"{k}_match") for k in CONTACT_KINDS), F.lit(0))
    name_score = sum((F.col(name) for name in _NAME_FLAGS), F.lit(0))
    return flagged.withColumns({
        "count_identifiers_matched": name_score + contact_score,
        # Counts both names and the birth date as matched whatever they are.
        "score_reference": F.lit(3) + contact_score,
    }).select(*CANDIDATE_COLUMNS)


def exact_name_match(
    cohort: DataFrame,
    person: DataFrame,
    contacts: DataFrame,
    broadcast_cohort: bool = False,
) -> DataFrame:
    """Candidates equal in first name, last name and birth date, with their score.

    ``person`` holds the persons still to be linked (``registry.unmapped``),
    ``contacts`` their ``registry.contact_keys``. Set ``broadcast_cohort`` if the cohort has been
    measured small (``plans.stages.fits_broadcast``): persons out of its reach
    are then dropped while they are read.
    """
    left = participants(cohort)
    right = reachable(persons(person), left, NAME_KEYS, broadcast_cohort)
    pairs = block_pairs(left, right, NAME_KEYS, broadcast_left=broadcast_cohort)
    ones = {name: F.lit(1) for name in _NAME_FLAGS}
    return _scored(pairs.withColumns(ones), contacts)


def exact_name_blocks(
    cohort: DataFrame,
    person: DataFrame,
    broadcast_cohort: bool = False,
    status: DataFrame | None = None,
) -> DataFrame:
    """Participants and persons of all shared name and birth date blocks, one row each.

    With ``status`` only the blocks of ambiguous participants are listed: the
    answer for names that many share, without a row per pair.
    """
    left = participants(cohort)
    if status is not None:
        left = _of_status(left, status, "several")
    right = reachable(persons(person), left, NAME_KEYS, broadcast_cohort)
    return block_members(left, right, NAME_KEYS, "pmi_id", "master_id")


def _of_status(left: DataFrame, status: DataFrame, wanted: str) -> DataFrame:
    """Participants of one status, with the columns of ``participants``."""
    chosen = status.where(F.col("status") == wanted).select("k_pmi")
    keyed = left.withColumn("k_pmi", match_key(F.col("pmi_id")))
    return skew_join(keyed, chosen, ["k_pmi"], "left_semi").drop("k_pmi")


def sole_candidates(
    cohort: DataFrame,
    person: DataFrame,
    contacts: DataFrame,
    status: DataFrame,
    broadcast_cohort: bool = False,
) -> DataFrame:
    """Scored candidates of the participants with exactly one candidate person.

    Only these can be accepted. ``match_status`` names the person, so each
    participant meets that person alone: a name that n participants and m
    persons share makes no pairs.
    """
    one = status.where(F.col("status") == "one").select("k_pmi", "master_id")
    keyed = participants(cohort).withColumn("k_pmi", match_key(F.col("pmi_id")))
    left = skew_join(keyed, one, ["k_pmi"], "inner").drop("k_pmi")
    keys = [*NAME_KEYS, "master_id"]
    # the names of the whole cohort are known without a shuffle
    right = reachable(persons(person), participants(cohort), NAME_KEYS, broadcast_cohort)
    pairs = block_pairs(left, right, keys, broadcast_left=broadcast_cohort)
    ones = {name: F.lit(1) for name in _NAME_FLAGS}
    return _scored(pairs.withColumns(ones), contacts)


def rival_candidates(
    cohort: DataFrame,
    person: DataFrame,
    contacts: DataFrame,
    status: DataFrame,
    broadcast_cohort: bool = False,
) -> DataFrame:
    """Scored candidates of the participants with several candidate persons, pair by pair."""
    left = _of_status(participants(cohort), status, "several")
    right = reachable(persons(person), participants(cohort), NAME_KEYS, broadcast_cohort)
    pairs = block_pairs(left, right, NAME_KEYS, broadcast_left=broadcast_cohort)
    ones = {name: F.lit(1) for name in _NAME_FLAGS}
    return _scored(pairs.withColumns(ones), contacts)


def match_status(cohort: DataFrame, person: DataFrame, broadcast_cohort: bool = False) -> DataFrame:
    """Per participant id whether it has no, one or several exact name candidates.

    Persons are reduced to the lowest and highest id per name key before the
    join, so this costs one row per participant whatever the block sizes.
    Columns: ``k_pmi``, ``status`` (none, one, several) and, for one, that
    person's ``master_id``.
    """
    left = participants(cohort)
    per_key = (
        reachable(persons(person), left, NAME_KEYS, broadcast_cohort)
        .dropna(subset=NAME_KEYS)
        .groupBy(*NAME_KEYS)
        .agg(F.min("master_id").alias("lowest"), F.max("master_id").alias("highest"))
    )
    keyed = left.select(match_key(F.col("pmi_id")).alias("k_pmi"), *NAME_KEYS)
    return (
        skew_join(keyed, per_key, NAME_KEYS, "left")
        .groupBy("k_pmi")
        .agg(F.min("lowest").alias("lowest"), F.max("highest").alias("highest"))
        .select(
            "k_pmi",
            F.when(F.col("lowest").isNull(), "none")
            .when(F.col("lowest") == F.col("highest"), "one")
            .otherwise("several")
            .alias("status"),
            F.when(F.col("lowest") == F.col("highest"), F.col("lowest")).alias("master_id"),
        )
    )


def _one_name(side: DataFrame) -> DataFrame:
    """Each row once under its first name and once under its last name."""
    parts = F.array(*[
        F.struct(F.lit(part).alias("k_part"), F.col(key).alias("k_name"))
        for part, key in (("first", "k_first"), ("last", "k_last"))
    ])
    return side.select("*", F.explode(parts).alias("_part")).select(*side.columns, "_part.*")


def _partial_sides(
    cohort: DataFrame, person: DataFrame, status: DataFrame | None, broadcast_cohort: bool
) -> tuple[DataFrame, DataFrame]:
    if status is None:
        status = match_status(cohort, person, broadcast_cohort)
    left = _of_status(participants(cohort), status, "none")
    right = persons(person).withColumnsRenamed({"k_first": "p_first", "k_last": "p_last"})
    right = right.withColumns({"k_first": F.col("p_first"), "k_last": F.col("p_last")})
    left, right = _one_name(left), _one_name(right).drop("k_first", "k_last")
    # The keys of the whole cohort, not only of its unmatched rows: they need
    # no shuffle to be known.
    return left, reachable(right, _one_name(participants(cohort)), ONE_NAME_KEYS, broadcast_cohort)


def partial_name_match(
    cohort: DataFrame,
    person: DataFrame,
    contacts: DataFrame,
    status: DataFrame | None = None,
    require_contact: bool = False,
    broadcast_cohort: bool = False,
) -> DataFrame:
    """Candidates equal in birth date and one name, for participants without an exact candidate.

    Both sides are listed once per name, so one equi-join takes the place of a
    join on either name; a pair equal in both counts under the first name. All
    of these go to review, whatever their score.
    """
    left, right = _partial_sides(cohort, person, status, broadcast_cohort)
    first, last = F.col("k_first") == F.col("p_first"), F.col("k_last") == F.col("p_last")
    pairs = (
        block_pairs(left, right, ONE_NAME_KEYS, broadcast_left=broadcast_cohort)
        .where((F.col("k_part") == "first") | ~F.coalesce(first, F.lit(False)))
        .withColumns({
            "first_name_match": flag(first),
            "last_name_match": flag(last),
            "dob_match": F.lit(1),
        })
    )
    scored = _scored(pairs, contacts)
    if require_contact:
        scored = scored.where(F.col("score_reference") > 3)
    return scored


def partial_name_blocks(
    cohort: DataFrame,
    person: DataFrame,
    status: DataFrame | None = None,
    broadcast_cohort: bool = False,
) -> DataFrame:
    """Participants and persons of all shared blocks of the second match, one row each."""
    left, right = _partial_sides(cohort, person, status, broadcast_cohort)
    return block_members(left, right, ONE_NAME_KEYS, "pmi_id", "master_id")


def name_block_sizes(cohort: DataFrame, person: DataFrame) -> DataFrame:
    """Participants, persons and pairs per shared name block: shows hot keys before a run."""
    return (
        block_sizes(participants(cohort), persons(person), NAME_KEYS)
        .where((F.col("n_left") > 0) & (F.col("n_right") > 0))
        .withColumn("n_pairs", F.col("n_left") * F.col("n_right"))
    )


def decide(candidates: DataFrame, status: DataFrame, min_score: int = MIN_SCORE) -> DataFrame:
    """First-match candidates with a ``decision``: ambiguous, low_score or accepted.

    A participant with several candidate persons is ambiguous whatever the
    score.
    """
    several = status.where(F.col("status") == "several").select("k_pmi", F.lit(True).alias("_several"))
    keyed = candidates.withColumn("k_pmi", match_key(F.col("pmi_id")))
    joined = skew_join(keyed, several, ["k_pmi"], "left")
    return joined.withColumn("decision", _decision(F.col("_several"), min_score)).drop("k_pmi", "_several")


def _decision(several: Column, min_score: int) -> Column:
    low = F.col("count_identifiers_matched") < min_score
    return F.when(several, "ambiguous").when(low, "low_score").otherwise("accepted")


def decide_sole(candidates: DataFrame, min_score: int = MIN_SCORE) -> DataFrame:
    """``sole_candidates`` with their ``decision``, low_score or accepted."""
    return candidates.withColumn("decision", _decision(F.lit(False), min_score))


def decide_rivals(candidates: DataFrame) -> DataFrame:
    """``rival_candidates`` with their ``decision``, ambiguous."""
    return candidates.withColumn("decision", F.lit("ambiguous"))


def ambiguous(decided: DataFrame) -> DataFrame:
    """Candidates of participants with more than one candidate person."""
    return decided.where(F.col("decision") == "ambiguous").drop("decision")


def accepted(decided: DataFrame) -> DataFrame:
    """Candidates with enough matching identifiers and no rival person."""
    return decided.where(F.col("decision") == "accepted").drop("decision")


def low_score(candidates: DataFrame, min_score: int = MIN_SCORE) -> DataFrame:
    """Candidates with too few matching identifiers, ambiguous or not."""
    return candidates.where(F.col("count_identifiers_matched") < min_score)


def review_queue(decided: DataFrame, partial: DataFrame) -> DataFrame:
    """Everything not accepted, with the reason, in participant order.

    The two lists have no participant in common and each is distinct.
    """
    first = decided.where(F.col("decision") != "accepted").select(
        *CANDIDATE_COLUMNS, F.col("decision").alias("reason")
    )
    second = partial.select(*CANDIDATE_COLUMNS, F.lit("partial_name").alias("reason"))
    return first.unionByName(second).orderBy("pmi_id", "master_id")


def with_person_contacts(review: DataFrame, contacts: DataFrame) -> DataFrame:
    """Review rows beside each of the person's contact points (``registry.contact_rows``), in participant order."""
    return skew_join(review, contacts, ["master_id"], "left").orderBy("pmi_id", "master_id", "slot", "value")


def best_match(
    candidates: DataFrame,
    key: str,
    score: str,
    tie_break: Sequence[str],
    min_score: int = MIN_SCORE,
) -> DataFrame:
    """The highest scored candidate per key; ties go to the lowest ``tie_break`` values.

    Keys are compared like all others, without regard to case and trailing blanks.

    Spark limits each key to its first row before the shuffle, so a key with
    very many candidates costs one row per task.
    """
    order = Window.partitionBy("_key").orderBy(F.desc(score), *tie_break)
    return (
        candidates.where(F.col(score) >= min_score)
        .withColumn("_key", match_key(F.col(key)))
        .withColumn("_rank", F.row_number().over(order))
        .where(F.col("_rank") == 1)
        .drop("_rank", "_key")
    )
