"""The study roster: duplicates, sync with its upstream, record numbers, registry links."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..config import MIN_SCORE, SYNC_SOURCE, Concepts
from ..functions.match import flag
from ..functions.text import contact_key, match_key, phone_key, trimmed_length
from .blocks import block_members, block_pairs, skew_join
from .linkage import asked_values, contact_matches, reachable
from .merge import Merge, snapshot_merge
from .registry import contact_keys, contact_rows, contact_values, of_type

SYNCED_COLUMNS = (
    "mrn",
    "duplicate_record___yes",
    "pmi_id",
    "withdrawn___yes",
    "withdrawn_date",
    "withdrawn_recorded_in_healthpro",
)
AUDIT_COLUMNS = ("study_id", "mrn", "pmi_id")
DELETED_FLAG = "deleted_in_CTRI_Redcap"
SHORT_MRN = 8
_NAME_KEYS = ["k_first", "k_last"]


def next_study_id(staging: DataFrame) -> DataFrame:
    """One row: the number after the highest study id."""
    return staging.agg((F.max(F.col("study_id").try_cast("bigint")) + 1).alias("next_study_id"))


# --- duplicates -------------------------------------------------------------


def duplicates(staging: DataFrame) -> DataFrame:
    """Roster rows that share name and birth date with a suspicious group.

    A group of equal name, birth date, phone and e-mail is suspicious if it has
    several rows or a row flagged as duplicate. The widening to name and birth
    date alone is a semi-join, so copies are not multiplied.
    """
    key = {
        "k_first": match_key(F.col("first_name")),
        "k_last": match_key(F.col("last_name")),
        "k_dob": F.col("dob"),
    }
    contact = {
        "k_phone": match_key(F.col("phone_number")),
        "k_email": match_key(F.col("email_address")),
    }
    named = staging.where(F.col("first_name").isNotNull() & F.col("last_name").isNotNull()).withColumns(key)
    suspicious = (
        named.withColumns(contact)
        .groupBy(*key, *contact)
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.max(flag(F.col("duplicate_record___yes") == 1)).alias("flagged"),
        )
        .where((F.col("n_rows") > 1) | (F.col("flagged") == 1))
        .select(*key)
    )
    return (
        named.join(suspicious, list(key), "left_semi")
        .select(*staging.columns)
        .distinct()
        .orderBy("first_name", "last_name", "dob", "study_id")
    )


def duplicate_keys(staging: DataFrame, column: str) -> DataFrame:
    """Roster rows whose value in ``column`` occurs more than once, in its order."""
    keyed = staging.where(F.col(column).isNotNull()).withColumn("_key", match_key(F.col(column)))
    repeated = (
        keyed.groupBy("_key").agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1).select("_key")
    )
    return skew_join(keyed, repeated, ["_key"], "left_semi").select(*staging.columns).orderBy(column, "study_id")


# --- sync -------------------------------------------------------------------


def sync(
    master: DataFrame,
    staging: DataFrame,
    run_ts: datetime | Column,
    source: str = SYNC_SOURCE,
    soft_delete: bool = False,
) -> Merge:
    """Bring the master roster in step with staging; rows gone from staging are deleted.

    With ``soft_delete`` they stay and are flagged (``deleted``).

    A matched row takes the record number, duplicate flag, participant id and
    withdrawal fields; its name, birth date and contact fields stay. A staging
    table without one of the columns to take raises an error.
    """
    missing = [c for c in SYNCED_COLUMNS if c not in staging.columns]
    if missing:
        raise ValueError(f"staging lacks {', '.join(missing)}")
    stamp = run_ts if isinstance(run_ts, Column) else F.lit(run_ts)
    return snapshot_merge(
        master,
        staging,
        key="study_id",
        update=SYNCED_COLUMNS,
        stamp={"update_date": stamp, "source": F.lit(source)},
        delete_missing=not soft_delete,
        audit=AUDIT_COLUMNS,
        mark_missing={DELETED_FLAG: F.lit("1")} if soft_delete else None,
    )


def deleted(master: DataFrame) -> DataFrame:
    """Roster rows that a sync has flagged as gone from its upstream."""
    return master.where(match_key(F.col(DELETED_FLAG)) == "1")


# --- record numbers ---------------------------------------------------------


def _is_short(mrn: Column) -> Column:
    return trimmed_length(mrn) < SHORT_MRN


def pad_mrn(roster: DataFrame) -> DataFrame:
    """Put exactly one zero before each record number that is too short."""
    mrn = F.col("mrn")
    return roster.withColumn("mrn", F.when(_is_short(mrn), F.concat(F.lit("0"), mrn)).otherwise(mrn))


def _audit_sides(roster: DataFrame, patient_src: DataFrame) -> tuple[DataFrame, DataFrame]:
    short = roster.where(_is_short(F.col("mrn"))).select(
        "study_id",
        "mrn",
        "first_name",
        "last_name",
        "dob",
        match_key(F.concat(F.lit("0"), F.col("mrn"))).alias("_key"),
    )
    src = patient_src.select(
        match_key(F.col("mrn")).alias("_key"),
        F.col("mrn").alias("src_mrn"),
        "pat_first_name",
        "pat_last_name",
        F.col("birth_date").alias("src_birth_date"),
    )
    return short, src


def short_mrn_audit(
    roster: DataFrame, patient_src: DataFrame
) -> DataFrame:
    """Short record numbers beside the EHR patient found under the padded number.
    """
    short, src = _audit_sides(roster, patient_src)
    return block_pairs(short, src, ["_key"], how="left").drop("_key")


def short_mrn_blocks(
    roster: DataFrame, patient_src: DataFrame
) -> DataFrame:
    """Roster rows and EHR record numbers of all shared numbers of the audit, one row each."""
    short, src = _audit_sides(roster, patient_src)
    return block_members(short, src, ["_key"], "study_id", "src_mrn").withColumnRenamed(
        "_key", "padded_mrn"
    )


def _without_mrn(roster: DataFrame) -> DataFrame:
    missing = F.col("mrn").isNull() & F.col("first_name").isNotNull()
    return roster.where(missing).select(
        "study_id",
        "first_name",
        "last_name",
        "dob",
        "phone_number",
        "email_address",
        match_key(F.col("first_name")).alias("k_first"),
        match_key(F.col("last_name")).alias("k_last"),
        phone_key(F.col("phone_number")).alias("k_phone"),
        contact_key(F.col("email_address")).alias("k_email"),
    )


def _named_persons(person: DataFrame) -> DataFrame:
    return person.select(
        "master_id",
        F.col("first_name").alias("person_first_name"),
        "surname",
        "birth_date",
        match_key(F.col("first_name")).alias("k_first"),
        match_key(F.col("surname")).alias("k_last"),
    )


def _mrn_rows(identifier: DataFrame, c: Concepts) -> DataFrame:
    return of_type(identifier, c.id_type_mrn).select(
        "master_id", F.col("identifier").alias("phi_mrn"), "source_id"
    )


def mrn_candidates(
    roster: DataFrame,
    person: DataFrame,
    telecom: DataFrame,
    identifier: DataFrame,
    c: Concepts = Concepts(),
) -> DataFrame:
    """Persons of the same name for each roster row without a record number.

    The score is 2 for the name plus one each for birth date, phone and e-mail.
    ``home_phone``, ``work_phone`` and ``email`` are the person's contact values that
    agree with the row's, the least as written if there are several. A row without a namesake stays, with empty person columns. ``best_mrn`` finds
    the best of all pairs without making them.
    """
    left = _without_mrn(roster)
    pairs = block_pairs(left, _named_persons(person), _NAME_KEYS, how="left")
    columns = [
        "study_id",
        "first_name",
        "last_name",
        "dob",
        "phone_number",
        "email_address",
        "master_id",
        "person_first_name",
        "surname",
        "birth_date",
    ]
    phone, email = phone_key(F.col("phone_number")), contact_key(F.col("email_address"))
    slots = {"home_phone": phone, "work_phone": phone, "email": email}
    found = contact_matches(pairs.select(*columns), contact_values(telecom, None, c), slots)
    flagged = found.withColumns({
        "phone_match": flag(F.col("home_phone").isNotNull() | F.col("work_phone").isNotNull()),
        "email_match": flag(F.col("email").isNotNull()),
    })
    scored = flagged.withColumn("dob_match", flag(F.col("dob") == F.col("birth_date"))).withColumn(
        "total_identifiers_matched",
        F.lit(2) + F.col("dob_match") + F.col("phone_match") + F.col("email_match"),
    )
    return scored.join(_mrn_rows(identifier, c).distinct(), "master_id", "left").select(
        *columns[:7],
        "phi_mrn",
        "source_id",
        *columns[7:],
        *slots,
        "dob_match",
        "phone_match",
        "email_match",
        "total_identifiers_matched",
    )


def mrn_candidate_blocks(
    roster: DataFrame, person: DataFrame
) -> DataFrame:
    """Roster rows and persons of all shared names, one row each."""
    return block_members(
        _without_mrn(roster), _named_persons(person), _NAME_KEYS, "study_id", "master_id"
    )


def best_mrn(
    roster: DataFrame,
    person: DataFrame,
    telecom: DataFrame,
    identifier: DataFrame,
    c: Concepts = Concepts(),
    broadcast_roster: bool = False,
    keep: Callable[[DataFrame, str], DataFrame] = lambda df, name: df,
) -> DataFrame:
    """The best person per roster row without a record number, if at least four identifiers agree.

    Equals ``linkage.best_match`` over all name pairs, without making them.
    Score 4 means the name and two of birth date, phone and e-mail; score 5
    means all three. Persons are therefore reduced to the lowest id per
    combination first, and each roster row looks up its own combinations. Ties
    go to the lowest person, then to the lowest record number.

    Set ``broadcast_roster`` if the roster has been measured small: persons and
    contact points out of its reach are then dropped while they are read. ``keep``
    writes a relation that is read several times (``plans.stages.Run.table``).
    """
    left = _without_mrn(roster).where(F.col("last_name").isNotNull())
    persons = reachable(_named_persons(person), left, _NAME_KEYS, broadcast_roster).select(
        "master_id", *_NAME_KEYS, F.col("birth_date").cast("string").alias("k_dob")
    )
    asked = F.broadcast(asked_values(left, {"phone": F.col("k_phone"), "email": F.col("k_email")}))
    contacts = contact_keys(telecom, None, c, wanted=asked if broadcast_roster else None)
    # Four branches start from the persons beside their contact values.
    known = keep(persons.join(contacts, "master_id"), "known-contacts")
    # Lowest person per name, birth date and contact value, with the group size.
    by_contact = known.groupBy(*_NAME_KEYS, "k_dob", "kind", "value_key").agg(
        F.min("master_id").alias("master_id"), F.count(F.lit(1)).alias("n_persons")
    )
    reached = keep(_reached_by_both(left, known, by_contact), "reached-by-both")

    def value_of(kind: str) -> Column:
        return F.when(F.col("kind") == kind, F.col("value_key"))

    with_dob = by_contact.where(F.col("k_dob").isNotNull()).select(
        *_NAME_KEYS, "k_dob", value_of("phone").alias("k_phone"), value_of("email").alias("k_email"), "master_id"
    )
    with_both = (
        reached.groupBy(*_NAME_KEYS, "k_dob", "k_phone", "k_email")
        .agg(F.min("master_id").alias("master_id"))
        .where(F.col("k_dob").isNotNull())
    )
    any_dob = (
        reached.groupBy(*_NAME_KEYS, "k_phone", "k_email")
        .agg(F.min("master_id").alias("master_id"))
        .withColumn("k_dob", F.lit(None).cast("string"))
    )
    lookup = with_dob.unionByName(with_both).unionByName(any_dob)
    # Every combination of a roster row is a full key: an empty part is spelled
    # out, so rows meet only under the same combination.
    parts = {
        "k_dob": F.col("dob").cast("string"),
        "k_phone": F.col("k_phone"),
        "k_email": F.col("k_email"),
    }
    combinations = [
        ("k_dob", "k_phone"),
        ("k_dob", "k_email"),
        ("k_phone", "k_email"),
        ("k_dob", "k_phone", "k_email"),
    ]
    asks = F.array(*[
        F.when(
            _all_known(parts, used),
            F.struct(
                *[(parts[k] if k in used else F.lit(None).cast("string")).alias(k) for k in parts],
                *[F.lit(int(k in used)).alias(k.replace("k_", "") + "_match") for k in parts],
            ),
        )
        for used in combinations
    ])
    asked = left.select("study_id", *_NAME_KEYS, F.explode(F.array_compact(asks)).alias("_ask")).select(
        "study_id", *_NAME_KEYS, "_ask.*"
    )
    ask_keys = [*_NAME_KEYS, *parts]

    def spelled(rows: DataFrame) -> DataFrame:
        return rows.withColumns({k: F.coalesce(F.concat(F.lit("="), k), F.lit("-")) for k in parts})

    total = F.lit(2) + F.col("dob_match") + F.col("phone_match") + F.col("email_match")
    found = spelled(asked).join(spelled(lookup), ask_keys).withColumn("total_identifiers_matched", total)
    order = Window.partitionBy("study_id").orderBy(F.desc("total_identifiers_matched"), "master_id")
    best = found.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") == 1)
    mrns = (
        _mrn_rows(identifier, c)
        .groupBy("master_id")
        .agg(F.min(F.struct("phi_mrn", "source_id")).alias("_mrn"))
        .select("master_id", "_mrn.*")
    )
    return best.join(mrns, "master_id", "left").select(
        "study_id",
        "master_id",
        "phi_mrn",
        "source_id",
        "dob_match",
        "phone_match",
        "email_match",
        "total_identifiers_matched",
    )


def _all_known(parts: dict[str, Column], used: tuple[str, ...]) -> Column:
    known = F.lit(True)
    for name in used:
        known = known & parts[name].isNotNull()
    return known


def _reached_by_both(left: DataFrame, known: DataFrame, by_contact: DataFrame) -> DataFrame:
    """Persons having both the phone and the e-mail of a roster row of their name.

    Each distinct (name, phone, e-mail) is looked up through the rarer of its
    two contact values and then tested for the other, so a placeholder value
    shared by very many persons is never expanded beside a rarer one.
    """
    wanted = left.dropna(subset=["k_phone", "k_email"]).select(*_NAME_KEYS, "k_phone", "k_email").distinct()
    ways = F.array(
        F.struct(F.lit("phone").alias("kind"), F.col("k_phone").alias("value_key")),
        F.struct(F.lit("email").alias("kind"), F.col("k_email").alias("value_key")),
    )
    sizes = by_contact.groupBy(*_NAME_KEYS, "kind", "value_key").agg(F.sum("n_persons").alias("n_persons"))
    rarer = (
        wanted.select("*", F.explode(ways).alias("_way"))
        .select(*wanted.columns, "_way.*")
        .join(sizes, [*_NAME_KEYS, "kind", "value_key"])
        .groupBy(*wanted.columns)
        .agg(F.count(F.lit(1)).alias("n_ways"), F.min(F.struct("n_persons", "kind", "value_key")).alias("_way"))
        .where(F.col("n_ways") == 2)
        .select(*wanted.columns, "_way.kind", "_way.value_key")
    )
    by_phone = F.col("kind") == "phone"
    return (
        rarer.join(known, [*_NAME_KEYS, "kind", "value_key"])
        .select(
            *wanted.columns,
            "k_dob",
            "master_id",
            F.when(by_phone, "email").otherwise("phone").alias("kind"),
            F.when(by_phone, F.col("k_email")).otherwise(F.col("k_phone")).alias("value_key"),
        )
        .join(known.select("master_id", "kind", "value_key"), ["master_id", "kind", "value_key"], "left_semi")
        .drop("kind", "value_key")
    )


def apply_recovered_mrn(roster: DataFrame, best: DataFrame) -> DataFrame:
    """Write the recovered record number where the roster has none."""
    found = best.select(
        match_key(F.col("study_id")).alias("_key"), F.col("phi_mrn").alias("_found")
    )
    missing = F.col("mrn").isNull() & F.col("first_name").isNotNull()
    return (
        roster.withColumn("_key", match_key(F.col("study_id")))
        .join(found, "_key", "left")
        .withColumn("mrn", F.when(missing, F.col("_found")).otherwise(F.col("mrn")))
        .select(*roster.columns)
    )


# --- links to the registry --------------------------------------------------


def _links_by_mrn(roster: DataFrame, identifier: DataFrame, c: Concepts) -> DataFrame:
    """Registry persons per distinct record number, as written or with one zero before it.

    Each number is looked up under both spellings with one equi-join, in place
    of a join on either.
    """
    numbers = roster.where(F.col("mrn").isNotNull()).select(match_key(F.col("mrn")).alias("_mrn")).distinct()
    spellings = numbers.select(
        "_mrn", F.explode(F.array(F.col("_mrn"), F.concat(F.lit("0"), "_mrn"))).alias("_spelled")
    )
    registry = _mrn_rows(identifier, c).withColumn("_spelled", match_key(F.col("phi_mrn")))
    return spellings.join(registry, "_spelled").select("_mrn", "master_id", "phi_mrn", "source_id").distinct()


def _named(roster: DataFrame) -> DataFrame:
    return roster.where(F.col("first_name").isNotNull() & F.col("last_name").isNotNull()).withColumn(
        "_mrn", match_key(F.col("mrn"))
    )


def study_links(
    roster: DataFrame,
    identifier: DataFrame,
    c: Concepts = Concepts(),
) -> DataFrame:
    """Distinct (study_id, mrn, master_id, source_id): the input of ``registry.merge_study_ids``.

    A number shared by n roster rows and m registry rows makes n * m links;
    ``mrn_link_blocks`` has its n + m members.
    """
    rows = _named(roster).select("study_id", "mrn", "_mrn").distinct()
    links = _links_by_mrn(roster, identifier, c)
    return (
        block_pairs(rows, links, ["_mrn"], how="left")
        .select("study_id", "mrn", "master_id", "source_id")
        .distinct()
    )


def mrn_link_blocks(
    roster: DataFrame,
    identifier: DataFrame,
    c: Concepts = Concepts(),
) -> DataFrame:
    """Study ids and persons of all linked record numbers, one row each."""
    rows = _named(roster).select("study_id", "_mrn").distinct()
    links = _links_by_mrn(roster, identifier, c)
    return block_members(rows, links, ["_mrn"], "study_id", "master_id").withColumnRenamed(
        "_mrn", "k_mrn"
    )


def link_by_mrn(
    roster: DataFrame,
    identifier: DataFrame,
    person: DataFrame,
    telecom: DataFrame,
    c: Concepts = Concepts(),
) -> DataFrame:
    """Roster rows beside the registry person found by record number, with contact points.

    Rows without a person stay, with empty person columns; a person's contact
    points come one row each (``registry.contact_rows``). Names and contact points
    are put together per linked person first; rows without a person go round that join, and
    so do not meet in one task.
    """
    names = person.select(
        "master_id",
        F.col("first_name").alias("mrn_first_name"),
        F.col("surname").alias("mrn_surname"),
        F.col("birth_date").alias("mrn_birth_date"),
    ).distinct()
    rows = _named(roster).select(
        "study_id", "mrn", "first_name", "last_name", "dob", "phone_number", "email_address", "_mrn"
    )
    links = block_pairs(rows.distinct(), _links_by_mrn(roster, identifier, c), ["_mrn"], how="left").drop("_mrn")
    linked = links.where(F.col("master_id").isNotNull())
    persons = linked.select("master_id").distinct()
    details = persons.join(names, "master_id", "left").join(contact_rows(telecom, None, c), "master_id", "left")
    beside = skew_join(linked, details, ["master_id"], "left")
    return beside.unionByName(links.where(F.col("master_id").isNull()), allowMissingColumns=True)
