"""One registered query per operator. Every query runs over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlink.config import Concepts, PARTICIPANT_LABELS
from cohortlink.operators import cohort, exports, linkage, quality, registry, roster, vocabulary
from cohortlink.plans.stages import broadcast_if_small, fits_broadcast, session_run
from cohortlink.schemas import PII_LENGTHS

from . import tables
from .views import Inputs

C = Concepts()
RUN_TS = datetime(2018, 5, 14)


class Steps:
    """Intermediate results that several queries start from, each made once per query.

    As in the jobs under ``cohortlink.plans``, what is broadcast has been
    measured first.
    """

    def __init__(self, spark: SparkSession, directory: str):
        self.spark = spark
        self.v = Inputs(spark, directory)

    @cached_property
    def run(self):
        return session_run(self.spark)

    @cached_property
    def walk(self) -> DataFrame:
        return broadcast_if_small(exports.participant_crosswalk(self.v.phi_identifier, C))

    @cached_property
    def local(self) -> DataFrame:
        return broadcast_if_small(exports.address_crosswalk(self.v.phi_identifier, C))

    @cached_property
    def participant_rows(self) -> DataFrame:
        own = registry.of_type(self.v.phi_identifier, C.id_type_participant)
        return broadcast_if_small(own.select("master_id", "identifier", "id_type_concept_id"))

    @cached_property
    def cohort(self) -> DataFrame:
        return cohort.site_cohort(self.v.workqueue)

    @cached_property
    def selected(self) -> DataFrame:
        return self.run.table(self.cohort, "cohort")

    @cached_property
    def options(self) -> dict[str, bool]:
        return {"broadcast_cohort": fits_broadcast(linkage.participants(self.selected))}

    @cached_property
    def open_persons(self) -> DataFrame:
        return registry.unmapped(self.v.phi_person, self.participant_rows, C)

    @cached_property
    def contacts(self) -> DataFrame:
        small = self.options["broadcast_cohort"]
        asked = F.broadcast(linkage.asked_values(self.selected)) if small else None
        return registry.contact_keys(self.v.phi_telecom, self.v.phi_location, C, wanted=asked)

    @cached_property
    def first(self) -> DataFrame:
        return linkage.exact_name_match(self.selected, self.open_persons, self.contacts, **self.options)

    @cached_property
    def status(self) -> DataFrame:
        status = linkage.match_status(self.selected, self.open_persons, **self.options)
        return self.run.table(status, "match-status")

    @cached_property
    def sole(self) -> DataFrame:
        found = linkage.sole_candidates(
            self.selected, self.open_persons, self.contacts, self.status, **self.options
        )
        return linkage.decide_sole(found)

    @cached_property
    def rivals(self) -> DataFrame:
        found = linkage.rival_candidates(
            self.selected, self.open_persons, self.contacts, self.status, **self.options
        )
        return linkage.decide_rivals(found)

    def second(self, **more) -> DataFrame:
        return linkage.partial_name_match(
            self.selected, self.open_persons, self.contacts, self.status, **self.options, **more
        )

    @cached_property
    def accepted(self) -> DataFrame:
        return linkage.accepted(self.sole)

    @cached_property
    def review(self) -> DataFrame:
        return linkage.review_queue(self.sole.unionByName(self.rivals), self.second())

    @cached_property
    def concept(self) -> DataFrame:
        return vocabulary.seed(self.v.concept, vocabulary.seed_concepts(self.spark))

    @cached_property
    def candidates(self) -> DataFrame:
        v = self.v
        return roster.mrn_candidates(v.roster_master, v.phi_person, v.phi_telecom, v.phi_identifier, C)

    @cached_property
    def best(self) -> DataFrame:
        v = self.v
        return roster.best_mrn(
            v.roster_master, v.phi_person, v.phi_telecom, v.phi_identifier, C,
            broadcast_roster=fits_broadcast(v.roster_master), keep=self.run.table,
        )

    @cached_property
    def links(self) -> DataFrame:
        return roster.study_links(self.v.roster_master, self.v.phi_identifier, C)

    @cached_property
    def sync(self):
        return roster.sync(self.v.roster_master, self.v.roster_staging, RUN_TS)

    @cached_property
    def soft(self):
        return roster.sync(self.v.roster_master, self.v.roster_staging, RUN_TS, soft_delete=True)


def _concept_usage(s: Steps) -> DataFrame:
    used = s.v.phi_identifier.select(F.col("id_type_concept_id").alias("concept_id")).unionByName(
        s.v.phi_identifier.select(F.col("id_use_concept_id").alias("concept_id"))
    )
    counts = used.groupBy("concept_id").agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.join(s.concept, "concept_id", "left").select(
        "concept_id", "concept_class_id", "concept_code", "n_rows"
    )


QUERIES: dict[str, Callable[[Steps], DataFrame]] = {
    # clinical extracts
    "cdm_person": lambda s: exports.cdm_person(s.v.person, s.walk),
    "cdm_visit": lambda s: exports.cdm_visit(s.v.visit_occurrence, s.walk),
    "cdm_condition": lambda s: exports.cdm_condition(s.v.condition_occurrence, s.walk),
    "cdm_procedure": lambda s: exports.cdm_procedure(s.v.procedure_occurrence, s.walk),
    "cdm_measurement": lambda s: exports.cdm_measurement(s.v.measurement, s.walk),
    "cdm_drug": lambda s: exports.cdm_drug(s.v.drug_exposure, s.walk),
    "impossible_births": lambda s: exports.impossible_births(s.v.person),
    # personal-data tables
    "pii_name": lambda s: exports.pii_name(s.v.phi_person, s.participant_rows),
    "pii_email": lambda s: exports.pii_email(s.v.phi_telecom, s.participant_rows),
    "pii_phone": lambda s: exports.pii_phone(s.v.phi_telecom, s.participant_rows),
    "pii_address": lambda s: exports.pii_address(s.v.person, s.v.phi_identifier, local=s.local),
    "pii_mrn": lambda s: exports.pii_mrn(s.v.phi_person, s.participant_rows),
    "pii_too_long": lambda s: quality.too_long(
        exports.pii_name(s.v.phi_person, s.participant_rows), PII_LENGTHS["pii_name"]
    ),
    # cohort and registry
    "site_cohort": lambda s: s.cohort,
    "site_counts": lambda s: cohort.site_counts(s.cohort),
    "person_wide": lambda s: registry.person_wide(s.v.phi_person, s.v.phi_telecom, s.v.phi_location),
    "unmapped_persons": lambda s: s.open_persons,
    "crosswalk": lambda s: registry.crosswalk(
        s.v.phi_identifier, C.id_type_local_person, C.id_type_participant
    ),
    "contact_keys": lambda s: registry.contact_keys(s.v.phi_telecom, s.v.phi_location),
    # linkage
    "first_match": lambda s: s.first,
    "first_match_members": lambda s: linkage.exact_name_blocks(s.selected, s.open_persons, **s.options),
    "name_block_sizes": lambda s: linkage.name_block_sizes(s.selected, s.open_persons),
    "match_status": lambda s: s.status.select("k_pmi", "status"),
    "ambiguous_match": lambda s: linkage.ambiguous(s.rivals),
    "accepted_match": lambda s: s.accepted,
    "low_score_match": lambda s: linkage.low_score(s.first),
    "second_match": lambda s: s.second(),
    "second_match_with_contact": lambda s: s.second(require_contact=True),
    "second_match_members": lambda s: linkage.partial_name_blocks(s.selected, s.open_persons, s.status, **s.options),
    "review_queue": lambda s: s.review,
    "review_report": lambda s: linkage.with_person_contacts(
        s.review, registry.contact_rows(s.v.phi_telecom, s.v.phi_location)
    ),
    # vocabulary and registration
    "concept_seed": lambda s: s.concept,
    "concept_lookup": lambda s: vocabulary.lookup(
        s.concept, PARTICIPANT_LABELS.id_use_code, "Identifier Use", vocabulary.VOCABULARY_ID
    ),
    "concept_prefix": lambda s: vocabulary.starting_with(s.concept, "vocabulary_id", "ident"),
    "concept_usage": _concept_usage,
    "register_identifiers": lambda s: registry.register_identifiers(
        s.accepted, s.v.phi_identifier, s.concept
    ),
    "domain_seed": lambda s: vocabulary.seed(
        tables.known_domains(s.v.concept), vocabulary.seed_domains(s.spark), "domain_id"
    ),
    "vocabulary_seed": lambda s: vocabulary.seed(
        tables.known_vocabularies(s.v.concept), vocabulary.seed_vocabularies(s.spark), "vocabulary_id"
    ),
    "class_seed": lambda s: vocabulary.seed(
        tables.known_classes(s.v.concept), vocabulary.seed_concept_classes(s.spark), "concept_class_id"
    ),
    # one configured id is wrong on purpose
    "concept_mismatches": lambda s: quality.concept_mismatches(s.concept, Concepts(telecom_home=2000000401)),
    "registry_find_first": lambda s: registry.find(
        s.v.phi_identifier, C.id_type_study, s.v.roster_staging.select("study_id"), limit=19
    ),
    "registry_find_listed": lambda s: registry.find(s.v.phi_identifier, C.id_type_study, ["7", "14", "21 ", "22"]),
    "registry_find": lambda s: registry.find(
        s.v.phi_identifier,
        C.id_type_study,
        s.v.roster_staging.where(F.col("withdrawn___yes") == 1).select("study_id"),
    ),
    # roster
    "next_study_id": lambda s: roster.next_study_id(s.v.roster_staging),
    "roster_duplicates": lambda s: roster.duplicates(s.v.roster_staging),
    "duplicate_pmi": lambda s: roster.duplicate_keys(s.v.roster_staging, "pmi_id"),
    "duplicate_mrn": lambda s: roster.duplicate_keys(s.v.roster_staging, "mrn"),
    "roster_sync": lambda s: s.sync.snapshot,
    "roster_sync_soft": lambda s: s.soft.snapshot,
    "sync_changes_soft": lambda s: s.soft.changes,
    "deleted_rows": lambda s: roster.deleted(s.soft.snapshot),
    "sync_changes": lambda s: s.sync.changes,
    "pad_mrn": lambda s: roster.pad_mrn(s.v.roster_master),
    "short_mrn_audit": lambda s: roster.short_mrn_audit(s.v.roster_master, s.v.patient_src),
    "short_mrn_members": lambda s: roster.short_mrn_blocks(s.v.roster_master, s.v.patient_src),
    "mrn_candidates": lambda s: s.candidates,
    "mrn_candidate_members": lambda s: roster.mrn_candidate_blocks(
        s.v.roster_master, s.v.phi_person
    ),
    "best_match": lambda s: linkage.best_match(
        s.candidates, "study_id", "total_identifiers_matched", ["master_id", "phi_mrn", "source_id"]
    ),
    "best_mrn": lambda s: s.best,
    "recovered_mrn": lambda s: roster.apply_recovered_mrn(s.v.roster_master, s.best),
    "study_links": lambda s: s.links,
    "mrn_link_members": lambda s: roster.mrn_link_blocks(s.v.roster_master, s.v.phi_identifier),
    "link_by_mrn": lambda s: roster.link_by_mrn(
        s.v.roster_master, s.v.phi_identifier, s.v.phi_person, s.v.phi_telecom
    ),
    "merge_study_ids": lambda s: registry.merge_study_ids(s.v.phi_identifier, s.links, with_action=True),
    "register_study_ids": lambda s: registry.register_study_ids(s.links, s.concept),
    # checks
    "reconcile": lambda s: quality.reconcile(
        s.v.roster_master, s.v.roster_staging, s.v.phi_identifier, s.links
    ),
    "key_presence": lambda s: quality.key_presence(s.v.roster_master, s.v.roster_staging, s.v.phi_identifier),
    "repeated_links": lambda s: quality.repeated_links(s.links),
    "missing_from_master": lambda s: quality.missing_from_master(s.v.roster_staging, s.v.roster_master),
    "unregistered_roster": lambda s: quality.unregistered(s.v.roster_master, s.v.phi_identifier),
    "unmatched_links": lambda s: quality.unmatched_links(s.links),
    "links_without_mrn": lambda s: quality.links_without_mrn(s.links),
    "crosswalk_fanout": lambda s: quality.crosswalk_fanout(s.v.phi_identifier),
    "shared_numbers": lambda s: quality.shared_numbers(s.v.phi_identifier),
    "several_ehr_rows": lambda s: quality.several_ehr_rows(s.v.phi_identifier),
    "unreadable_ids": lambda s: exports.unreadable_ids(s.v.phi_identifier),
    # tables written and read back
    "roster_csv": tables.roster_csv,
    "workqueue_as_of": tables.workqueue_as_of,
    "appended_contacts": tables.appended_contacts,
    "merge_study_ids_versioned": tables.merge_study_ids_versioned,
    "roster_sync_versioned": tables.roster_sync_versioned,
    "published_types": tables.published_types,
    "published_emails": tables.published_emails,
    "review_queue_order": lambda s: tables.review_order(s, s.review, ["pmi_id", "master_id"]),
    "review_report_order": lambda s: tables.review_order(
        s,
        linkage.with_person_contacts(s.review, registry.contact_rows(s.v.phi_telecom, s.v.phi_location)),
        ["pmi_id", "master_id", "slot", "value"],
    ),
    "crosswalk_bucketed": tables.crosswalk_bucketed,
    "contacts_bucketed": tables.contacts_bucketed,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _runner(build) for name, build in QUERIES.items()}


def _runner(build: Callable[[Steps], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, directory: build(Steps(spark, directory))
