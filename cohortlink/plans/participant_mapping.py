"""Map enrolled participants to registry persons."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Concepts
from ..operators import cohort, linkage, registry
from .stages import Run, broadcast_if_small, fits_broadcast


@dataclass(frozen=True)
class MappingResult:
    cohort: DataFrame
    accepted: DataFrame
    new_identifiers: DataFrame
    low_score: DataFrame
    review: DataFrame
    review_blocks: DataFrame


def map_participants(
    run: Run,
    workqueue: DataFrame,
    person: DataFrame,
    telecom: DataFrame,
    location: DataFrame,
    identifier: DataFrame,
    concept: DataFrame,
    c: Concepts = Concepts(),
) -> MappingResult:
    """Accepted matches with their registry rows, and everything left for review.

    Acceptance makes no pairs: a participant meets a person only where it is the
    one candidate, whatever a name's n participants and m persons. What is
    unclear can be had in two ways, computed when written: ``review`` lists
    every candidate pair; ``review_blocks`` lists the members of the blocks
    of ambiguous and of partly matching names, n + m rows. ``low_score`` has the
    sole candidates with too few matching identifiers.
    """
    selected = run.table(cohort.site_cohort(workqueue), "cohort")
    # The cohort is usually tiny beside the registry. Measured with its join keys, which
    # repeat three of its columns, it is broadcast, and registry rows out of its reach are dropped at the scan.
    small = fits_broadcast(linkage.participants(selected))
    mapped = broadcast_if_small(
        registry.of_type(identifier, c.id_type_participant).select("master_id", "id_type_concept_id")
    )
    open_persons = registry.unmapped(person, mapped, c)
    asked = F.broadcast(linkage.asked_values(selected)) if small else None
    contacts = registry.contact_keys(telecom, location, c, wanted=asked)
    options = {"broadcast_cohort": small}

    status = run.table(linkage.match_status(selected, open_persons, small), "match-status")
    sole = linkage.sole_candidates(selected, open_persons, contacts, status, **options)
    decided = run.table(linkage.decide_sole(sole), "sole-candidates")
    accepted = linkage.accepted(decided)
    rivals = linkage.rival_candidates(selected, open_persons, contacts, status, **options)
    partial = linkage.partial_name_match(selected, open_persons, contacts, status, **options)
    return MappingResult(
        cohort=selected,
        accepted=accepted,
        new_identifiers=registry.register_identifiers(accepted, identifier, concept, c),
        low_score=decided.where(F.col("decision") == "low_score").drop("decision"),
        review=linkage.review_queue(decided.unionByName(linkage.decide_rivals(rivals)), partial),
        review_blocks=linkage.exact_name_blocks(selected, open_persons, status=status, **options).unionByName(
            linkage.partial_name_blocks(selected, open_persons, status, **options), allowMissingColumns=True
        ),
    )
