"""Bring the roster in step with its upstream and the registry in step with the roster."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame

from ..config import Concepts
from ..operators import quality, registry, roster
from .stages import Run, fits_broadcast


@dataclass(frozen=True)
class SyncResult:
    roster: DataFrame
    changes: DataFrame
    recovered: DataFrame
    links: DataFrame
    link_blocks: DataFrame
    identifier: DataFrame
    checks: DataFrame


def sync_roster(
    run: Run,
    master: DataFrame,
    staging: DataFrame,
    person: DataFrame,
    telecom: DataFrame,
    identifier: DataFrame,
    run_ts: datetime,
    c: Concepts = Concepts(),
) -> SyncResult:
    """The next roster and registry versions, with the change log and check counts.

    Duplicates (``roster.duplicates``, ``roster.duplicate_keys``) are to be
    resolved in staging by hand before this runs. ``link_blocks`` names the
    members of every linked record number.
    """
    merged = roster.sync(master, staging, run_ts)
    padded = run.table(roster.pad_mrn(merged.snapshot), "roster-synced")
    recovered = run.table(
        roster.best_mrn(
            padded, person, telecom, identifier, c, broadcast_roster=fits_broadcast(padded), keep=run.table
        ),
        "mrn-recovered",
    )
    completed = run.table(roster.apply_recovered_mrn(padded, recovered), "roster-completed")
    links = run.table(roster.study_links(completed, identifier, c), "study-links")
    next_registry = registry.merge_study_ids(identifier, links, c)
    return SyncResult(
        roster=completed,
        changes=merged.changes,
        recovered=recovered,
        links=links,
        link_blocks=roster.mrn_link_blocks(completed, identifier, c),
        identifier=next_registry,
        checks=quality.reconcile(completed, staging, next_registry, links, c),
    )
