"""Selection of a site's participants from the enrolment work queue."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import EXCLUDE_SITES, INCLUDE_SITES
from ..functions.text import address_line, match_key

PM_SITE = "physical_measurements_location"
BIO_SITE = "biospecimens_location"


def _site(name: str) -> Column:
    return match_key(F.coalesce(F.col(name), F.lit("")))


def site_rule(include: Sequence[str], exclude: Sequence[str]) -> Column:
    """True for a record seen at an included site, or with one blank site and no excluded one."""
    include = [s.rstrip(" ").lower() for s in include]
    exclude = [s.rstrip(" ").lower() for s in exclude]
    pm, bio = _site(PM_SITE), _site(BIO_SITE)
    return (
        pm.isin(include)
        | bio.isin(include)
        | ((pm == "") & ~bio.isin(exclude))
        | ((bio == "") & ~pm.isin(exclude))
    )


def site_cohort(
    workqueue: DataFrame,
    include: Sequence[str] = INCLUDE_SITES,
    exclude: Sequence[str] = EXCLUDE_SITES,
) -> DataFrame:
    """Participants of the study site with their address on one line.

    Withdrawn participants stay in: withdrawal is applied at extract time.
    """
    return workqueue.where(site_rule(include, exclude)).select(
        "pmi_id",
        "first_name",
        "last_name",
        "birth_date",
        "email",
        "phone",
        address_line(
            F.col("street_address"), F.col("city"), F.col("state"), F.col("zip")
        ).alias("address"),
        F.coalesce(PM_SITE, F.lit("")).alias(PM_SITE),
        F.coalesce(BIO_SITE, F.lit("")).alias(BIO_SITE),
    )


def site_counts(cohort: DataFrame) -> DataFrame:
    """Number of participants per pair of sites."""
    return cohort.groupBy(PM_SITE, BIO_SITE).agg(F.count(F.lit(1)).alias("n"))
