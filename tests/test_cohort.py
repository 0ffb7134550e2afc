from datetime import date

import pytest

from cohortlink import schemas
from cohortlink.operators import cohort

from .conftest import rows


def queue(spark, *sites):
    return spark.createDataFrame(
        [
            (f"P{i}", "A", "B", date(1980, 1, 1), "a@x", "1", "1 A St", None, "CA", "92093", pm, bio)
            for i, (pm, bio) in enumerate(sites)
        ],
        schemas.WORKQUEUE,
    )


@pytest.mark.parametrize(
    "pm, bio, kept",
    [
        ("", "", True),
        ("", "partner_biobank", False),
        ("partner_clinic", "", False),
        ("other", "other", False),
        ("", "other", True),
        ("other", "", True),
        ("Home_Biobank ", "partner_biobank", True),
        ("partner_biobank", "home_clinic", True),
        (None, None, True),
    ],
)
def test_site_rule(spark, pm, bio, kept):
    assert cohort.site_cohort(queue(spark, (pm, bio))).count() == int(kept)


def test_other_site_lists(spark):
    df = queue(spark, ("north", "x"), ("", "south"))
    got = cohort.site_cohort(df, include=["north"], exclude=["south"])
    assert rows(got, "pmi_id") == [("P0",)]


def test_address_and_counts(spark):
    got = cohort.site_cohort(queue(spark, ("home_gateway", ""), ("home_gateway", ""), ("", "other")))
    assert got.first()["address"] == "1 A St  CA 92093"
    assert rows(cohort.site_counts(got)) == [("", "other", 1), ("home_gateway", "", 2)]
