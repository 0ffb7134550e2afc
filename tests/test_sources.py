from datetime import date

import pytest
from pyspark.sql import functions as F

from cohortlink import schemas
from cohortlink.operators import registry
from cohortlink.plans.stages import Run
from cohortlink.sources import read, write

from .conftest import rows
from .test_registry import C, identifiers

CSV = """study_id,duplicate_record___yes,mrn,first_name,last_name,dob,street_address_line_1,street_address_line_2,city,state,zip_code,email_address,phone_number,pmi_id,withdrawn___yes,withdrawn_date,withdrawn_recorded_in_healthpro
1,0,0123,"Ann","Lee, Jr",1980-05-01,"1 ""A"" St",,La Jolla,CA,92093,a@x,"(858) 555-1212",P1,0,,
2,1,,Bob,O"Ray,1981-06-02,,,,,,,,P2,1,2018-05-14,yes
"""


@pytest.fixture(scope="module")
def run(spark):
    with Run(spark) as run:
        yield run


def load(spark, run, path, text):
    path.write_text(text)
    return read.read_roster_csv(spark, str(path), run.table)


def test_roster_csv(spark, run, tmp_path):
    got = load(spark, run, tmp_path / "roster.csv", CSV)
    assert got.rows.schema == schemas.ROSTER_STAGING
    columns = "study_id", "first_name", "last_name", "street_address_line_1", "mrn", "dob", "withdrawn_date"
    assert rows(got.rows, *columns) == [
        ("1", "Ann", "Lee, Jr", "1 A St", "0123", date(1980, 5, 1), None),
        ("2", "Bob", "ORay", None, None, date(1981, 6, 2), date(2018, 5, 14)),
    ]
    assert got.rejects.count() == 0


def test_roster_csv_parts_bad_lines_from_rows(spark, run, tmp_path):
    bad = ["3,no,,Cat,Fox,not a date,,,,,,,,P3,0,,", "4,0,too,few", "5" + "," * 17 + "one too many"]
    got = load(spark, run, tmp_path / "roster.csv", CSV + "\n".join(bad) + "\n")
    assert rows(got.rows, "study_id") == [("1",), ("2",)]
    assert rows(got.rejects, "line") == [(x,) for x in bad]
    assert set(got.rows.inputFiles()) == set(got.rejects.inputFiles())  # one table, written by one scan


def test_roster_csv_with_other_titles(spark, run, tmp_path):
    with pytest.raises(Exception, match="(?i)header"):
        load(spark, run, tmp_path / "roster.csv", CSV.replace("mrn,first_name", "first_name,mrn"))


def test_roster_csv_without_rows(spark, run, tmp_path):
    got = load(spark, run, tmp_path / "roster.csv", CSV.splitlines()[0] + "\n")
    assert got.rows.count() == got.rejects.count() == 0


def test_workqueue_snapshot(spark, tmp_path):
    df = spark.createDataFrame(
        [("P1", "Ann", "Lee", date(1980, 5, 1), None, "")],
        "`PMI ID` string, `First Name` string, `Last Name` string, `Date of Birth` date,"
        " `Physical Measurements Location` string, `Biospecimens Location` string",
    )
    df.write.parquet(f"{tmp_path}/snapshot=20180319")
    got = read.read_workqueue(spark, str(tmp_path), "20180319")
    assert got.columns == [
        "pmi_id", "first_name", "last_name", "birth_date", "physical_measurements_location", "biospecimens_location",
    ]
    assert got.first()[4:] == ("", "")


def test_workqueue_of_a_date(spark, tmp_path):
    base = str(tmp_path)
    for day in ("20180212", "20180319", "20180402"):
        plain = spark.createDataFrame([(day, "")], "pmi_id string, physical_measurements_location string")
        plain = plain.withColumn("biospecimens_location", F.lit(""))
        plain.write.parquet(f"{base}/snapshot={day}")
    ask = lambda **x: read.read_workqueue(spark, base, **x)
    assert read.snapshots(spark, base) == ["20180212", "20180319", "20180402"]
    for day, got in {
        "20180212": ask(snapshot="20180212"),
        "20180319": ask(as_of="20180401"),
        "20180402": ask(),
    }.items():
        assert rows(got, "pmi_id") == [(day,)]
        assert all(f"snapshot={day}" in f for f in got.inputFiles())
    with pytest.raises(ValueError, match="no snapshot up to"):
        ask(as_of="20180101")


def test_versions_are_never_overwritten(spark, tmp_path):
    base = str(tmp_path / "roster")
    write.write_version(spark.range(3), base, "1")
    with pytest.raises(Exception, match="(?i)exists"):
        write.write_version(spark.range(5), base, "1")
    write.write_version(spark.range(5), base, "2")
    assert read_count(spark, base, "1") == 3 and read_count(spark, base, "2") == 5


def read_count(spark, base, version):
    return write.read_version(spark, base, version).count()


def test_append(spark, tmp_path):
    path = str(tmp_path / "t")
    write.append(spark.range(3), path)
    write.append(spark.range(2), path)
    assert read.load_tables(spark, ["t"], str(tmp_path))["t"].count() == 5
    write.append_table(spark.range(3).select(F.lit("x").alias("a"), F.col("id").alias("b")), "appended")
    write.append_table(spark.range(2).select(F.col("id").alias("b"), F.lit("y").alias("a")), "appended")
    assert rows(read.load_tables(spark, ["appended"], namespace="default")["appended"], "a", "b") == [
        ("x", 0), ("x", 1), ("x", 2), ("y", 0), ("y", 1),
    ]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_registry_layout_prunes_by_type(spark, tmp_path):
    ids = identifiers(spark, (1, 1, "m", C.id_type_mrn, 0), (1, 1, "P1", C.id_type_participant, 0))
    path = write.write_registry(ids, str(tmp_path / "ids"), "1")
    back = spark.read.parquet(path)
    found = registry.of_type(back, C.id_type_participant).select("identifier")
    assert rows(found) == [("P1",)]
    assert f"PartitionFilters: [isnotnull(id_type_concept_id" in plan(found)
    assert rows(back.select(*ids.columns)) == rows(ids)


def test_bucketed_tables_join_without_shuffle(spark):
    people = spark.range(100).select(F.col("id").alias("master_id"), F.lit("x").alias("first_name"))
    contacts = spark.range(200).select((F.col("id") % 100).alias("master_id"), F.lit("1").alias("value"))
    write.save_bucketed(people, "people_by_id", "master_id", 4)
    write.save_bucketed(contacts, "contacts_by_id", "master_id", 4)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table("people_by_id").join(spark.table("contacts_by_id"), "master_id")
        assert "Exchange" not in plan(joined)
        assert joined.count() == 200
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
