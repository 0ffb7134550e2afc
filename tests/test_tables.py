"""Tables in batches, versions, declared types and stated order."""

import pytest
from pyspark.sql import functions as F

from cohortlink.operators.merge import snapshot_merge
from cohortlink.plans.stages import Run
from cohortlink.sources import batches, files, ordered, typed
from cohortlink.sources.versions import BucketedVersions

from .conftest import rows


@pytest.fixture(scope="module")
def run(spark):
    with Run(spark) as run:
        yield run


# --- batches


def test_a_retried_append_adds_nothing(spark, run):
    base, df = run.path("t"), spark.range(10)
    assert batches.append_batch(df, base, "a") and not batches.append_batch(df, base, "a")
    assert batches.append_batch(spark.range(10, 12), base, "b")
    assert rows(batches.read_batches(spark, base, df.schema)) == [(i,) for i in range(12)]


def test_an_append_that_died_is_not_read(spark, run):
    base, df = run.path("t"), spark.range(3)
    df.write.parquet(f"{base}/data/dead")  # written, never committed
    fs, place = files.located(spark, f"{base}/commits/a")
    fs.create(place).close()  # commit begun, never finished
    assert batches.read_batches(spark, base, df.schema).count() == 0
    assert batches.append_batch(df, base, "a")
    assert batches.read_batches(spark, base, df.schema).count() == 3
    assert batches.vacuum(spark, base) == 1 and files.names(spark, f"{base}/data") == list(batches.committed(spark, base).values())


def test_the_slower_of_two_writers_leaves_nothing(spark, run, monkeypatch):
    base, df = run.path("t"), spark.range(3)
    first = files.text_of
    monkeypatch.setattr(files, "text_of", lambda spark, path: None if path.endswith("/a") else first(spark, path))
    assert batches.append_batch(df, base, "a")
    monkeypatch.setattr(files, "exists", lambda spark, path: False)
    assert not batches.append_batch(df, base, "a")
    monkeypatch.undo()
    assert batches.read_batches(spark, base, df.schema).count() == 3
    assert len(files.names(spark, f"{base}/data")) == 1


def test_an_empty_batched_table_and_bad_names(spark, run):
    df = spark.range(2)
    assert batches.read_batches(spark, run.path("t"), df.schema).schema == df.schema
    for name in ("", "a/b", ".a"):
        with pytest.raises(ValueError):
            batches.append_batch(df, run.path("t"), name)


# --- versions

SCHEMA = "k string, part int, v int, w string"


def merged(target, source, **options):
    return snapshot_merge(target, source, "k", ["v"], **options).rows


def table(spark, run, data, part="part"):
    out = BucketedVersions(spark, run.path("v"), "k", 8, part)
    out.create(spark.createDataFrame(data, SCHEMA), "1")
    return out


def test_a_merge_rewrites_only_buckets_that_change(spark, run):
    data = [(f"K{i}", i % 3, i, "x") for i in range(200)] + [(None, 1, 5, "null key"), ("same", None, 1, "null part")]
    versions = table(spark, run, data)
    source = spark.createDataFrame([("k7 ", 1, 700, "y"), ("new", 1, 1, "z")], SCHEMA)
    change = versions.merge(source, "1", "2", merged, run.table, parts=[1])
    # k7 of part 1 is updated, new is inserted; other parts and buckets keep their files
    whole = merged(versions.read("1").where("part = 1"), source).where("action <> 'DELETE'").drop("action")
    others = versions.read("1").where("part is null or part <> 1")
    assert rows(versions.read("2")) == rows(whole.unionByName(others))
    assert 1 <= len(change.changed) <= 2 and change.changed <= change.read and len(change.read) <= 2
    old, new = versions.places("1"), versions.places("2")
    assert {p for p in new if new[p] != old.get(p)} == change.changed
    assert all(path.startswith("data/1/") for p, path in new.items() if p not in change.changed)
    assert rows(versions.read("1")) == rows(spark.createDataFrame(data, SCHEMA))


def test_a_merge_without_changes_writes_no_data(spark, run):
    versions = table(spark, run, [(f"K{i}", 0, i, "x") for i in range(50)])
    source = spark.createDataFrame([("K1", 0, 9, "y")], SCHEMA)
    change = versions.merge(
        source, "1", "2", lambda t, s: merged(t, s, update_when=F.col("v") < 0), run.table
    )
    assert not change.changed and len(change.read) == 1
    assert versions.places("1") == versions.places("2")


def test_a_merge_that_deletes_reads_every_bucket(spark, run):
    versions = table(spark, run, [(f"K{i}", 0, i, "x") for i in range(50)], part=None)
    source = spark.createDataFrame([("K1", 0, 9, "y"), ("K77", 0, 9, "y")], SCHEMA)
    change = versions.merge(
        source, "1", "2", lambda t, s: merged(t, s, delete_missing=True), run.table, every=True
    )
    assert rows(versions.read("2"), "k", "v", "w") == [("K1", 9, "x"), ("K77", 9, "y")]
    assert set(versions.places("2")) <= change.changed and versions.versions() == ["1", "2"]


def test_versions_are_made_once_and_known_by_their_buckets(spark, run):
    versions = table(spark, run, [("a", 0, 1, "x")])
    with pytest.raises(Exception, match="(?i)exist|already"):
        versions.create(spark.createDataFrame([("a", 0, 1, "x")], SCHEMA), "1")
    with pytest.raises(ValueError, match="no version"):
        versions.read("9")
    with pytest.raises(ValueError, match="other buckets"):
        BucketedVersions(spark, versions.base, "k", 16, "part").read("1")
    empty = BucketedVersions(spark, run.path("v"), "k", 8)
    empty.create(spark.createDataFrame([], SCHEMA), "1")
    assert empty.read("1").count() == 0
    empty.merge(spark.createDataFrame([("a", 0, 1, "x")], SCHEMA), "1", "2", merged, run.table)
    assert rows(empty.read("2")) == [("a", 0, 1, "x")]


def test_missing_rows_are_marked(spark):
    target = spark.createDataFrame([("a", 1, 1, None), ("b", 1, 2, None), (None, 1, 3, None)], SCHEMA)
    source = spark.createDataFrame([("a", 1, 9, "s")], SCHEMA)
    got = snapshot_merge(target, source, "k", ["v"], audit=["k"], mark_missing={"w": F.lit("gone")})
    assert rows(got.snapshot) == [(None, 1, 3, "gone"), ("a", 1, 9, None), ("b", 1, 2, "gone")]
    assert rows(got.changes, "action") == [("UPDATE",)] * 3


# --- declared types


def test_published_rows_fit_their_declared_types(spark, run):
    columns = typed.Declared((("person_id", "bigint"), ("email", "varchar(5)"), ("kind", "varchar(3)")))
    df = spark.createDataFrame(
        [(1, "abcde", "x", 0), (2, "abcdef", "long", 0), (3, "abcde   ", None, 0), (None, None, "long", 0)],
        "person_id bigint, email string, kind string, other int",
    )
    name, bad = run.catalog_name("published"), run.path("bad")
    typed.publish(df, name, columns, bad, run.path("published"))
    assert columns.of(spark, name) == columns.columns
    assert rows(spark.table(name)) == [(1, "abcde", "x"), (3, "abcde", None)]
    assert rows(typed.rejected(spark, bad)) == [(None, None, "long", ["kind"]), (2, "abcdef", "long", ["email", "kind"])]
    with pytest.raises(Exception, match="(?i)exceed|length"):
        spark.sql(f"insert into {name} values (1, 'abcdef', 'x')")


def test_publish_needs_all_columns(spark, run):
    with pytest.raises(ValueError, match="person_id"):
        typed.publish(spark.range(1), "nowhere", typed.PUBLISHED["pii_email"], run.path("bad"))


# --- order


def test_ordered_files(spark, run):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("a"), F.when(F.col("id") % 3 == 0, "x").alias("b"))
    path = run.path("ordered")
    ordered.write_ordered(df, path, ["b", "a"])
    assert ordered.order_breaks(spark, path, df.schema, ["b", "a"]) == 0
    got = [tuple(r)[:2] for r in ordered.read_with_positions(spark, path, df.schema).orderBy("position").collect()]
    assert got == sorted(map(tuple, df.collect()), key=lambda r: (r[1] is not None, r[1] or "", r[0]))
    other = run.path("unordered")
    df.repartition(3).write.parquet(other)
    assert ordered.order_breaks(spark, other, df.schema, ["b", "a"]) > 0


def test_order_breaks_between_files(spark, run):
    path = run.path("files")
    df = spark.range(0, 40, 1, 4)
    df.write.parquet(path)
    assert ordered.order_breaks(spark, path, df.schema, ["id"]) == 0
    back = run.path("files")
    df.repartitionByRange(4, F.desc("id")).sortWithinPartitions("id").write.parquet(back)
    assert ordered.order_breaks(spark, back, df.schema, ["id"]) == 3


def test_nothing_to_order(spark, run):
    df = spark.range(0)
    path = run.path("none")
    ordered.write_ordered(df, path, ["id"])
    assert ordered.order_breaks(spark, path, df.schema, ["id"]) == 0
    assert ordered.read_with_positions(spark, path, df.schema).collect() == []
