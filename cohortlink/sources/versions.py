"""Versions of a table in hash buckets, of which a merge rewrites only those whose rows change.

A table is a folder with ``data/<version>``, files in partition folders of
(part, bucket), and ``versions/<version>``, a manifest that says for each
(part, bucket) in which version's data it lies. A new version's manifest links
untouched buckets to the data of the version that wrote them. A version exists
once its manifest does; versions are never changed.

The manifest has one entry per part and bucket, whatever the rows; parts are the
few values of a column such as the identifier type.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import match_key
from . import files

PART, BUCKET = "_part", "_bucket"
# In place of a null part, which no folder name can tell from the text.
NO_PART = "-"

Place = tuple[str, int]


@dataclass(frozen=True)
class Change:
    """What a merge did: buckets whose rows changed, buckets read to find out, all buckets."""

    changed: frozenset[Place]
    read: frozenset[Place]
    total: int


class BucketedVersions:
    """A versioned table. ``key`` is compared like all keys, without regard to case and trailing blanks."""

    def __init__(self, spark: SparkSession, base: str, key: str, buckets: int = 64, part: str | None = None):
        self.spark, self.base, self.key, self.buckets, self.part = spark, base.rstrip("/"), key, buckets, part

    def _placed(self, rows: DataFrame) -> DataFrame:
        part = F.coalesce(F.col(self.part).cast("string"), F.lit(NO_PART)) if self.part else F.lit(NO_PART)
        hashed = F.xxhash64(match_key(F.col(self.key).cast("string")))
        return rows.withColumns({PART: part, BUCKET: F.pmod(hashed, F.lit(self.buckets)).cast("int")})

    def versions(self) -> list[str]:
        return files.names(self.spark, f"{self.base}/versions")

    def _manifest(self, version: str) -> dict:
        text = files.text_of(self.spark, f"{self.base}/versions/{version}")
        if text is None:
            raise ValueError(f"{self.base} has no version {version}")
        manifest = json.loads(text)
        if (manifest["key"], manifest["buckets"], manifest["part"]) != (self.key, self.buckets, self.part):
            raise ValueError(f"{self.base} has other buckets: {manifest['buckets']} by {manifest['part']}, {manifest['key']}")
        return manifest

    def places(self, version: str) -> dict[Place, str]:
        """Where each bucket of a version lies, below the base folder."""
        return {(part, bucket): path for part, bucket, path in self._manifest(version)["places"]}

    def _write(self, placed: DataFrame, version: str) -> dict[Place, str]:
        """Write the rows as the new data of a version; returns its buckets."""
        path = f"{self.base}/data/{version}"
        # AQE splits a bucket that a hot key has made large over several files
        balanced = placed.hint("rebalance", F.col(PART), F.col(BUCKET))
        balanced.write.mode("errorifexists").partitionBy(PART, BUCKET).parquet(path)
        found = {}
        for part in files.names(self.spark, path):
            if part.startswith(f"{PART}="):
                for bucket in files.names(self.spark, f"{path}/{part}"):
                    place = (part.partition("=")[2], int(bucket.partition("=")[2]))
                    found[place] = f"data/{version}/{part}/{bucket}"
        return found

    def _commit(self, version: str, places: dict[Place, str], schema: T.StructType) -> None:
        manifest = {
            "key": self.key,
            "buckets": self.buckets,
            "part": self.part,
            "schema": schema.json(),
            "places": [[part, bucket, path] for (part, bucket), path in sorted(places.items())],
        }
        if not files.create(self.spark, f"{self.base}/versions/{version}", json.dumps(manifest)):
            raise ValueError(f"{self.base} has a version {version} already")

    def create(self, rows: DataFrame, version: str) -> None:
        """Write a whole table as a version."""
        self._commit(version, self._write(self._placed(rows), version), rows.schema)

    def read(self, version: str, places: Iterable[Place] | None = None) -> DataFrame:
        """A version's rows, or those of some of its buckets."""
        manifest = self._manifest(version)
        schema = T.StructType.fromJson(json.loads(manifest["schema"]))
        there = self.places(version)
        paths = [f"{self.base}/{there[p]}" for p in (there if places is None else sorted(set(places) & set(there)))]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def merge(
        self,
        source: DataFrame,
        old: str,
        new: str,
        merge: Callable[[DataFrame, DataFrame], DataFrame],
        keep: Callable[[DataFrame, str], DataFrame],
        every: bool = False,
        parts: Iterable[object] | None = None,
    ) -> Change:
        """Write version ``new``: ``old`` with ``source`` merged in.

        ``merge(target, source)`` returns the target's columns and an ``action``
        (``operators.merge.snapshot_merge(...).rows``) and must treat every key
        by itself. It gets only the buckets in which ``source`` has keys, or
        all buckets with ``every``, as a merge that deletes what the source
        lacks needs them. ``parts`` are the only ones that the merge can change. Buckets
        without an insert, update or delete keep their files. ``keep`` writes an
        intermediate table (``plans.stages.Run.table``).
        """
        there = self.places(old)
        wanted = None if parts is None else {NO_PART if p is None else str(p) for p in parts}
        reach = {p for p in there if wanted is None or p[0] in wanted}
        if not every:
            asked = {r[0] for r in self._placed(source).select(BUCKET).distinct().collect()}
            reach = {p for p in reach if p[1] in asked}
        target = self.read(old, reach)
        merged = keep(self._placed(merge(target, source)), "merged")
        acts = merged.where(F.col("action") != "KEEP").select(PART, BUCKET).distinct()
        changed = {(r[0], r[1]) for r in acts.collect()}
        places = {p: path for p, path in there.items() if p not in changed}
        if changed:
            rows = merged.where((F.col("action") != "DELETE") & _within(changed)).select(*target.columns, PART, BUCKET)
            places |= self._write(rows, new)
        self._commit(new, places, target.schema)
        return Change(frozenset(changed), frozenset(reach), len(there))


def _within(places: set[Place]) -> Column:
    by_part: dict[str, list[int]] = {}
    for part, bucket in sorted(places):
        by_part.setdefault(part, []).append(bucket)
    out = F.lit(False)
    for part, buckets in by_part.items():
        out = out | ((F.col(PART) == part) & F.col(BUCKET).isin(buckets))
    return out
