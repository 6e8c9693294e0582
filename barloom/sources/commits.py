"""Stored tables that several writers replace part by part, each change in one commit.

The rows of a table are Parquet files in parts (months, if not said otherwise). A commit is a small file that lists the
folder of each part; readers take the latest. A writer writes the parts it changes to folders of its own and then claims
the next version: only one writer can create that file. A writer that lost looks at what the winner changed: other parts,
and it claims the version after that; one of its own parts, and its result rests on rows that are gone, so it
raises `CommitConflict` (`commit`) or computes anew from the latest version (`update`). What a lost writer leaves behind is
in no version. Parts that a change does not touch are neither read nor written.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.operators import state
from barloom.sources import storage


class CommitConflict(RuntimeError):
    """Another writer changed the same parts after they were read."""


@dataclass(frozen=True)
class Version:
    number: int
    parts: dict[str, str]
    schema: T.StructType | None
    touched: tuple[str, ...] = ()


def month() -> Column:
    """The part of a row by its session; rows without one share a part."""
    return F.coalesce(F.date_format("time", "yyyy-MM"), F.lit("none"))


class CommittedTable:
    def __init__(self, spark: SparkSession, path: str, part: Callable[[], Column] = month):
        self.spark, self.path, self.part = spark, path.rstrip("/"), part

    def version(self, number: int | None = None) -> Version:
        """A version, by default the latest; version 0 is the empty table before the first commit."""
        if number is None:
            number = max((int(n.removesuffix(".json")) for n in storage.names(self.spark, f"{self.path}/commits/*.json")), default=0)
        if number == 0:
            return Version(0, {}, None)
        found = json.loads(storage.read_text(self.spark, self._commit_file(number)))
        return Version(number, found["parts"], T.StructType.fromJson(found["schema"]), tuple(found["touched"]))

    def _commit_file(self, number: int) -> str:
        return f"{self.path}/commits/{number:012d}.json"

    def read(self, version: Version | None = None, parts: set[str] | None = None) -> DataFrame:
        """The rows of a version, or those of some of its parts."""
        v = version or self.version()
        if v.schema is None:
            raise ValueError(f"nothing was committed to {self.path}")
        folders = [folder for part, folder in sorted(v.parts.items()) if parts is None or part in parts]
        return self.spark.read.schema(v.schema).parquet(*folders) if folders else self.spark.createDataFrame([], v.schema)

    def parts_of(self, df: DataFrame) -> set[str]:
        """The parts that rows fall into: one row a part comes to the driver."""
        return {r[0] for r in df.select(self.part().alias("part")).distinct().collect()}

    def commit(self, df: DataFrame, parts: set[str] | None, base: Version) -> Version:
        """Puts `df`, computed from version `base`, in the place of `parts` (None: of the whole table). Rows of other parts
        in `df` are an error, for they would be lost or doubled."""
        out = f"{self.path}/data/{uuid.uuid4().hex}"
        df.withColumn("_part", self.part()).write.partitionBy("_part").parquet(out)
        new = {storage.part_value(n): f"{out}/{n}" for n in storage.names(self.spark, f"{out}/_part=*")}
        if parts is not None and not set(new) <= parts:
            storage.remove(self.spark, out)
            raise ValueError(f"rows outside of the parts to be replaced: {sorted(set(new) - parts)[:5]}")
        schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema])
        while True:
            latest = self.version()
            self._must_not_meet(base, latest.number, parts, out)
            touched = set(latest.parts) | set(new) if parts is None else parts
            kept = {p: folder for p, folder in latest.parts.items() if p not in touched}
            if kept and latest.schema != schema:
                storage.remove(self.spark, out)
                raise ValueError("the columns of a part must be those of the table")
            number = latest.number + 1
            text = json.dumps({"touched": sorted(touched), "parts": kept | new, "schema": json.loads(schema.json())})
            if storage.claim(self.spark, self._commit_file(number), text):
                return Version(number, kept | new, schema, tuple(sorted(touched)))

    def _must_not_meet(self, base: Version, latest: int, parts: set[str] | None, out: str) -> None:
        for number in range(base.number + 1, latest + 1):
            theirs = set(self.version(number).touched)
            if parts is None or theirs & parts:
                storage.remove(self.spark, out)
                raise CommitConflict(f"version {number} of {self.path} changed the same parts")

    def update(self, change: Callable[[DataFrame], DataFrame], parts: set[str] | None, tries: int = 5) -> Version:
        """Replaces the rows of `parts` by change(those rows), from the latest version again where another writer was first."""
        for left in reversed(range(tries)):
            base = self.version()
            try:
                return self.commit(change(self.read(base, parts)), parts, base)
            except CommitConflict:
                if not left:
                    raise
        raise ValueError("at least one try")

    def replace(self, df: DataFrame) -> Version:
        """Makes `df` the whole table; it may have been read from it."""
        return self.commit(df, None, self.version())

    def upsert(self, new: DataFrame, keys: list[str]) -> Version:
        """Puts the rows of `new` in the place of those with their keys. The keys must determine the part."""
        if self.version().schema is None:
            return self.commit(state.checked_keys(new, keys), self.parts_of(new), self.version())
        return self.update(lambda old: state.upsert(old, new, keys), self.parts_of(new))

    def append_steps(self, step: Callable[[DataFrame], DataFrame], keys: list[str], tries: int = 5) -> Version:
        """Commits step(stored rows) by its keys. The step reads the whole table but only the parts of its rows are
        rewritten; where another writer was first with one of these, the step is taken again from what that one stored."""
        for left in reversed(range(tries)):
            base = self.version()
            held = f"{self.path}/data/{uuid.uuid4().hex}"  # the step runs once, what it gives is read twice
            step(self.read(base)).write.parquet(held)
            new = self.spark.read.schema(base.schema).parquet(held)
            parts = self.parts_of(new)
            try:
                return self.commit(state.upsert(self.read(base, parts), new, keys), parts, base) if parts else base
            except CommitConflict:
                if not left:
                    raise
            finally:
                storage.remove(self.spark, held)
        raise ValueError("at least one try")

    def replace_scope(self, new: DataFrame, scope: Column) -> Version:
        """Deletes the rows of a scope and appends `new`, in one commit. Only parts that hold either are rewritten."""
        held = self.parts_of(self.read().filter(state.truth(scope)))
        return self.update(lambda old: state.scoped_replace(old, new, scope), held | self.parts_of(new))

    def expire(self, keep: int = 10) -> int:
        """Removes commits before the last `keep` ones and data that no kept one lists; returns how many data folders went.
        Not to be run beside writers: what they have written and not yet committed is in no version."""
        latest = self.version().number
        first = max(1, latest - keep + 1)
        used = {folder.rpartition("/_part=")[0].rpartition("/")[2] for n in range(first, latest + 1) for folder in self.version(n).parts.values()}
        gone = [n for n in storage.names(self.spark, f"{self.path}/data/*") if n not in used]
        for name in storage.names(self.spark, f"{self.path}/commits/*.json"):
            if int(name.removesuffix(".json")) < first:
                storage.remove(self.spark, f"{self.path}/commits/{name}")
        for name in gone:
            storage.remove(self.spark, f"{self.path}/data/{name}")
        return len(gone)
