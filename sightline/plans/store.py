"""Tables on shared storage without a transaction manager.

A batch writes its rows to folders of its own, table/batch=<id>.<random>/, and is there once the manifest, which is
replaced by a rename, names it: readers see whole batches or none, and of two that write the same batch one counts.  A
table that is folded is what was last put together and the batches since.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sightline.operators import folds, lookup
from sightline.plans.schemas import LOOKUP_TTL_DAYS, MIGRATIONS, TABLES, VERSION
from sightline.session import ship

FOLDED = ("entity", "indicator", "cve", "breach", "relationship")
APPENDED = ("sighting", "envelope_log", "dead_letter", "metrics_log")
LEASE = 60.0  # seconds after which the claim of a writer that hasn't finished is void
VERDICT = "seq long, idx int, type string, value string, first_seen timestamp, last_seen timestamp, source string, tags array<string>, confidence double, refreshed_at timestamp"


def instant(text: str) -> datetime:
    """An ISO date or time, in UTC; without an offset it is one of UTC."""
    at = datetime.fromisoformat(text)
    return at.replace(tzinfo=UTC) if at.tzinfo is None else at.astimezone(UTC)


class Pending(RuntimeError):
    """The store is of an older version; `migrate` brings it up."""


class Store:
    def __init__(self, spark: SparkSession, root: str, migrating: bool = False):
        ship(spark)
        self.spark, self.root = spark, root.rstrip("/")
        found = self._manifest()["version"]
        if found > VERSION:
            raise RuntimeError(f"the store has version {found}; this build knows up to {VERSION}")
        if found < VERSION and not migrating:
            raise Pending(f"the store has version {found}; `migrate` brings it to {VERSION}")

    # files, by Hadoop's own interface: local, HDFS or object storage

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")

    def _fs(self):
        return self._path("").getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _latest(self) -> tuple[int, dict]:
        """The number of the newest manifest (-1: none) and what it says."""
        names = sorted(n for n in self._names("manifest") if n.endswith(".json"))
        if not names:
            return -1, {"version": VERSION, "batches": []}
        text = self.spark.read.text(f"{self.root}/manifest/{names[-1]}", wholetext=True).first()[0]
        return int(names[-1][:-5]), json.loads(text)

    def _manifest(self) -> dict:
        return self._latest()[1]

    def _names(self, folder: str) -> list[str]:
        fs, path = self._fs(), self._path(folder)
        return [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []

    def _update(self, change: Callable[[dict], dict | None], wait: Callable[[float], None] = time.sleep) -> bool:
        """Replace the manifest by what `change` makes of the newest; False if it makes nothing of it.

        A writer claims the next number by creating a file that isn't there, which one of several can do; the others
        begin anew from what it has published. A claim whose writer has died is void after LEASE seconds.
        """
        fs = self._fs()
        while True:
            number, manifest = self._latest()
            changed = change(manifest)
            if changed is None:
                return False
            claim, target = self._path(f"claims/{number + 1:012d}"), self._path(f"manifest/{number + 1:012d}.json")
            if not fs.createNewFile(claim):
                try:
                    old = time.time() - fs.getFileStatus(claim).getModificationTime() / 1000 > LEASE
                except Exception:  # it is done by now
                    continue
                fs.delete(claim, False) if old else wait(0.1)
                continue
            try:
                if fs.exists(target):
                    continue
                draft = self._path(f"drafts/{uuid.uuid4().hex}")
                out = fs.create(draft, True)
                out.write(bytearray(json.dumps(changed).encode()))
                out.close()
                fs.mkdirs(self._path("manifest"))
                if not fs.rename(draft, target):
                    raise RuntimeError("the manifest could not be replaced")
                return True
            finally:
                fs.delete(claim, False)

    @property
    def version(self) -> int:
        return self._manifest()["version"]

    def migrate(self) -> list[int]:
        """Bring an older store up, one version after the other; returns the versions that were made."""
        made: list[int] = []

        def step(manifest: dict) -> dict | None:
            if manifest["version"] >= VERSION:
                return None
            for version in range(manifest["version"] + 1, VERSION + 1):
                manifest = MIGRATIONS[version](manifest) | {"version": version}
                made.append(version)
            return manifest

        made.clear()
        self._update(step)
        return made

    # batches

    @property
    def batches(self) -> list[str]:
        return self._manifest()["batches"]

    def commit(self, batch: str, deltas: dict[str, DataFrame | Callable[[], DataFrame]]) -> bool:
        """Write a batch's rows, table by table in this order, then name it in the manifest. False if it is there already."""
        if not re.fullmatch(r"[0-9a-zA-Z_-]+", batch):
            raise ValueError("a batch is named by letters, digits, _ and -")
        if batch in self.batches:
            return False
        place = f"{batch}.{uuid.uuid4().hex}"  # its own, so that two that write the same batch don't meet
        for table, rows in deltas.items():
            out = (rows if isinstance(rows, DataFrame) else rows()).write.mode("overwrite")
            (out.partitionBy("month") if table == "sighting" else out).parquet(f"{self.root}/{table}/batch={place}")
        done = self._update(lambda m: None if batch in m["batches"] else m | {"batches": [*m["batches"], batch], "places": m.get("places", {}) | {batch: place}})
        for table in () if done else deltas:
            self._fs().delete(self._path(f"{table}/batch={place}"), True)
        return done

    @property
    def attempts(self) -> dict[str, int]:
        """How often each file that still waits has failed alone, by its digest."""
        return self._manifest().get("attempts", {})

    def count_attempt(self, digest: str) -> int:
        """One more failure of a file; returns how many there are."""
        self._update(lambda m: m | {"attempts": m.get("attempts", {}) | {digest: m.get("attempts", {}).get(digest, 0) + 1}})
        return self.attempts.get(digest, 1)

    def forget_attempts(self) -> None:
        """All files that waited are taken in or parked."""
        self._update(lambda m: m | {"attempts": {}} if m.get("attempts") else None)

    def delta(self, table: str, since: int = 0) -> DataFrame:
        """The rows of the named batches as they were written, with seq (arrival of the envelope) and idx; batches that
        were put together by `compact` as it wrote them. One listing, one read."""
        manifest = self._manifest()
        whole, count = manifest.get("compacted", {}).get(table, (None, 0)) if not since else (None, 0)
        places = manifest.get("places", {})
        names = [whole] * (whole is not None) + [places.get(b, b) for b in manifest["batches"][max(since, count) :]]
        held = set(self._names(table))
        paths = [f"{self.root}/{table}/batch={n}" for n in names if f"batch={n}" in held]
        place = {"envelope_log": ", seq long"} | dict.fromkeys(("indicator", "cve", "breach", "relationship"), ", seq long, idx int")
        schema = VERDICT if table == "lookup" else TABLES[table][0] + place.get(table, "")
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.option("basePath", f"{self.root}/{table}").schema(f"{schema}, batch string").parquet(*paths).drop("batch")

    def read(self, table: str) -> DataFrame:
        """The table as it is: folded by its laws."""
        if table == "lookup":
            return self.lookup()
        rows = self.delta(table)
        if table == "entity":
            return folds.fold(rows, ["entity_id", "kind", "canonical_key"], folds.LAWS["entity"])
        if table in ("indicator", "cve", "breach"):
            whole = folds.last_row(rows, ["entity_id", "seq"])
            return folds.fold(whole, ["entity_id"], folds.LAWS[table], "seq")
        if table == "relationship":
            return folds.fold_edges(rows, ["source_id", "target_id", "type"])
        return rows

    # the lookup projection: a stored state by buckets, and the batches since

    def lookup(self, where: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
        """The projection, or what `where` leaves of it: the stored state with what came since."""
        stored = self._manifest().get("lookup")
        part = where or (lambda df: df)
        new = part(self.delta("lookup", stored["count"] if stored else 0))
        if not stored:
            return lookup.fold_lookup(new)
        old = self.spark.read.schema(f"{TABLES['lookup'][0]}, bucket int").parquet(f"{self.root}/{stored['path']}")
        return lookup.merged(part(old), lookup.fold_lookup(new))

    def find(self, kind: str, value: str) -> DataFrame:
        """The row of one canonical value: one bucket of the stored state is read, and of the batches since the row groups
        that may hold the value. Nothing is folded but that value's rows."""

        def one(df: DataFrame) -> DataFrame:
            rows = lookup.find(df, kind, value)
            return rows.where(F.col("bucket") == lookup.bucket(F.lit(kind), F.lit(value))) if "bucket" in df.columns else rows

        return self.lookup(one)

    def refresh_lookup(self, now: Column, days: int = LOOKUP_TTL_DAYS) -> None:
        """Store the projection as it is now, without what was not refreshed for `days`; later reads begin from it."""
        stored, count = self._manifest().get("lookup"), len(self.batches)
        path = f"lookup-state/{uuid.uuid4().hex}"
        rows = lookup.alive(self.lookup(), now, days).withColumn("bucket", lookup.bucket(F.col("type"), F.col("value")))
        rows.repartition("bucket").sortWithinPartitions("bucket", "type", "value").write.partitionBy("bucket").parquet(f"{self.root}/{path}")
        if self._update(lambda m: m | {"lookup": {"path": path, "count": count}} if m.get("lookup") == stored else None) and stored:
            self._fs().delete(self._path(stored["path"]), True)

    @property
    def has_sources(self) -> bool:
        return self._manifest().get("sources") is not None

    def sources(self) -> DataFrame:
        """The registry of sources; empty if none was saved."""
        number = self._manifest().get("sources")
        schema = "id string, slug string, name string, url string, tlp string, enabled boolean, config string, last_run_at timestamp, created_at timestamp"
        return self.spark.createDataFrame([], schema) if number is None else self.spark.read.schema(schema).parquet(f"{self.root}/sources/{number}")

    def save_sources(self, rows: DataFrame) -> None:
        """Replace the registry: written anew, then named in the manifest."""
        name = uuid.uuid4().hex
        rows.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/sources/{name}")
        self._update(lambda m: m | {"sources": name})

    def compact(self, *tables: str) -> None:
        """Put all batches so far into one: tables that are folded in their folded form, others row by row, in fewer
        files. Later reads take it with what came since. The lookup has its own (`refresh_lookup`)."""
        count, done = len(self.batches), {}
        for table in tables or (*FOLDED, *APPENDED):
            if table not in (*FOLDED, *APPENDED):
                raise ValueError(f"{table} can't be compacted")
            name = f"compact-{uuid.uuid4().hex}"
            rows = self.read(table)
            if table in FOLDED and table != "entity":  # stands before all that comes later, behind all that came
                top = self.delta(table).agg(F.max("seq")).first()[0]
                rows = rows.withColumn("seq", F.lit(top).cast("long")).withColumn("idx", F.lit(0))
            if table == "sighting":  # by month and entity, so that a month's files are few and in order
                rows.repartition("month", F.pmod(F.xxhash64("entity_id"), F.lit(8))).sortWithinPartitions("month", "entity_id").write.partitionBy("month").parquet(f"{self.root}/{table}/batch={name}")
            else:
                rows.write.mode("overwrite").parquet(f"{self.root}/{table}/batch={name}")
            done[table] = (name, count)
        self._update(lambda m: m | {"compacted": m.get("compacted", {}) | done})

    def vacuum(self, hours: float = 24.0) -> int:
        """Delete what no reader needs any more and is older than `hours`: folders of batches that were put together, that
        failed or that came second, older states of the lookup, and all manifests but the newest. Returns how many."""
        number, manifest = self._latest()
        places, batches = manifest.get("places", {}), manifest["batches"]
        stored = manifest.get("lookup") or {"count": 0}
        before = time.time() - hours * 3600
        fs, gone = self._fs(), 0

        def drop(folder: str, keep: set[str]) -> int:
            path, n = self._path(folder), 0
            for s in fs.listStatus(path) if fs.exists(path) else ():
                if s.getPath().getName() not in keep and s.getModificationTime() / 1000 < before:
                    n += bool(fs.delete(s.getPath(), True))
            return n

        for table in TABLES:
            whole, count = manifest.get("compacted", {}).get(table, (None, 0))
            needed = batches[stored["count"] if table == "lookup" else count :]
            gone += drop(table, {f"batch={places.get(b, b)}" for b in needed} | {f"batch={whole}"})
        gone += drop("lookup-state", {stored.get("path", "").rpartition("/")[2]}) + drop("sources", {str(manifest.get("sources"))}) + drop("drafts", set())
        return gone + drop("manifest", {f"{number:012d}.json"})

    def sightings(self, start: str | None = None, end: str | None = None) -> DataFrame:
        """Sightings observed from `start` up to but not at `end`: only the months between are read."""
        rows = self.delta("sighting")
        if start:
            at = instant(start)
            rows = rows.where((F.col("observed_at") >= F.lit(at)) & (F.col("month") >= f"{at:%Y_%m}"))
        if end:
            at = instant(end)
            rows = rows.where((F.col("observed_at") < F.lit(at)) & (F.col("month") <= f"{at:%Y_%m}"))
        return rows

    def drop_months_before(self, cutoff: str, dry_run: bool = False) -> list[str]:
        """Retention: the months that end at or before `cutoff` (an ISO date or time) are removed whole; entities stay."""
        keep_from = f"{instant(cutoff):%Y_%m}"  # the month that the cutoff is in has its end after it
        months: set[str] = set()
        fs = self._fs()
        for batch in self._names("sighting"):
            for name in self._names(f"sighting/{batch}"):
                month = name.removeprefix("month=")
                if name.startswith("month=") and re.fullmatch(r"[0-9]{4}_[0-9]{2}", month) and month < keep_from:
                    months.add(month)
                    if not dry_run:
                        fs.delete(self._path(f"sighting/{batch}/{name}"), True)
        return sorted(months)
