"""Commands: validate, load, submit, maintain; each on folders of files."""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sightline.plans import intake
from sightline.plans.schemas import LOOKUP_TTL_DAYS, MAX_BODY, MAX_DROP_RATIO
from sightline.plans.store import Store
from sightline.session import files
from sightline.sources import envelopes


def validate(spark: SparkSession, path: str, now: Column | None = None) -> DataFrame:
    """A report on each file; nothing is written."""
    return intake.report(envelopes.read(spark, path), F.current_timestamp() if now is None else now)


def load(spark: SparkSession, path: str, store: Store, batch: str | None = None, now: Column | None = None, sources: DataFrame | None = None, max_drop_ratio: float = MAX_DROP_RATIO) -> dict[str, int]:
    """Take in files directly, as the stream would."""
    return intake.process(envelopes.read(spark, path), store, batch or uuid.uuid4().hex, F.current_timestamp() if now is None else now, sources, max_drop_ratio)


def submit(spark: SparkSession, path: str, landing: str, now: Column | None = None, most: int = MAX_BODY) -> DataFrame:
    """Validate one file and, if nothing is wrong with it, place it into the landing folder (shared storage of any
    kind), whole or not at all. A file of more than `most` bytes is refused unread; the report says so."""
    fs, source = files(spark, path)
    size = fs.getFileStatus(source).getLen()
    if size > most:
        refused = [(path, False, None, 0, 0, [f"too large: {size} bytes of at most {most}"])]
        return spark.createDataFrame(refused, "path string, ok boolean, source string, records int, relationships int, problems array<string>")
    found = validate(spark, path, now)
    first = found.first()
    if first is not None and first["ok"]:
        target_fs, target = files(spark, f"{landing.rstrip('/')}/{uuid.uuid4().hex}.json")
        _, draft = files(spark, f"{landing.rstrip('/')}/.{uuid.uuid4().hex}")  # names with a dot are not read
        hadoop = spark._jvm.org.apache.hadoop.fs
        hadoop.FileUtil.copy(fs, source, target_fs, draft, False, spark._jsc.hadoopConfiguration())
        if not target_fs.rename(draft, target):
            raise RuntimeError(f"{landing} can't be written")
    return found


def months_ahead(today: date, ahead: int) -> list[str]:
    """This month and the next ones, stepped from the first of the month, so that none is skipped at a long month's end."""
    first = today.year * 12 + today.month - 1
    return [f"{m // 12:04d}_{m % 12 + 1:02d}" for m in range(first, first + ahead + 1)]


def maintain(store: Store, retain_from: str | None = None, dry_run: bool = False, compact: bool = False, now: Column | None = None, ttl_days: int = LOOKUP_TTL_DAYS) -> dict[str, list[str]]:
    """Apply retention, put together what has come in, store the lookup projection anew, without what was not refreshed
    for `ttl_days`, and delete what was put together a day ago or before. Months need not be provided for ahead, as folders come with the first row."""
    if compact and not dry_run:
        store.compact()
        store.refresh_lookup(F.current_timestamp() if now is None else now, ttl_days)
        store.vacuum()
    return {"dropped": store.drop_months_before(retain_from, dry_run) if retain_from else []}


def without_secrets(url: str | None) -> str | None:
    """A URL with its password blotted out."""
    return None if url is None else re.sub(r"(://[^:/@]*):[^@/]*@", r"\1:***@", url)


@dataclass
class Config:
    """Settings from environment variables (SIGHTLINE_...); `problems` lists all that is wrong, not only the first."""

    store: str = ""
    landing: str = ""
    max_drop_ratio: float = MAX_DROP_RATIO
    files_a_batch: int = 1000
    ttl_days: int = 30
    problems: list[str] = field(default_factory=list)

    @classmethod
    def of(cls, env: Mapping[str, str]) -> Config:
        self = cls(store=env.get("SIGHTLINE_STORE", ""), landing=env.get("SIGHTLINE_LANDING", ""))
        self.problems += [f"SIGHTLINE_{x.upper()} is required" for x in ("store", "landing") if not getattr(self, x)]
        for name, kind, low, high in (("max_drop_ratio", float, 0, 1), ("files_a_batch", int, 1, 10**6), ("ttl_days", int, 1, 3650)):
            text = env.get(f"SIGHTLINE_{name.upper()}")
            if text is None:
                continue
            try:
                value = kind(text)
                if not low <= value <= high:
                    raise ValueError
                setattr(self, name, value)
            except ValueError:
                self.problems.append(f"SIGHTLINE_{name.upper()} must be a number from {low} to {high}")
        return self
