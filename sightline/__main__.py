"""Commands: python -m sightline validate|load|submit|serve|maintain|migrate|alerts|lookup|source ... Results are JSON, one a line.

What isn't given is taken from the environment: SIGHTLINE_STORE, SIGHTLINE_LANDING, SIGHTLINE_MAX_DROP_RATIO,
SIGHTLINE_FILES_A_BATCH, SIGHTLINE_TTL_DAYS.

The exit code is 0 if nothing was refused, 1 if something was, 2 for a wrong call.
"""

from __future__ import annotations

import argparse
import json
import logging
import os
import sys
from collections.abc import Mapping
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sightline import api
from sightline.functions.scalar import observable, slugify
from sightline.operators import alerts, lookup
from sightline.plans.schemas import TLP, VERSION
from sightline.plans.store import Store
from sightline.sources import registry
from sightline.streaming import intake


log = logging.getLogger(__name__)


def parser(env: Mapping[str, str]) -> argparse.ArgumentParser:
    config = api.Config.of(env)
    wrong = [p for p in config.problems if not p.endswith("is required")]
    if wrong:
        raise SystemExit("; ".join(wrong))
    store = {"default": config.store or None, "required": not config.store}
    landing = {"default": config.landing or None, "required": not config.landing}
    top = argparse.ArgumentParser(prog="sightline", description=__doc__.splitlines()[0])
    command = top.add_subparsers(dest="command", required=True)
    add = command.add_parser
    one = add("validate", help="report what is wrong with files")
    one.add_argument("path")
    one = add("load", help="take in files")
    one.add_argument("path")
    one.add_argument("--store", **store)
    one.add_argument("--batch", help="a name: the same batch is taken in once")
    one.add_argument("--known-sources", action="store_true", help="park what comes from a source that isn't registered and enabled")
    one.add_argument("--max-drop-ratio", type=float, default=config.max_drop_ratio)
    one = add("submit", help="validate a file and place it into the landing folder")
    one.add_argument("path")
    one.add_argument("--landing", **landing)
    one = add("serve", help="take in what arrives in the landing folder")
    one.add_argument("--store", **store)
    one.add_argument("--landing", **landing)
    one.add_argument("--checkpoint", required=True)
    one.add_argument("--files-a-batch", type=int, default=config.files_a_batch)
    one.add_argument("--known-sources", action="store_true")
    one.add_argument("--once", action="store_true", help="stop when all is taken in")
    one = add("maintain", help="retention and compaction")
    one.add_argument("--store", **store)
    one.add_argument("--retain-from", help="YYYY-MM-DD: drop months that end by then")
    one.add_argument("--dry-run", action="store_true")
    one.add_argument("--compact", action="store_true")
    one.add_argument("--ttl-days", type=int, default=config.ttl_days, help="with --compact: forget values that were not reported for so long")
    one.add_argument("--ahead", type=int, default=0, help="name this month and as many after it; their folders come with the first row")
    one = add("migrate", help="bring a store of an older version up")
    one.add_argument("--store", **store)
    one.add_argument("--status", action="store_true", help="say what version it has and would get, and change nothing")
    one = add("alerts", help="what is wrong, by the counters of the store")
    one.add_argument("--store", **store)
    one = add("lookup", help="what is known of a value")
    one.add_argument("value")
    one.add_argument("--type", default="auto")
    one.add_argument("--ttl-days", type=int, default=config.ttl_days, help="forget what was not reported for so long")
    one.add_argument("--store", **store)
    one = add("source", help="the registry of sources")
    one.add_argument("action", choices=("list", "add", "enable", "disable"))
    one.add_argument("slug", nargs="?")
    one.add_argument("--store", **store)
    one.add_argument("--name")
    one.add_argument("--url")
    one.add_argument("--tlp", default="clear", choices=TLP)
    return top


def shown(rows: DataFrame) -> int:
    lines = rows.toJSON().collect()
    print(*lines, sep="\n") if lines else None
    return len(lines)


def main(args: list[str], spark: SparkSession | None = None) -> int:
    call = parser(os.environ).parse_args(args)
    spark = spark or SparkSession.builder.appName("sightline").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if call.command == "validate":
        rows = api.validate(spark, call.path)
        shown(rows)
        return int(rows.where("not ok").count() > 0)
    if call.command == "submit":
        rows = api.submit(spark, call.path, call.landing)
        shown(rows)
        return int(rows.where("not ok").count() > 0)
    if call.command == "migrate":
        old = Store(spark, call.store, migrating=True)
        print(json.dumps({"version": old.version, "known": VERSION} if call.status else {"versions": old.migrate()}))
        return 0
    store = Store(spark, call.store)
    if call.command == "alerts":
        return int(shown(alerts.all_of(store.read("metrics_log"))) > 0)
    if call.command == "load":
        done = api.load(spark, call.path, store, call.batch, sources=store.sources() if call.known_sources else None, max_drop_ratio=call.max_drop_ratio)
        print(json.dumps(done))
        return int(done["parked"] > 0)
    if call.command == "serve":
        log.info("taking in from %s into %s", *map(api.without_secrets, (call.landing, call.store)))
        begin = lambda: intake.start(spark, call.landing, store, call.checkpoint, store.sources if call.known_sources else None, files_a_batch=call.files_a_batch, available_now=call.once)
        intake.supervise(begin, most=1 if call.once else None)
        return 0
    if call.command == "maintain":
        done = api.maintain(store, call.retain_from, call.dry_run, call.compact, ttl_days=call.ttl_days)
        print(json.dumps(done | ({"ahead": api.months_ahead(datetime.now(UTC).date(), call.ahead)} if call.ahead else {})))
        return 0
    if call.command == "lookup":
        form = observable(call.type, call.value)
        return int(form is None or shown(lookup.alive(store.find(*form), F.current_timestamp(), call.ttl_days)) == 0)
    if call.action == "list":
        shown(registry.listing(store.sources()))
        return 0
    if not call.slug or slugify(call.slug) != call.slug:
        print("a slug in lower case is wanted", file=sys.stderr)
        return 2
    known = store.sources()
    if call.action == "add":
        new = spark.createDataFrame([(call.slug, call.name or call.slug, call.url, call.tlp, True)], "slug string, name string, url string, tlp string, enabled boolean")
        new = new.withColumn("id", F.sha2("slug", 256).substr(1, 32)).withColumn("created_at", F.current_timestamp())
        rows = registry.added(known, new)
    else:
        if known.where(F.col("slug") == call.slug).isEmpty():
            print("no such source", file=sys.stderr)
            return 1
        rows = registry.enabled(known, call.slug, call.action == "enable")
    store.save_sources(rows.select(known.columns))
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
