"""A file that fails again and again holds up none of the others."""

import json

from sightline.plans.intake import MAX_ATTEMPTS
from sightline.plans.store import Store
from sightline.streaming.intake import start, supervise


def test_poison_is_parked(spark, tmp_path):
    land = tmp_path / "in"
    land.mkdir()
    good = {"schema_version": "1.0", "source": "feed-a", "collected_at": "2025-01-02T03:04:05Z", "records": [{"kind": "indicator", "indicator": {"type": "auto", "raw_value": "mal.example"}}]}
    write = lambda name, source, **more: (land / name).write_text(json.dumps(good | {"source": source} | more))
    write("1.json", "feed-a")
    write("2.json", "feed-b", source_run_id="\ud800")  # JSON, but no text: the decoder's result can't be sent
    write("3.json", "feed-c")
    store = Store(spark, f"file://{tmp_path}/store")
    begin = lambda: start(spark, str(land), store, str(tmp_path / "check"), available_now=True)
    assert supervise(begin, most=1) == 1
    assert {r["source"] for r in store.read("envelope_log").collect()} == {"feed-a", "feed-c"} and list(store.attempts.values()) == [1]
    write("4.json", "feed-d")
    assert supervise(begin, most=20, wait=lambda _: None) == MAX_ATTEMPTS
    assert sorted(r["source"] for r in store.read("envelope_log").collect()) == ["feed-a", "feed-c", "feed-d"] and store.attempts == {}
    parked = store.read("dead_letter").collect()
    assert [(r["source_slug"], r["stage"], r["message_id"].rsplit("/", 1)[1]) for r in parked] == [("feed-b", "poison", "2.json")]


def test_what_cannot_be_parked_whole_is_parked_bare(spark, tmp_path, monkeypatch):
    from sightline.streaming import intake

    land = tmp_path / "in"
    land.mkdir()
    (land / "1.json").write_text("{}")
    store = Store(spark, f"file://{tmp_path}/store")

    def fail(*_, **__):
        raise OSError("no such disk")

    monkeypatch.setattr(intake, "process", fail)
    begin = lambda: start(spark, str(land), store, str(tmp_path / "check"), available_now=True)
    assert supervise(begin, most=20, wait=lambda _: None) == MAX_ATTEMPTS + 1 and store.attempts == {}
    assert [(r["stage"], r["payload"], "no such disk" in r["reason"]) for r in store.read("dead_letter").collect()] == [("poison", '""', True)]


def test_errors_of_the_surroundings_count_for_no_file(spark, tmp_path, monkeypatch):
    from sightline.streaming import intake

    land = tmp_path / "in"
    land.mkdir()
    (land / "1.json").write_text("{}")
    store = Store(spark, f"file://{tmp_path}/store")
    calls = []

    def fail(*_, **__):
        calls.append(1)
        raise RuntimeError("java.net.ConnectException: refused") if len(calls) % 2 else ConnectionError("down")

    monkeypatch.setattr(intake, "process", fail)
    begin = lambda: start(spark, str(land), store, str(tmp_path / "check"), available_now=True)
    assert supervise(begin, most=4, wait=lambda _: None) == 4 and len(calls) == 4
    assert store.attempts == {} and store.batches == []
