"""The commands, from end to end."""

import json

import pytest

from sightline.__main__ import main
from sightline.plans.schemas import VERSION


def test_commands(spark, tmp_path, capsys):
    land, store = tmp_path / "in", f"file://{tmp_path}/store"
    land.mkdir()
    good = {"schema_version": "1.0", "source": "feed-a", "collected_at": "2025-01-02T03:04:05Z", "records": [{"kind": "indicator", "indicator": {"type": "auto", "raw_value": "mal[.]example"}}]}
    (land / "a.json").write_text(json.dumps(good))
    (land / "b.json").write_text(json.dumps(good | {"source": "feed-b"}))
    call = lambda *x: (main(list(x), spark), capsys.readouterr().out.splitlines())
    code, out = call("validate", str(land))
    assert code == 0 and [json.loads(x)["ok"] for x in out] == [True, True]
    assert call("source", "add", "feed-a", "--store", store)[0] == 0
    assert call("source", "add", "feed-b", "--store", store, "--tlp", "red", "--url", "https://b.example/")[0] == 0
    assert call("source", "disable", "feed-b", "--store", store)[0] == 0 and call("source", "enable", "feed-c", "--store", store)[0] == 1 and call("source", "add", "Not", "--store", store)[0] == 2
    assert [(json.loads(x)["slug"], json.loads(x)["enabled"]) for x in call("source", "list", "--store", store)[1]] == [("feed-a", True), ("feed-b", False)]
    code, out = call("load", str(land), "--store", store, "--batch", "one", "--known-sources")
    assert code == 1 and json.loads(out[-1]) == {"written": 1, "duplicate": 0, "parked": 1}
    code, out = call("lookup", "MAL(dot)example", "--store", store)
    assert code == 0 and json.loads(out[0])["sources"] == ["feed-a"]
    assert call("lookup", "mal.example", "--store", store, "--ttl-days", "0")[0] == 1
    assert call("lookup", "other.example", "--store", store)[0] == 1 and call("lookup", "no value", "--store", store)[0] == 1
    (land / "b.json").unlink()
    assert call("submit", str(land / "a.json"), "--landing", str(tmp_path / "landing"))[0] == 0
    assert call("serve", "--landing", str(tmp_path / "landing"), "--store", store, "--checkpoint", str(tmp_path / "check"), "--once")[0] == 0
    assert json.loads(call("maintain", "--store", store, "--retain-from", "2025-03-01", "--compact")[1][-1]) == {"dropped": ["2025_01"]}
    assert call("lookup", "mal.example", "--store", store)[0] == 0
    listed = json.loads(call("source", "list", "--store", store)[1][0])
    assert listed["slug"] == "feed-a" and listed["last_run_at"].startswith("2025-01-02T03:04:05")
    alerts = [json.loads(x) for x in call("alerts", "--store", store)[1]]
    assert {(x["alert"], x["source"]) for x in alerts} == {("dead_letters", "feed-b")}
    assert json.loads(call("migrate", "--store", store, "--status")[1][0]) == {"version": VERSION, "known": VERSION} and json.loads(call("migrate", "--store", store)[1][0]) == {"versions": []}
    assert len(json.loads(call("maintain", "--store", store, "--ahead", "2")[1][-1])["ahead"]) == 3
    with pytest.raises(SystemExit):
        main(["unknown"], spark)


def test_what_is_not_given_comes_from_the_environment(spark, tmp_path, capsys, monkeypatch):
    monkeypatch.setenv("SIGHTLINE_STORE", f"file://{tmp_path}/store")
    assert main(["source", "add", "feed-a"], spark) == 0 and main(["source", "list"], spark) == 0
    assert json.loads(capsys.readouterr().out.splitlines()[-1])["slug"] == "feed-a"
    monkeypatch.setenv("SIGHTLINE_MAX_DROP_RATIO", "7")
    monkeypatch.setenv("SIGHTLINE_TTL_DAYS", "x")
    with pytest.raises(SystemExit, match="MAX_DROP_RATIO.*TTL_DAYS"):  # all that is wrong
        main(["source", "list"], spark)


def test_standard_input(spark, capsys, monkeypatch):
    import io
    import sys

    monkeypatch.setattr(sys, "stdin", io.TextIOWrapper(io.BytesIO(b'{"schema_version": "1.0", "source": "feed-a", "records": []}')))
    assert main(["validate", "-"], spark) == 1
    report = json.loads(capsys.readouterr().out.splitlines()[-1])
    assert report["path"] == "-" and sorted(p.split(":")[0] for p in report["problems"]) == ["collected_at", "records"]
