"""Files, editions and runs."""

import json
import os
import socket
import time

import pytest

from pressrun.plans import publish


def candidate(folder, body="x", edition="e1"):
    folder.mkdir(exist_ok=True)
    publish.write_text(folder / "digest.md", body)
    return publish.create_candidate(folder, ["digest.md"], edition)


def test_promotion_is_idempotent_and_editions_never_change(tmp_path):
    candidate(tmp_path / "w")
    publish.promote(tmp_path / "w", tmp_path)
    publish.promote(tmp_path / "w", tmp_path)
    assert publish.current(tmp_path)[0]["editionId"] == "e1"
    candidate(tmp_path / "v", "other")
    with pytest.raises(publish.PublishError):
        publish.promote(tmp_path / "v", tmp_path)
    assert (publish.current(tmp_path)[1] / "digest.md").read_text() == "x"
    candidate(tmp_path / "u", "new", "e2")
    publish.promote(tmp_path / "u", tmp_path)
    assert publish.current(tmp_path)[0]["editionId"] == "e2"


def test_changed_files_are_refused(tmp_path):
    candidate(tmp_path / "w")
    (tmp_path / "w" / "digest.md").write_text("tampered")
    with pytest.raises(publish.PublishError):
        publish.promote(tmp_path / "w", tmp_path)
    assert not (tmp_path / "current.json").exists()


def test_paths_stay_inside(tmp_path):
    (tmp_path / "link").symlink_to("/")
    for name in ("../x", "/etc/x", "link/x"):
        with pytest.raises(publish.PublishError):
            publish.confined(tmp_path, name)


def test_lock(tmp_path):
    path = tmp_path / "lock"
    with publish.Lock(path, "r0"), pytest.raises(publish.PublishError), publish.Lock(path):
        pass
    assert not path.exists()
    # A lock that is made but not yet signed belongs to somebody.
    path.mkdir()
    with pytest.raises(publish.PublishError), publish.Lock(path):
        pass
    with pytest.raises(publish.PublishError, match="uncertain"):
        publish.recover(path)
    owner = {"token": "t", "pid": os.getpid(), "hostname": socket.gethostname(), "runId": "r1"}
    for change, why in (({}, "lives"), ({"hostname": "elsewhere"}, "uncertain"), ({"pid": "1"}, "uncertain")):
        publish.write_json(path / "owner.json", owner | change)
        with pytest.raises(publish.PublishError, match=why):
            publish.recover(path)
    publish.write_json(path / "owner.json", owner | {"pid": 2**22 + 1})
    publish.write_json(tmp_path / "runs/r1/state.json", {"status": "running", "stages": [{"id": "a", "status": "running"}, {"id": "b", "status": "pending"}]})
    assert publish.recover(path, tmp_path) == "r1" and not path.exists()
    state = json.loads((tmp_path / "runs/r1/state.json").read_text())
    assert state["status"] == "interrupted" and [s["status"] for s in state["stages"]] == ["failed", "skipped"]
    lock = publish.Lock(path).__enter__()
    publish.write_json(path / "owner.json", owner)
    with pytest.raises(publish.PublishError, match="another owner"):
        lock.__exit__()
    assert path.exists()


def test_runs(spark, tmp_path):
    def ok(work):
        publish.write_text(work / "a.txt", "a")
        return ["a.txt"]

    def bad(work):
        raise ValueError("no")

    state = publish.run_stages(spark, [publish.Stage("a", ok), publish.Stage("b", bad, degradable=True)], tmp_path, "r1")
    assert state.status == "succeeded_degraded" and [s.status for s in state.stages] == ["succeeded", "degraded"]
    assert json.loads((tmp_path / "runs/r1/state.json").read_text())["stages"][0]["outputs"]["a.txt"] == publish.digest(tmp_path / "runs/r1/work/a.txt")
    assert publish.run_stages(spark, [publish.Stage("b", bad), publish.Stage("a", ok)], tmp_path, "r2").status == "failed"
    slow = publish.Stage("slow", lambda work: [str(spark.range(1 << 40).selectExpr("sum(id % 7)").collect())], deadline_s=1)
    assert publish.run_stages(spark, [slow], tmp_path, "r3").stages[0].diagnostic == "stage_deadline"
    idle = publish.Stage("idle", lambda work: time.sleep(60) or [], deadline_s=0.5)
    after = publish.run_stages(spark, [idle, publish.Stage("a", ok)], tmp_path, "r4")
    assert [(s.status, s.diagnostic) for s in after.stages] == [("failed", "stage_deadline"), ("skipped", "upstream_failed")] and after.status == "failed"
    assert publish.run_stages(spark, [idle], tmp_path, "r5", deadline_s=0.2).stages[0].diagnostic == "run_deadline"
    noted = publish.run_stages(spark, [publish.Stage("a", lambda work: (ok(work), ["note"]))], tmp_path, "r6")
    assert noted.status == "succeeded_degraded" and noted.stages[0].diagnostic == "note" and noted.stages[0].outputs
    with pytest.raises(publish.PublishError):
        state.move("running")
