"""Atomic files, immutable editions with a pointer, a lock and a run of stages. Control plane: the driver's disk."""

from __future__ import annotations

import hashlib
import json
import os
import shutil
import socket
import time
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass, field
from pathlib import Path

from pyspark import InheritableThread
from pyspark.sql import SparkSession

from pressrun.errors import PressError


class PublishError(PressError, RuntimeError):
    """A candidate, pointer or run that must not be published."""


def write_text(path: str | Path, body: str) -> None:
    """All of body or nothing at path."""
    path = Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    temporary = path.with_name(f".{path.name}.{uuid.uuid4().hex}")
    try:
        with open(temporary, "w", encoding="utf-8") as f:
            f.write(body)
            f.flush()
            os.fsync(f.fileno())
        os.replace(temporary, path)
    finally:
        temporary.unlink(missing_ok=True)


def write_json(path: str | Path, value: object) -> None:
    write_text(path, json.dumps(value, ensure_ascii=False, indent=2) + "\n")


def confined(root: str | Path, name: str) -> Path:
    """root/name; refuses ways out of root and symbolic links on the way."""
    root = Path(root).resolve()
    path = root / name
    if ".." in Path(name).parts or Path(name).is_absolute():
        raise PublishError(f"path leaves its root: {name}")
    for part in [path, *path.parents]:
        if part == root:
            break
        if part.is_symlink():
            raise PublishError(f"symbolic link refused: {part.name}")
    return path


def digest(path: Path) -> str:
    """SHA-256 of a file, or of the names and digests of the files of a folder that Spark wrote."""
    if not path.is_dir():
        return hashlib.sha256(path.read_bytes()).hexdigest()
    found = sorted(x for x in path.rglob("*") if x.is_file() and not x.name.startswith((".", "_")))
    return hashlib.sha256("\n".join(f"{x.relative_to(path)} {digest(x)}" for x in found).encode()).hexdigest()


OWNER = "owner.json"


class Lock:
    """An exclusive folder that names its owner. It is never taken over unasked: see `recover`."""

    def __init__(self, path: str | Path, run_id: str = "") -> None:
        self.path, self.run_id, self.token = Path(path), run_id, uuid.uuid4().hex

    def owner(self) -> dict:
        return json.loads((self.path / OWNER).read_text(encoding="utf-8"))

    def __enter__(self) -> Lock:
        self.path.parent.mkdir(parents=True, exist_ok=True)
        try:
            self.path.mkdir()
        except FileExistsError:
            raise PublishError("the lock is taken; recover it if its owner is dead") from None
        try:
            write_json(self.path / OWNER, {"token": self.token, "pid": os.getpid(), "hostname": socket.gethostname(), "runId": self.run_id})
        except OSError:
            self.path.rmdir()
            raise
        return self

    def check(self) -> None:
        """Fails if the lock is no longer this one's."""
        if not (self.path / OWNER).is_file() or self.owner()["token"] != self.token:
            raise PublishError("the lock has another owner now")

    def __exit__(self, *_: object) -> None:
        self.check()
        (self.path / OWNER).unlink()
        self.path.rmdir()


def recover(lock: str | Path, root: str | Path | None = None) -> str:
    """Frees the lock of an owner that is certainly dead, on this host, and marks its unfinished run as interrupted. Returns its run.

    An owner that lives, is on another host or is not named is left alone; two recoveries exclude each other.
    """
    held = Lock(lock)
    try:
        owner = held.owner()
        pid, host, run_id = owner["pid"], owner["hostname"], owner["runId"]
        if not owner["token"] or host != socket.gethostname() or not isinstance(pid, int) or pid <= 0:
            raise PublishError("the lock's owner is uncertain")
    except (OSError, ValueError, KeyError, TypeError) as e:
        raise PublishError("the lock's owner is uncertain") from e
    try:
        os.kill(pid, 0)
        raise PublishError("the lock's owner lives")
    except ProcessLookupError:
        pass
    except PermissionError:
        raise PublishError("the lock's owner lives") from None
    claim = held.path / "recovery"
    try:
        os.close(os.open(claim, os.O_CREAT | os.O_EXCL | os.O_WRONLY))
    except FileExistsError:
        raise PublishError("another recovery is at work") from None
    try:
        if held.owner()["token"] != owner["token"]:
            raise PublishError("the lock has another owner now")
        if root is not None and run_id and (state := confined(root, f"runs/{run_id}") / "state.json").is_file():
            interrupt(state)
        (held.path / OWNER).unlink()
    finally:
        claim.unlink()
    held.path.rmdir()
    return run_id


def interrupt(path: Path) -> None:
    """Ends the record of a run whose process is gone."""
    state = json.loads(path.read_text(encoding="utf-8"))
    if state["status"] not in ("running", "publishing"):
        return
    for stage in state["stages"]:
        if stage["status"] in ("running", "pending"):
            stage |= {"status": "failed" if stage["status"] == "running" else "skipped", "diagnostic": "interrupted"}
    write_json(path, state | {"status": "interrupted"})


#: Moves of a run and of a stage.
ENDED = {"succeeded", "succeeded_degraded", "failed", "interrupted"}
RUN_MOVES = {"pending": {"running"}, "running": {"publishing"} | ENDED, "publishing": ENDED}
STAGE_MOVES = {"pending": {"running", "skipped"}, "running": {"succeeded", "degraded", "failed", "skipped"}}


@dataclass
class StageState:
    id: str
    status: str = "pending"
    started_at: float | None = None
    finished_at: float | None = None
    diagnostic: str | None = None
    outputs: dict[str, str] = field(default_factory=dict)


@dataclass
class RunState:
    run_id: str
    stages: list[StageState]
    status: str = "pending"

    def move(self, status: str) -> None:
        if status not in RUN_MOVES.get(self.status, ()):
            raise PublishError(f"a run cannot go from {self.status} to {status}")
        ends = [s.status for s in self.stages]
        if status in ("publishing", "succeeded", "succeeded_degraded") and not set(ends) <= {"succeeded", "degraded", "skipped"}:
            raise PublishError("a stage has failed or is not done")
        if status == "succeeded" and "degraded" in ends or status == "succeeded_degraded" and "degraded" not in ends:
            raise PublishError(f"a run with these stages cannot end as {status}")
        self.status = status

    def move_stage(self, stage: StageState, status: str, diagnostic: str | None = None) -> None:
        if status not in STAGE_MOVES.get(stage.status, ()):
            raise PublishError(f"a stage cannot go from {stage.status} to {status}")
        stage.status, stage.diagnostic = status, diagnostic
        if status == "running":
            stage.started_at = time.time()
        else:
            stage.finished_at = time.time()


@dataclass(frozen=True)
class Stage:
    """run(work) gives the names of the outputs, or these and diagnostics that leave the stage degraded."""

    id: str
    run: Callable[[Path], list[str] | tuple[list[str], list[str]]]
    degradable: bool = False
    deadline_s: float = 300.0


def run_stages(spark: SparkSession, stages: list[Stage], root: str | Path, run_id: str, deadline_s: float = 1800.0) -> RunState:
    """Runs stages in order; outputs are files and folders under the run's work folder, which are hashed.

    State is saved after every move. A stage works in a thread of its own: at its deadline or the run's its Spark jobs are
    cancelled and the run goes on without it, whatever its Python code still does. A degradable stage may fail and leaves
    the run degraded; any other failure ends it, and the stages after it are skipped.
    """
    home = confined(root, f"runs/{run_id}")
    work = home / "work"
    work.mkdir(parents=True, exist_ok=False)
    state = RunState(run_id, [StageState(s.id) for s in stages])
    save = lambda: write_json(home / "state.json", asdict(state))
    state.move("running")
    save()
    began = time.monotonic()
    for stage, record in zip(stages, state.stages):
        if any(x.status == "failed" for x in state.stages):
            state.move_stage(record, "skipped", "upstream_failed")
            continue
        state.move_stage(record, "running")
        save()
        left = deadline_s - (time.monotonic() - began)
        group = f"{run_id}:{stage.id}"
        done: list = []

        def work_on(stage: Stage = stage, group: str = group, done: list = done) -> None:
            spark.sparkContext.setJobGroup(group, stage.id, interruptOnCancel=True)
            try:
                done.append(stage.run(work))
            except Exception as e:
                done.append(e)

        thread = InheritableThread(target=work_on, daemon=True)
        thread.start()
        thread.join(max(0.0, min(stage.deadline_s, left)))
        if not done:
            spark.sparkContext.cancelJobGroup(group)
            result: object = PressError("deadline", "stage_deadline" if stage.deadline_s <= left else "run_deadline")
        else:
            result = done[0]
        try:
            if isinstance(result, Exception):
                raise result
            outputs, diagnostics = result if isinstance(result, tuple) else (result, [])
            record.outputs = {name: digest(confined(work, name)) for name in outputs}
            state.move_stage(record, "degraded" if diagnostics else "succeeded", ", ".join(diagnostics) or None)
        except Exception as e:
            state.move_stage(record, "degraded" if stage.degradable else "failed", e.code if isinstance(e, PressError) else type(e).__name__)
        save()
    ends = {x.status for x in state.stages}
    state.move("failed" if "failed" in ends else "succeeded_degraded" if "degraded" in ends else "succeeded")
    save()
    return state


def create_candidate(work: str | Path, names: list[str], edition_id: str) -> dict:
    """A manifest bound to its files by hash, written beside them."""
    work = Path(work)
    manifest = {"schemaVersion": 1, "editionId": edition_id, "files": {n: digest(confined(work, n)) for n in sorted(names)}}
    write_json(work / "manifest.json", manifest)
    return manifest


def validate_candidate(folder: str | Path) -> dict:
    folder = Path(folder)
    manifest = json.loads((folder / "manifest.json").read_text(encoding="utf-8"))
    if manifest.get("schemaVersion") != 1 or not manifest.get("editionId"):
        raise PublishError("manifest is not of a known form")
    for name, stated in manifest["files"].items():
        path = confined(folder, name)
        if not path.exists() or digest(path) != stated:
            raise PublishError(f"file differs from its manifest: {name}")
    return manifest


def promote(work: str | Path, root: str | Path) -> dict:
    """Makes the candidate in work the current edition; the rename of the pointer commits. The same again changes nothing."""
    manifest = validate_candidate(work)
    root = Path(root)
    target = confined(root, f"editions/{manifest['editionId']}")
    if target.exists():
        if validate_candidate(target) != manifest:
            raise PublishError("an edition cannot change")
    else:
        temporary = confined(root, f"editions/.{uuid.uuid4().hex}")
        temporary.mkdir(parents=True)
        try:
            for name in [*manifest["files"], "manifest.json"]:
                copy = temporary / name
                copy.parent.mkdir(parents=True, exist_ok=True)
                own = Path(work) / name
                shutil.copytree(own, copy) if own.is_dir() else shutil.copyfile(own, copy)
            validate_candidate(temporary)
            os.replace(temporary, target)
        finally:
            shutil.rmtree(temporary, ignore_errors=True)
    write_json(root / "current.json", {"schemaVersion": 1, "editionId": manifest["editionId"], "manifestSha256": digest(target / "manifest.json")})
    return manifest


def current(root: str | Path) -> tuple[dict, Path]:
    """The manifest and folder the pointer names, checked."""
    root = Path(root)
    pointer = json.loads((root / "current.json").read_text(encoding="utf-8"))
    folder = confined(root, f"editions/{pointer['editionId']}")
    if digest(folder / "manifest.json") != pointer["manifestSha256"]:
        raise PublishError("pointer and edition differ")
    return validate_candidate(folder), folder
