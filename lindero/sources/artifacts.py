"""Artifacts: deterministic NDJSON, manifests, atomic installs, retention, and a staged run."""

from __future__ import annotations

import hashlib
import json
import os
import shutil
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def to_ndjson(df: DataFrame, order: list[str]) -> DataFrame:
    """One JSON object a row, nulls written, in a total order."""
    return df.orderBy(*order).select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value"))


def sha256_file(path: Path) -> str:
    with path.open("rb") as f:
        return hashlib.file_digest(f, "sha256").hexdigest()


def write_immutable(path: Path, data: bytes) -> bool:
    """False if the same bytes are there already; FileExistsError if others are."""
    if path.exists():
        if path.read_bytes() == data:
            return False
        raise FileExistsError(path)
    part = path.with_name(f".{path.name}.{os.getpid()}")
    part.write_bytes(data)
    os.replace(part, path)
    return True


def install(target: Path, files: dict[str, bytes]) -> dict:
    """A folder with a manifest, put in place by one rename; the same content again changes nothing."""
    listing = [{"path": n, "bytes": len(b), "sha256": hashlib.sha256(b).hexdigest(), "records": b.count(b"\n")} for n, b in sorted(files.items())]
    manifest = {"schemaVersion": 1, "outputs": listing}
    if target.exists():
        if json.loads((target / "manifest.json").read_text()) == manifest:
            return manifest
        raise FileExistsError(target)
    stage = target.with_name(f".{target.name}.{os.getpid()}")
    shutil.rmtree(stage, ignore_errors=True)
    stage.mkdir(parents=True)
    try:
        for n, b in files.items():
            (stage / n).write_bytes(b)
        (stage / "manifest.json").write_text(json.dumps(manifest, indent=2) + "\n")
        stage.rename(target)
    finally:
        shutil.rmtree(stage, ignore_errors=True)
    return manifest


def verify(target: Path) -> list[str]:
    """Files that differ from the manifest."""
    listing = json.loads((target / "manifest.json").read_text())["outputs"]
    return [x["path"] for x in listing if not (target / x["path"]).is_file() or sha256_file(target / x["path"]) != x["sha256"]]


def inside(root: Path, path: Path) -> Path:
    """The real path, if it lies inside the real root."""
    real = path.resolve(strict=True)
    if not real.is_relative_to(root.resolve(strict=True)):
        raise ValueError(f"{path} is outside {root}")
    return real


def purge(roots: list[Path], now: str, apply: bool = False) -> list[Path]:
    """Direct child folders whose manifest expired at or before ``now`` (ISO text); removed only with ``apply``."""
    out = []
    for root in roots:
        for child in sorted(p for p in root.iterdir() if p.is_dir()):
            if json.loads((child / "manifest.json").read_text())["expiresAt"] <= now:
                out.append(child)
                if apply:
                    shutil.rmtree(child)
    return out


def run_stages(stages: list[tuple[str, Callable[[], None]]], status_path: Path | None = None) -> list[dict]:
    """Runs in order and stops at the first failure; later stages stay PENDING. After every change the whole status is written
    in one step, so a reader never sees half of it."""
    status = [{"stage": n, "state": "PENDING"} for n, _ in stages]

    def tell() -> None:
        if status_path:
            states = {s["state"] for s in status}
            whole = "FAILED" if "FAILED" in states else "SUCCEEDED" if states <= {"SUCCEEDED"} else "RUNNING"
            part = status_path.with_name(f".{status_path.name}.{os.getpid()}")
            part.write_text(json.dumps({"schemaVersion": 1, "state": whole, "stages": status}, indent=2) + "\n")
            os.replace(part, status_path)

    for s, (_, f) in zip(status, stages):
        s["state"] = "RUNNING"
        tell()
        try:
            f()
        except Exception as e:
            s |= {"state": "FAILED", "error": type(e).__name__}
            break
        s["state"] = "SUCCEEDED"
        tell()
    tell()
    return status
