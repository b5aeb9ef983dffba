"""A registry of trained runs: a folder each, with a manifest, models and tables, and a pointer to the latest."""

from __future__ import annotations

import time
from typing import Any

from ligatura.sources.files import append_jsonl, exists, folders, read_json, write_json


class Checkpoint:
    """One run's folder: ``manifest.json`` lists what was given and which stages are done."""

    def __init__(self, root: str, name: str):
        self.root, self.name = root, name
        self.folder = f"{root}/checkpoints/{name}"

    def path(self, *parts: str) -> str:
        return "/".join((self.folder, *parts))

    def exists(self) -> bool:
        return exists(self.path("manifest.json"))

    @property
    def manifest(self) -> dict[str, Any]:
        return read_json(self.path("manifest.json"))

    def create(self, arguments: dict[str, Any], inputs: dict[str, Any], resume: bool = False) -> Checkpoint:
        """Begin the run, or go on with it if it had the same arguments and inputs."""
        if self.exists():
            before = self.manifest
            if not resume:
                raise FileExistsError(f"{self.folder} exists: resume it or choose another name")
            if (before["arguments"], before["inputs"]) != (arguments, inputs):
                raise ValueError("arguments or inputs differ from the run to resume")
            return self
        write_json({"name": self.name, "created": time.time(), "arguments": arguments, "inputs": inputs, "stages_done": []}, self.path("manifest.json"))
        return self

    def done(self, stage: str) -> bool:
        return stage in self.manifest["stages_done"]

    def mark(self, stage: str, **facts: Any) -> None:
        m = self.manifest
        m["stages_done"] = list(dict.fromkeys([*m["stages_done"], stage]))
        write_json(m | facts, self.path("manifest.json"))

    def publish(self) -> None:
        write_json({"latest": self.name}, f"{self.root}/checkpoints/LATEST.json")

    def log(self, record: dict[str, Any]) -> None:
        append_jsonl(record, self.path("experiments"))

    @classmethod
    def resolve(cls, root: str, name: str | None = None) -> Checkpoint | None:
        """The named run, or the latest; none if there is none."""
        pointer = f"{root}/checkpoints/LATEST.json"
        if name is None:
            name = read_json(pointer)["latest"] if exists(pointer) else None
        found = cls(root, name) if name else None
        return found if found and found.exists() else None

    @classmethod
    def listed(cls, root: str) -> list[str]:
        return [n for n in folders(f"{root}/checkpoints") if cls(root, n).exists()]


class Stopwatch:
    """Wall and CPU seconds of named stages, as a context manager each."""

    def __init__(self) -> None:
        self.rows: list[dict[str, Any]] = []

    def stage(self, name: str):
        from contextlib import contextmanager

        @contextmanager
        def run():
            wall, cpu = time.time(), time.process_time()
            yield
            self.rows.append({"stage": name, "wall_s": round(time.time() - wall, 3), "driver_cpu_s": round(time.process_time() - cpu, 3)})

        return run()
