"""Settings in layers, and the runner of a pipeline's steps."""

from __future__ import annotations

import os
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

import yaml

from .sources.files import resolved

#: What is used where nothing else is said.
DEFAULTS: dict[str, Any] = {
    "chunking": {"size": 1000, "overlap": 200, "least": 80, "most": 6000},
    "search": {"top_k": 10, "threshold": 0.65},
    "rerank": {"weights": {}, "top_n": 10},
    "batching": {"budget": 12000},
    "store": {"type": "memory"},
    "spec_repo": {},
}


def merged(base: dict, over: dict) -> dict:
    """``over`` laid on ``base``, dict by dict; other values replace each other."""
    out = dict(base)
    for k, v in over.items():
        out[k] = merged(out[k], v) if isinstance(out.get(k), dict) and isinstance(v, dict) else v
    return out


def _read(path: str | os.PathLike | None) -> dict:
    if not path or not Path(path).is_file():
        return {}
    found = yaml.safe_load(Path(path).read_text(encoding="utf-8"))
    return found if isinstance(found, dict) else {}


def settings(path: str | None = None, overlay: str | None = None, env: dict[str, str] | None = None, overrides: dict | None = None, prefix: str = "QUILLGRAPH_") -> dict:
    """Defaults, then the file, its overlay, the environment and the overrides, each on the one before.

    QUILLGRAPH_SEARCH__TOP_K=5 sets search.top_k, its value read as YAML.  An overlay's relative path is taken from the
    file's folder.  ``${VAR}`` is replaced throughout.
    """
    env = dict(os.environ) if env is None else env
    out = merged(DEFAULTS, _read(path))
    if overlay and path and not os.path.isabs(overlay):
        overlay = str(Path(path).parent / overlay)
    out = merged(out, _read(overlay))
    for name, value in sorted(env.items()):
        if name.startswith(prefix):
            keys, own = name[len(prefix) :].lower().split("__"), yaml.safe_load(value)
            for k in reversed(keys):
                own = {k: own}
            out = merged(out, own)
    return resolved(merged(out, overrides or {}), env)


class Fatal(Exception):
    """Ends a run: the steps after it are skipped."""


@dataclass
class Run:
    """One run of a pipeline: its id, state, and what each step did."""

    state: dict[str, Any] = field(default_factory=dict)
    run_id: str = field(default_factory=lambda: uuid.uuid4().hex[:12])
    steps: list[dict] = field(default_factory=list)

    @property
    def errors(self) -> list[str]:
        return [f"{s['step']}: {s['error']}" for s in self.steps if s["error"]]


def run(steps: list[tuple[str, Callable[[dict], dict | None]]], state: dict | None = None, spark=None) -> Run:
    """Run steps in order; each takes the state and gives what it adds to it.

    An error is recorded and the next step goes on without what failed; after :class:`Fatal` the others are skipped.  With
    a session the steps' jobs carry the run's id and the step's name.
    """
    out = Run(dict(state or {}))
    fatal = False
    for name, step in steps:
        entry = {"step": name, "run_id": out.run_id, "status": "skipped" if fatal else "ok", "error": "", "seconds": 0.0, "added": []}
        out.steps.append(entry)
        if fatal:
            continue
        if spark is not None:
            spark.sparkContext.setJobGroup(out.run_id, name)
        start = time.monotonic()
        try:
            more = step(out.state) or {}
            out.state |= more
            entry["added"] = sorted(more)
        except Fatal as e:
            entry["status"], entry["error"], fatal = "fatal", str(e), True
        except Exception as e:
            entry["status"], entry["error"] = "error", f"{type(e).__name__}: {e}"
        entry["seconds"] = round(time.monotonic() - start, 3)
    return out
