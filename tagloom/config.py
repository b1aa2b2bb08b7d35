"""Options: a JSON file overlaid by explicit arguments, with checks."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field, fields, replace
from datetime import timedelta
from pathlib import Path

#: Default reference system, tile zoom, least replication interval.
DEFAULT_SRID, DEFAULT_ZOOM, LEAST_INTERVAL = 3857, 14, timedelta(minutes=1)
_UNITS = {"h": 3600.0, "m": 60.0, "s": 1.0, "ms": 1e-3}


class ConfigError(ValueError):
    """Options that do not fit together."""


def duration(v: str | int | float) -> timedelta:
    """A number of minutes, or text such as 1h30m."""
    if isinstance(v, int | float):
        return timedelta(minutes=v)
    if not re.fullmatch(r"(\d+(\.\d+)?(h|ms|m|s))+", v):
        raise ConfigError(f"{v!r} is no duration")
    return timedelta(seconds=sum(float(n) * _UNITS[u] for n, _, u in re.findall(r"(\d+(\.\d+)?)(h|ms|m|s)", v)))


@dataclass(frozen=True)
class Options:
    store: str = ""
    mapping: str = ""
    state_dir: str = ""
    srid: int = DEFAULT_SRID
    limit_to: str = ""
    limit_to_buffer: float = 0.0
    expire_tiles_dir: str = ""
    expire_tiles_zoom: int = DEFAULT_ZOOM
    replication_interval: timedelta = field(default=LEAST_INTERVAL)
    diff_state_before: timedelta = field(default=timedelta(hours=2))
    schema_import: str = "import"
    schema_production: str = "public"
    schema_backup: str = "backup"
    prefix: str = ""

    def check(self) -> Options:
        if not self.mapping:
            raise ConfigError("a mapping is needed")
        if self.srid not in (3857, 4326):
            raise ConfigError("srid must be 3857 or 4326")
        zoom = self.expire_tiles_zoom if 6 <= self.expire_tiles_zoom <= 18 else DEFAULT_ZOOM
        limit = "" if self.limit_to == "NONE" else self.limit_to
        return replace(self, expire_tiles_zoom=zoom, limit_to=limit, replication_interval=max(self.replication_interval, LEAST_INTERVAL))


def load(path: str | None, given: dict) -> Options:
    """Options of a JSON file; what is given explicitly (not None) wins."""
    known = {f.name: f.type for f in fields(Options)}
    made = json.loads(Path(path).read_text()) if path else {}
    made = {k: v for k, v in made.items() if k in known} | {k: v for k, v in given.items() if v is not None and k in known}
    for k in ("replication_interval", "diff_state_before"):
        if k in made and not isinstance(made[k], timedelta):
            made[k] = duration(made[k])
    return Options(**made).check()


def check_import(read: str | None, write: bool, deploy: bool, revert: bool, remove_backup: bool, append: bool, overwrite: bool) -> None:
    """Steps of an import that exclude one another."""
    if revert and (deploy or remove_backup):
        raise ConfigError("reverting excludes deploying and removing the backup")
    if revert and (read or write):
        raise ConfigError("reverting excludes reading and writing")
    if append and overwrite:
        raise ConfigError("appending excludes overwriting")
    if not (read or write or deploy or revert or remove_backup):
        raise ConfigError("nothing to do")
