"""Parameters from JSON or YAML: defaults, then what is supplied, coerced and checked."""

from __future__ import annotations

import dataclasses
import json
import math
from pathlib import Path

from .run import Settings


def coerced(value: object, kind: type) -> object:
    """value as kind; text from a command line is parsed, and a number must be finite."""
    if kind is bool:
        if isinstance(value, bool):
            return value
        text = str(value).strip().lower()
        if text in ("true", "1", "yes"):
            return True
        if text in ("false", "0", "no"):
            return False
        raise ValueError(f"not a flag: {value}")
    if kind in (int, float):
        number = float(value)
        if not math.isfinite(number) or (kind is int and number != int(number)):
            raise ValueError(f"not a finite {kind.__name__}: {value}")
        return kind(number)
    return str(value)


def load(path: str | None = None, **supplied: object) -> Settings:
    """Settings from a file and keywords, keywords first; an unknown name is an error."""
    given: dict[str, object] = {}
    if path:
        text = Path(path).read_text()
        if path.endswith(".json"):
            given = json.loads(text)
        else:
            import yaml

            given = yaml.safe_load(text) or {}
    given |= supplied
    kinds = {f.name: type(f.default) for f in dataclasses.fields(Settings)}
    if unknown := sorted(set(given) - set(kinds)):
        raise ValueError(f"unknown parameters: {', '.join(unknown)}")
    return Settings(**{k: coerced(v, kinds[k]) for k, v in given.items()})


def resolved(settings: Settings) -> str:
    return json.dumps(dataclasses.asdict(settings), sort_keys=True, indent=2)
