"""Settings: nested overrides and pluggable parts."""

from __future__ import annotations

import importlib
from collections.abc import Callable
from typing import Any


def deep_merge(base: dict, over: dict | None) -> dict:
    """base with the values of over; where both have a dict, its entries are merged the same way. Neither is changed."""
    out = dict(base)
    for k, v in (over or {}).items():
        out[k] = deep_merge(out[k], v) if isinstance(v, dict) and isinstance(out.get(k), dict) else v
    return out


def load(path: str) -> Any:
    """The object at `module:attribute` or `module.attribute`."""
    module, _, name = path.partition(":") if ":" in path else path.rpartition(".")
    if not module or not name:
        raise ValueError(f"no path of an object: {path!r}")
    try:
        return getattr(importlib.import_module(module), name)
    except (ImportError, AttributeError) as e:
        raise ValueError(f"{path!r} can't be loaded: {e}") from e


def build(path: str, settings: dict | None = None) -> Callable:
    """What the builder at path makes of the settings, as keywords if it takes them, else as one argument, else without."""
    maker = load(path)
    for attempt in (lambda: maker(**(settings or {})), lambda: maker(settings or {}), maker):
        try:
            return attempt()
        except TypeError as e:
            last = e
    raise ValueError(f"{path!r} can't be built: {last}")
