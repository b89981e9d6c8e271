"""Named queries over the given tables, each with its SQL counterpart."""

from __future__ import annotations

from . import evaluation, expressions, features, sets, sources, streams, texts
from .registry import Entry

MODULES = (sources, expressions, texts, evaluation, sets, features, streams)


def entries() -> dict[str, Entry]:
    found: dict[str, Entry] = {}
    for module in MODULES:
        for name, entry in module.CATALOG.items():
            if name in found:
                raise ValueError(f"query {name!r} is defined twice")
            found[name] = entry
    return found
