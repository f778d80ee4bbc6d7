"""Identifier naming conventions."""

from __future__ import annotations

import re
from collections.abc import Iterable

from tableload.errors import ContractError

_CAMEL_1 = re.compile(r"(.)([A-Z][a-z]+)")
_CAMEL_2 = re.compile(r"([a-z0-9])([A-Z])")
_NON_WORD = re.compile(r"[^0-9a-zA-Z_]+")


def normalize_name(name: str, naming: str = "direct") -> str:
    """``direct`` keeps identifiers verbatim except that a double quote becomes ``_``;
    ``snake_case`` lower-cases and splits camel case (``eventTime`` -> ``event_time``)."""
    if naming == "direct":
        return name.replace('"', "_")
    if naming == "snake_case":
        out = _CAMEL_2.sub(r"\1_\2", _CAMEL_1.sub(r"\1_\2", name))
        out = _NON_WORD.sub("_", out).lower()
        out = re.sub(r"_+", "_", out).strip("_") if out.strip("_") else out
        if out and out[0].isdigit():
            out = "_" + out
        return out
    raise ContractError(f"unknown naming convention {naming!r}")


def check_collisions(names: Iterable[str], where: str = "") -> None:
    """Names equal ignoring case collide; refuse them before any write."""
    seen: dict[str, str] = {}
    for name in names:
        key = name.casefold()
        if key in seen and seen[key] != name:
            raise ContractError(f"{where}identifiers {seen[key]!r} and {name!r} collide ignoring case")
        if key in seen:
            raise ContractError(f"{where}identifier {name!r} appears twice")
        seen[key] = name
