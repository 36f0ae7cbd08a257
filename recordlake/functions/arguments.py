"""Arguments of a tail, read on the driver: how far back, and which rows."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterable, Mapping
from fractions import Fraction
from typing import NamedTuple

from recordlake.schema import COLUMN_NAMES, column_named

DEFAULT_LAST = 100

# Duration units in nanoseconds.
_UNITS = {
    "ns": 1,
    "us": 10**3,
    "µs": 10**3,
    "μs": 10**3,
    "ms": 10**6,
    "s": 10**9,
    "m": 60 * 10**9,
    "h": 3600 * 10**9,
}
_PART = re.compile(r"([0-9]+\.?[0-9]*|\.[0-9]+)(ns|us|µs|μs|ms|s|m|h)")
_MAX_NANOS = 2**63 - 1


class Start(NamedTuple):
    """Where reading begins: from the first message, else by age, else this many messages back."""

    from_start: bool = False
    age: dt.timedelta | None = None
    last: int = DEFAULT_LAST


def parse_duration(text: str) -> int:
    """A duration such as ``10m``, ``1h30m`` or ``1.5h`` in nanoseconds; ValueError when it is none."""
    body = text[1:] if text[:1] in ("+", "-") else text
    parts = list(_PART.finditer(body))
    if not parts or "".join(p.group(0) for p in parts) != body:
        raise ValueError(f"{text!r} is not a duration")
    nanos = sum(int(Fraction(p.group(1).rstrip(".")) * _UNITS[p.group(2)]) for p in parts)
    if nanos > _MAX_NANOS:
        raise ValueError(f"{text!r} is too long a duration")
    return -nanos if text[0] == "-" else nanos


def parse_since(text: str | int | None) -> Start:
    """How far back to begin: blank for the default, a count of messages, or a duration back from now."""
    said = "" if text is None else str(text).strip()
    if not said:
        return Start()
    if re.fullmatch(r"[+-]?[0-9]+", said):
        count = int(said)
        if count <= 0:
            raise ValueError(f"since {said}: a message count must be positive")
        return Start(last=count)
    try:
        nanos = parse_duration(said)
    except ValueError:
        raise ValueError(f"since {said!r}: neither a message count nor a duration") from None
    if nanos <= 0:
        raise ValueError(f"since {said}: a duration must be positive")
    return Start(age=dt.timedelta(microseconds=-(-nanos // 1000)))


def parse_filters(filters: Iterable[str] | Mapping[str, str]) -> dict[str, str]:
    """``column=value`` texts, cut at the first ``=``; an unknown column is refused with the list of real ones."""
    if isinstance(filters, Mapping):
        pairs = [(name, value, f"{name}={value}") for name, value in filters.items()]
    else:
        pairs = []
        for said in filters:
            name, equals, value = said.partition("=")
            if not equals or not name:
                raise ValueError(f"filter {said!r}: want column=value")
            pairs.append((name, value, said))
    for name, _, said in pairs:
        if column_named(name) is None:
            raise ValueError(f'filter {said!r}: no column "{name}"; columns are {", ".join(COLUMN_NAMES)}')
    return {name: value for name, value, _ in pairs}
