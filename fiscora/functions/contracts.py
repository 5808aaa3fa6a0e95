"""Schemas of JSON documents as data: a check takes a value and its path, and gives what is wrong as `path: reason`."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Hashable

from .values import timestamp_ok

Check = Callable[[object, str], list[str]]


def given(value: object) -> bool:
    return value not in (None, "", [], {})


def holds(ok: Callable[[object], bool], reason: str) -> Check:
    return lambda value, at: [] if ok(value) else [f"{at}: {reason}"]


def text(pattern: str | None = None, reason: str = "text is wanted") -> Check:
    return holds(lambda v: isinstance(v, str) and bool(v.strip()) and (pattern is None or bool(re.fullmatch(pattern, v))), reason)


def one_of(allowed, fold: bool = False) -> Check:
    return holds(lambda v: (str(v).casefold() if fold else v) in allowed, f"one of {', '.join(sorted(map(str, allowed)))} is wanted")


present = holds(given, "a value is wanted")
boolean = holds(lambda v: isinstance(v, bool), "true or false is wanted")
whole = holds(lambda v: isinstance(v, int) and not isinstance(v, bool), "a whole number is wanted")
moment = holds(timestamp_ok, "an ISO-8601 time with its zone is wanted")
anything: Check = lambda value, at: []


def exactly(wanted: object, why: str) -> Check:
    return holds(lambda v: v is wanted, f"{str(wanted).lower()} is wanted; {why}")


def record(**fields: Check) -> Check:
    """An object with these fields; others are not looked at."""

    def check(value: object, at: str) -> list[str]:
        if not isinstance(value, dict):
            return [f"{at}: an object is wanted"]
        return [p for name, field in fields.items() for p in field(value.get(name), f"{at}.{name}" if at else name)]

    return check


def items(each: Check, least: int = 1, key: Callable[[object], Hashable] | None = None) -> Check:
    """A list of at least so many values; with a key, no two values have the same."""

    def check(value: object, at: str) -> list[str]:
        if not isinstance(value, list) or len(value) < least:
            return [f"{at}: a list of {least} or more is wanted"]
        out = [p for i, v in enumerate(value) for p in each(v, f"{at}[{i}]")]
        if key is not None:
            out += [f"{at}: {k!r} stands {n} times" for k, n in Counter(map(key, value)).items() if n > 1]
        return out

    return check


def either(first: Check, *others: Check) -> Check:
    """What one of the checks accepts; else what the first says."""
    return lambda value, at: [] if any(not c(value, at) for c in (first, *others)) else first(value, at)


#: What a reviewed exception says of itself.
REVIEW = record(reason=text(), owner=text(), evidence=text(), checked_at=moment)
