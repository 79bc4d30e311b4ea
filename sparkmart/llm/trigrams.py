"""Boolean trigram queries derived from regular expressions.

A query is a necessary condition on the set of byte trigrams of an ASCII
lower-cased text: ``None`` (no condition), a trigram, or ("and" | "or", queries).
"""

from __future__ import annotations

import re
import re._parser as parser

MOST_STRINGS = 16


def _conjunction(parts: list):
    parts = list(dict.fromkeys(p for p in parts if p is not None))
    return None if not parts else parts[0] if len(parts) == 1 else ("and", tuple(parts))


def _alternatives(parts: list):
    parts = list(dict.fromkeys(parts))
    return None if not parts or None in parts else parts[0] if len(parts) == 1 else ("or", tuple(parts))


def _of_string(s: bytes):
    return _conjunction([s[i:i + 3] for i in range(len(s) - 2)])


def _characters(op: str, arg, folded: bool) -> set[bytes] | None:
    """The few lower-cased characters an item stands for, or None."""
    if op == "LITERAL":
        if folded and arg > 127:
            return None
        return {chr(arg).encode().lower()}
    if op == "IN":
        found: set[bytes] = set()
        for kind, value in arg:
            if str(kind) == "LITERAL":
                points = [value]
            elif str(kind) == "RANGE" and value[1] - value[0] < MOST_STRINGS:
                points = range(value[0], value[1] + 1)
            else:
                return None
            for p in points:
                if folded and p > 127:
                    return None
                found.add(chr(p).encode().lower())
        return found if len(found) <= 8 else None
    return None


def _strings(items, folded: bool) -> set[bytes] | None:
    """All lower-cased strings a sequence matches, if they are few."""
    out = {b""}
    for op, arg in items:
        name = str(op)
        if name in ("LITERAL", "IN"):
            part = _characters(name, arg, folded)
        elif name == "SUBPATTERN":
            part = _strings(arg[3], folded)
        elif name == "BRANCH":
            part = set()
            for branch in arg[1]:
                own = _strings(branch, folded)
                part = None if own is None or part is None else part | own
        elif name in ("MAX_REPEAT", "MIN_REPEAT") and arg[0] == 0 and arg[1] == 1:
            own = _strings(arg[2], folded)
            part = None if own is None else own | {b""}
        elif name in ("AT", "ASSERT", "ASSERT_NOT"):
            part = {b""}
        else:
            part = None
        if part is None or len(out) * len(part) > MOST_STRINGS:
            return None
        out = {a + b for a in out for b in part}
    return out


def _query(items, folded: bool):
    parts: list = []
    run = {b""}

    def flush() -> None:
        parts.append(_alternatives([_of_string(s) for s in run]))
        run.clear()
        run.add(b"")

    for item in items:
        own = _strings([item], folded)
        if own is not None:
            if len(run) * len(own) > MOST_STRINGS:
                flush()
            grown = {a + b for a in run for b in own}
            run.clear()
            run.update(grown)
            continue
        flush()
        name, arg = str(item[0]), item[1]
        if name == "SUBPATTERN":
            parts.append(_query(arg[3], folded))
        elif name == "BRANCH":
            parts.append(_alternatives([_query(b, folded) for b in arg[1]]))
        elif name in ("MAX_REPEAT", "MIN_REPEAT") and arg[0] >= 1:
            parts.append(_query(arg[2], folded))
    flush()
    return _conjunction(parts)


def trigram_query(pattern: str):
    """The trigram query of a regular expression; None if it has no mandatory trigram."""
    parsed = parser.parse(pattern)
    return _query(list(parsed), bool(parsed.state.flags & re.IGNORECASE))


def trigrams_of(query) -> set[bytes]:
    if query is None:
        return set()
    if isinstance(query, bytes):
        return {query}
    return set().union(*(trigrams_of(q) for q in query[1]))
