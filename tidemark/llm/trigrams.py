"""The trigrams that every match of a regular expression must contain."""

from __future__ import annotations

from re import _constants as op
from re import _parser

#: A query is a list of clauses, all of which must hold; a clause is a list of sets of trigrams,
#: one of which must be present in full. No clause: nothing is mandatory.
Query = list[list[frozenset[str]]]

MOST_STRINGS = 64


def trigrams(text: str) -> frozenset[str]:
    return frozenset(text[i : i + 3] for i in range(len(text) - 2))


def query(pattern: str) -> Query:
    """The Boolean trigram query of ``pattern``, in lower case, whatever case the pattern asks for."""
    clauses, strings = _walk(_parser.parse(pattern))
    return clauses + _clause(strings)


def _clause(strings: set[str]) -> Query:
    sets = {trigrams(s) for s in strings}
    if not sets or not all(sets):
        return []
    # an option that needs all of another one's trigrams and more adds nothing
    return [sorted((s for s in sets if not any(t < s for t in sets)), key=sorted)]


def _walk(items) -> tuple[Query, set[str]]:
    """Clauses so far, and the strings that the part after them can be."""
    clauses: Query = []
    strings = {""}
    for kind, value in items:
        own = _finite(kind, value)
        if own is not None and len(strings) * len(own) <= MOST_STRINGS:
            strings = {a + b for a in strings for b in own}
            continue
        clauses += _clause(strings)
        strings = {""}
        if own is not None:
            strings = own
        else:
            clauses += _inner(kind, value)
    return clauses, strings


def _finite(kind, value) -> set[str] | None:
    """All strings an item matches, or None."""
    if kind is op.LITERAL:
        return {chr(value).lower()}
    if kind is op.IN:
        chars: set[str] = set()
        for k, v in value:
            if k is op.LITERAL:
                chars.add(chr(v).lower())
            elif k is op.RANGE and v[1] - v[0] < MOST_STRINGS:
                chars |= {chr(c).lower() for c in range(v[0], v[1] + 1)}
            else:
                return None
        return chars if len(chars) <= 8 else None
    if kind is op.SUBPATTERN:
        clauses, strings = _walk(value[3])
        return strings if not clauses and all(_finite(*x) is not None for x in value[3]) else None
    if kind is op.BRANCH:
        out: set[str] = set()
        for branch in value[1]:
            clauses, strings = _walk(branch)
            if clauses or any(_finite(*x) is None for x in branch):
                return None
            out |= strings
        return out if len(out) <= MOST_STRINGS else None
    if kind in (op.MAX_REPEAT, op.MIN_REPEAT) and value[1] != op.MAXREPEAT:
        low, high, inner = value
        clauses, one = _walk(inner)
        if clauses or any(_finite(*x) is None for x in inner) or len(one) ** high > MOST_STRINGS or high > 8:
            return None
        out, power = ({""} if low == 0 else set()), {""}
        for n in range(1, high + 1):
            power = {a + b for a in power for b in one}
            out |= power if n >= low else set()
        return out
    return {""} if kind is op.AT else None


def _inner(kind, value) -> Query:
    """What an item that matches too many strings makes mandatory."""
    if kind is op.SUBPATTERN:
        clauses, strings = _walk(value[3])
        return clauses + _clause(strings)
    if kind in (op.MAX_REPEAT, op.MIN_REPEAT) and value[0] > 0:
        clauses, strings = _walk(value[2])
        return clauses + _clause(strings)
    if kind is op.BRANCH:
        options = []
        for branch in value[1]:
            clauses, strings = _walk(branch)
            clauses = clauses + _clause(strings)
            if not clauses:
                return []
            options += max(clauses, key=lambda c: min(map(len, c)))
        return [options]
    return []
