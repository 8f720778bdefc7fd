"""Boolean trigram queries of regular expressions: a text that matches holds all trigrams of one of the conjunctions.

Letters count in lower case. A part that may be empty or is a wide class ends the literal before it; a short class or a
branch makes an alternative of each member. Without a trigram in each alternative there is no query: such rules scan.
"""

from __future__ import annotations

from re import _constants as C
from re import _parser as P

MOST_ALTERNATIVES, MOST_CLASS = 64, 8


class _Wide(Exception):
    """More alternatives than are worth it."""


#: An alternative: the trigrams of its ended literals, and the literal that is still open.
Alternative = tuple[frozenset[str], str]


def _trigrams(text: str) -> frozenset[str]:
    return frozenset(text[i : i + 3] for i in range(len(text) - 2))


def _ended(alternatives: set[Alternative]) -> set[Alternative]:
    return {(done | _trigrams(literal), "") for done, literal in alternatives}


def _members(items) -> set[str] | None:
    """The characters of a short class, in lower case."""
    out: set[str] = set()
    for kind, value in items:
        if kind is C.LITERAL:
            out.add(chr(value).lower())
        elif kind is C.RANGE and value[1] - value[0] < MOST_CLASS:
            out |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
        else:
            return None
    return out if len(out) <= MOST_CLASS else None


def _after(alternatives: set[Alternative], nodes) -> set[Alternative]:
    for kind, value in nodes:
        members = {chr(value).lower()} if kind is C.LITERAL else _members(value) if kind is C.IN else None
        if members:
            alternatives = {(done, literal + m) for done, literal in alternatives for m in members}
        elif kind is C.SUBPATTERN:
            alternatives = _after(alternatives, value[-1])
        elif kind is C.BRANCH:
            alternatives = set().union(*(_after(alternatives, branch) for branch in value[1]))
        elif kind in (C.MAX_REPEAT, C.MIN_REPEAT, C.POSSESSIVE_REPEAT):
            least, most, inner = value
            if (least, most) == (0, 1):
                alternatives = alternatives | _after(alternatives, inner)
            else:
                for _ in range(min(least, 3)):
                    alternatives = _after(alternatives, inner)
                if most > least or least > 3:
                    alternatives = _ended(alternatives)
        elif kind is not C.AT:
            alternatives = _ended(alternatives)
        if len(alternatives) > MOST_ALTERNATIVES:
            raise _Wide
    return alternatives


def query(regex: str) -> list[frozenset[str]] | None:
    """Conjunctions of trigrams, one of which each match holds; None if the rule must scan."""
    try:
        found = {done for done, _ in _ended(_after({(frozenset(), "")}, P.parse(regex)))}
    except _Wide:
        return None
    if not all(found):
        return None
    return sorted((c for c in found if not any(other < c for other in found)), key=sorted)
