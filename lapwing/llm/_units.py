"""Coding of texts through a table of their space-separated units.

Most of a corpus is the same words again.  A text is cut at single spaces that
stand between two characters that are not white space: no pre-tokeniser match
crosses such a place, and what follows it does not depend on what precedes it, so
the code of a text is the concatenation of the codes of its units.  A bounded
table remembers units; unknown ones are coded together, in one library call.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from typing import Any

#: Unicode's White_Space characters.
WHITE = frozenset("\t\n\x0b\x0c\r \x85\xa0                　")
#: Units that a table holds before it keeps only those of the current batch.
TABLE_LIMIT = 500_000
#: Longer units are coded but not remembered.
_LONG = 64


def _joined(units: list[str]) -> list[str]:
    """Units with every space put back that is no safe place to cut."""
    out, run = [], [units[0]]
    for u in units[1:]:
        prev = run[-1]
        if prev and u and prev[-1] not in WHITE and u[0] not in WHITE:
            out.append(run[0] if len(run) == 1 else " ".join(run))
            run = [u]
        else:
            run.append(u)
    out.append(run[0] if len(run) == 1 else " ".join(run))
    return out


class UnitTable:
    """``code`` maps strings to values, one for each; the values of a text's
    units, in order, are the text's."""

    def __init__(self, code: Callable[[list[str]], Iterable[Any]], limit: int = TABLE_LIMIT):
        self._code, self._limit = code, limit
        self._heads: dict[str, Any] = {}
        self._rest: dict[str, Any] = {}

    def __call__(self, texts: list[str | None]) -> list[list[Any]]:
        lists = [(t or "").split(" ") for t in texts]
        seen = set().union(*lists) if lists else set()
        odd = {u for u in seen.difference(self._rest) if not u or u[0] in WHITE or u[-1] in WHITE}
        if odd:
            for k, units in enumerate(lists):
                if not odd.isdisjoint(units):
                    lists[k] = units = _joined(units)
                    seen.update(units)
            seen -= odd
        heads = {u[0] for u in lists}
        seen.update(*[u[1:] for u in lists if not odd.isdisjoint(u[1:])])
        new_heads = list(heads.difference(self._heads))
        new_rest = list(seen.difference(self._rest))
        values = list(self._code(new_heads + [" " + u for u in new_rest]))
        self._heads.update(zip(new_heads, values))
        self._rest.update(zip(new_rest, values[len(new_heads) :]))
        h, get = self._heads, self._rest.__getitem__
        out = [[h[u[0]], *map(get, u[1:])] for u in lists]
        for table, new, now in ((self._heads, new_heads, heads), (self._rest, new_rest, seen)):
            for u in new:
                if len(u) > _LONG:
                    del table[u]
            if len(table) > self._limit:
                kept = {u: table[u] for u in now if u in table}
                table.clear()
                table.update(kept)
        return out
