"""Boolean trigram queries from regular expressions.

A query is a list of alternatives, each a set of lower-case ASCII trigrams that must all stand in any text
(folded to lower case) that the expression matches; an empty set asks for nothing, so the text must be scanned.
"""

from __future__ import annotations

import re
from itertools import product

_parser = re._parser  # the standard library's own syntax tree
Query = list[frozenset[str]]
ANY: Query = [frozenset()]
MOST = 64  # strings of a set, alternatives of a query


def _least(query: Query) -> Query:
    """Without alternatives that ask for more than another one."""
    kept: Query = []
    for one in sorted(set(query), key=lambda s: (len(s), sorted(s))):
        if not any(other <= one for other in kept):
            kept.append(one)
    return kept if len(kept) <= MOST else ANY


def _both(a: Query, b: Query) -> Query:
    both = [x | y for x, y in product(a, b)]
    return _least(both) if len(both) <= MOST * MOST else a


def _of_strings(strings: set[str]) -> Query:
    grams = [frozenset(g for k in range(len(s) - 2) if (g := s[k : k + 3]).isascii()) for s in strings]
    return _least(grams) if grams else ANY


def _sequence(items) -> tuple[set[str] | None, Query]:
    """The exact strings of a sequence of nodes (None if not few), and the query of what they must hold."""
    run, query, exact = {""}, ANY, True
    for op, value in _unrolled(items):
        strings, asks = _node(op, value)
        if strings is not None and len(run) * len(strings) <= MOST:
            run = {a + b for a, b in product(run, strings)}
            continue
        exact = False
        query = _both(_both(query, _of_strings(run)), asks)
        run = strings if strings is not None else {""}
    if exact:
        return run, _of_strings(run)
    return None, _both(query, _of_strings(run))


def _unrolled(items):
    """Repeats as their least copies, then, if there may be more, one node that matches anything."""
    for op, value in items:
        if op in (_parser.MAX_REPEAT, _parser.MIN_REPEAT) and not (value[0] == 0 and value[1] == 1):
            for _ in range(min(value[0], 8)):
                yield from _unrolled(value[2])
            if value[1] > value[0] or value[0] > 8:
                yield _parser.ANY, None
        else:
            yield op, value


def _node(op, value) -> tuple[set[str] | None, Query]:
    if op is _parser.LITERAL:
        return {chr(value).lower()}, ANY
    if op is _parser.AT:
        return {""}, ANY
    if op is _parser.IN and all(kind is _parser.LITERAL for kind, _ in value) and len(value) <= 8:
        return {chr(x).lower() for _, x in value}, ANY
    if op is _parser.SUBPATTERN:
        return _sequence(value[3])
    if op in (_parser.MAX_REPEAT, _parser.MIN_REPEAT):  # an optional part
        strings, _ = _sequence(value[2])
        return (strings | {""}, ANY) if strings is not None and len(strings) < MOST else (None, ANY)
    if op is _parser.BRANCH:
        parts = [_sequence(x) for x in value[1]]
        strings = None if any(s is None for s, _ in parts) else set().union(*[s for s, _ in parts])
        if strings is not None and len(strings) <= MOST:
            return strings, _of_strings(strings)
        return None, _least([x for _, q in parts for x in q])
    return None, ANY


def trigram_query(pattern: str) -> Query:
    """What the expression asks for; ANY if it has no mandatory trigrams."""
    return _least(_sequence(_parser.parse(pattern))[1])
