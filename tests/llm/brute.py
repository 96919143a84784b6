"""Plain versions of the operators, row by row."""

from __future__ import annotations

import datetime
import hashlib
import re
import string
from collections import Counter

import numpy as np
import xxhash

SPACE = re.compile("[^\x20\x09-\x0d]+")
TOKEN = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def measures(text: str | None) -> tuple[int, ...]:
    text = text or ""
    w = SPACE.findall(text)
    grams = Counter(zip(w, w[1:], w[2:], strict=False))
    covered = {k + j for k in range(len(w) - 2) if grams[tuple(w[k : k + 3])] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if SPACE.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def fingerprint(text: str | None) -> int:
    w = SPACE.findall((text or "").translate(LOW))
    if not w:
        return 0
    grams = [" ".join(w)] if len(w) < 4 else [" ".join(w[k : k + 4]) for k in range(len(w) - 3)]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(fps: list[int], ids: list[int | None], radius: int = 4) -> list[int | None]:
    parent = list(range(len(fps)))

    def find(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x

    a = np.array(fps, dtype=np.uint64)
    for k in range(len(a)):
        for j in np.flatnonzero(np.bitwise_count(a[:k] ^ a[k]) <= radius):
            x, y = find(k), find(int(j))
            parent[max(x, y)] = min(x, y)
    least: dict[int, int] = {}
    for k, i in enumerate(ids):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return [least.get(find(k)) for k in range(len(fps))]


def spans(text: str | None, rules) -> list[tuple[int, int, int]]:
    text = text or ""
    out = []
    for no, rule in enumerate(rules):
        out += [(m.start(), no, m.end()) for m in re.finditer(rule.pattern, text, re.A) if len(m.group(rule.group)) >= rule.least]
    return sorted(out)


def redacted(text: str, found: list[tuple[int, int, int]], mark: str) -> str:
    out, at = "", 0
    for start, _, end in found:
        if start >= at:
            out += text[at:start] + mark
        at = max(at, end)
    return out + text[at:]


def mix(rows: list[tuple[str | None, int, str]], share: float = 1.5, most: float = 2.0, weights=(5, 2, 1)) -> tuple[dict, list[int]]:
    """rows: (source, size, digest) -> target by source, taken by row."""
    size: Counter = Counter()
    for s, n, _ in rows:
        size[s] += n
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    target, open_, left = {}, set(order), share * sum(size.values())
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] >= most * size[s]}
        if not full:
            target |= {s: level * weight[s] for s in open_}
            break
        for s in full:
            target[s] = most * size[s]
            left -= target[s]
        open_ -= full
    taken = [0] * len(rows)
    for s in order:
        if not size[s]:
            continue
        epochs, rest = divmod(int(target[s] + 0.5), size[s])
        groups: dict[str, list[int]] = {}
        for k, (o, _, h) in enumerate(rows):
            if o == s:
                groups.setdefault(h, []).append(k)
        for h in sorted(groups):
            words = sum(rows[k][1] for k in groups[h])
            give = 2 * rest >= words
            rest -= words
            for k in groups[h]:
                taken[k] = rows[k][1] * (epochs + give)
    return target, taken


class Pseudonyms:
    """Pseudonyms value by value: the Feistel network on lists of (entry, radix), cards by trying every stretch of groups."""

    def __init__(self, key: str):
        from endmark.llm import pii

        self.key, self.pattern, self.country, self.usual = key, re.compile(pii.ANY, re.A), re.compile(pii.COUNTRY), re.compile(pii.USUAL)

    def network(self, values: list[int], radices: list[int], tweak: str) -> list[int]:
        for r in range(8):
            rest = ".".join(str(x) for i, x in enumerate(values) if i % 2 != r % 2)
            by = lambda i: int(hashlib.sha256(f"{self.key}|{tweak}|{r}|{rest}|{i}".encode()).hexdigest()[:12], 16)  # noqa: B023, E731
            values = [(x + by(i)) % radices[i] if i % 2 == r % 2 else x for i, x in enumerate(values)]
        return values

    @staticmethod
    def laid(m: str, digits: list[int]) -> str:
        it = iter(digits)
        return "".join(str(next(it)) if c in "0123456789" else c for c in m)

    @staticmethod
    def luhn(digits: list[int]) -> int:
        return sum(d if k % 2 == 0 else d * 2 // 10 + d * 2 % 10 for k, d in enumerate(reversed(digits)))

    def email(self, m: str) -> str:
        at = m.rindex("@")
        sets = [next((a for a in (string.digits, string.ascii_lowercase, string.ascii_uppercase) if c in a), c) for c in m[: m.index("@")]]
        new = self.network([a.index(c) for a, c in zip(sets, m, strict=False)], [len(a) for a in sets], "email")
        return "".join(a[v] for a, v in zip(sets, new, strict=True)) + m[at:]

    def phone(self, m: str) -> str:
        digits = re.sub("[^0-9]", "", m)
        code = self.country.match(digits)[0] if m[0] == "+" else "1"
        kept = (len(code) if m[0] == "+" else 0) + bool(re.match(r"\+\d{1,3}[ .-]?\(0\)", m))
        own = [int(c) for c in digits[kept:]]
        first = [code == "1" and len(own) == 10 and k in (0, 3) for k in range(len(own))]
        low = [2 if f and d >= 2 else 0 for f, d in zip(first, own, strict=True)]
        new = self.network([d - a for d, a in zip(own, low, strict=True)], [(8 if a else 2) if f else 10 for f, a in zip(first, low, strict=True)], f"phone|{code}")
        return self.laid(m, [int(c) for c in digits[:kept]] + [d + a for d, a in zip(new, low, strict=True)])

    def date(self, m: str) -> str:
        low = datetime.date(1900, 1, 1)
        day = (datetime.date(int(m[:4]), int(m[5:7]), int(m[8:])) - low).days
        a, b = self.network([day // 4297, day % 4297], [17, 4297], "date")
        return (low + datetime.timedelta(a * 4297 + b)).isoformat().replace("-", m[4])

    def card(self, m: str) -> str:
        d = [int(c) for c in m if c.isdigit()]
        new = d[:1] + self.network(d[1:-1], [10] * (len(d) - 2), f"card|{len(d)}|{d[0]}")
        return self.laid(m, [*new, -self.luhn([*new, 0]) % 10])

    def cards(self, m: str) -> tuple[str, list]:
        groups = [(x.start(), x.end()) for x in re.finditer("[0-9]+", m)]
        ok = {}
        for i in range(len(groups)):
            for j in range(i, min(len(groups), i + 19)):
                d = [int(c) for c in m[groups[i][0] : groups[j][1]] if c.isdigit()]
                if 13 <= len(d) <= 19 and self.luhn(d) % 10 == 0:
                    ok[i, j + 1] = bool(self.usual.match("-".join(str(b - a) for a, b in groups[i : j + 1])))
        best = lambda i, usual: max((j for (a, j), u in ok.items() if a == i and (u or not usual)), default=None)
        out, items, at, i = "", [], 0, 0
        while i < len(groups):
            j = best(i, True) or best(i, False)
            if j and not best(i, True) and any(best(x, True) for x in range(i + 1, j)):
                j = None
            if j:
                new = self.card(m[groups[i][0] : groups[j - 1][1]])
                out, at = out + m[at : groups[i][0]] + new, groups[j - 1][1]
                items.append(("card", new))
            i = j or i + 1
        return out + m[at:], items

    def one(self, m: str) -> tuple[str, list]:
        d = [int(c) for c in m if c in string.digits]
        kind, new = None, m
        if "@" in m:
            kind, new = "email", self.email(m)
        elif m[0] == "+":
            if 8 <= len(d) <= 15:
                kind, new = "phone", self.phone(m)
        elif re.fullmatch(r"\d+\.\d+\.\d+\.\d+", m, re.A):
            octets = [int(x) for x in m.split(".")]
            if max(octets) <= 255:
                kind, new = "ipv4", ".".join(map(str, self.network(octets, [256] * 4, "ipv4")))
        elif re.fullmatch(r"\d{4}([-/])\d\d\1\d\d", m, re.A):
            try:
                kind, new = "date", self.date(m)
            except ValueError:
                kind = None
        elif re.fullmatch(r"\d{3}-\d\d-\d{4}", m, re.A):
            area, group, serial = int(m[:3]), int(m[4:6]), int(m[7:])
            if area not in (0, 666) and area < 900 and group and serial:
                x = self.network([area - 1 - (area > 666), group - 1, serial - 1], [898, 99, 9999], "ssn")
                kind, new = "ssn", f"{x[0] + 1 + (x[0] > 664):03}-{x[1] + 1:02}-{x[2] + 1:04}"
        elif len(d) == 10:
            kind, new = "phone", self.phone(m)
        else:
            return self.cards(m)
        return new, [(kind, new)] if kind else []

    def text(self, text: str | None) -> tuple[str | None, list]:
        out, items, at = "", [], 0
        for m in self.pattern.finditer(text or ""):
            new, found = self.one(m[0])
            out, at, items = out + text[at : m.start()] + new, m.end(), items + found
        return (None if text is None else out + text[at:]), items
