"""Plain versions of the operators, one document after the other."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import xxhash

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def simhash(text: str) -> int:
    said = [w.encode().lower() for w in WORD.findall(text)]
    shingles = [b" ".join(said[i : i + 4]) for i in range(max(1, len(said) - 3))] if said else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(values: list[int], radius: int = 4) -> list[int]:
    """The first position of each value's component."""
    a, root = np.array(values, np.uint64), list(range(len(values)))

    def find(x: int) -> int:
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(a)):
        for j in np.flatnonzero(np.bitwise_count(a[i + 1 :] ^ a[i]) <= radius) + i + 1:
            x, y = find(i), find(int(j))
            root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(a))]


PII = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
)


def luhn(digits: str) -> bool:
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(x - 9 if x > 9 else x for x in doubled) % 10 == 0


def personal(text: str) -> list[tuple[str, int, int]]:
    good = {
        "email": lambda v, d: True,
        "ip": lambda v, d: all(int(x) <= 255 for x in v.split(".")),
        "card": lambda v, d: 13 <= len(d) <= 19 and luhn(d),
        "phone": lambda v, d: 9 <= len(d) <= 15,
    }
    found = [(k, m) for k, p in PII for m in re.finditer(p, text)]
    return [(k, m.start(), m.end()) for k, m in found if good[k](m[0], re.sub("[^0-9]", "", m[0]))]


SECRETS = (
    ("assign", r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""),
    ("access", r"AKIA[A-Z0-9]+"),
    ("hex", r"[0-9a-f]+"),
)


def secret(text: str) -> list[tuple[str, int, int]]:
    good = {"assign": lambda m: len(m[1]) >= 6, "access": lambda m: len(m[0]) >= 20, "hex": lambda m: len(m[0]) >= 24}
    found = [(m.start(), i, k, m.end()) for i, (k, p) in enumerate(SECRETS) for m in re.finditer(p, text) if good[k](m)]
    return [(k, start, end) for start, _, k, end in sorted(found)]


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def winnowed(text: str, k: int = 5, window: int = 16) -> list[tuple[int, int]]:
    said = WORD.findall(text)

    def h(words: list[str]) -> int:
        seed = 42
        for w in words:
            seed = xxhash.xxh64_intdigest(w.encode(), seed)
        return seed - (1 << 64) if seed >> 63 else seed

    if not said:
        return []
    hashes = [h(said[i : i + k]) for i in range(len(said) - k + 1)] if len(said) >= k else [h([" ".join(said)])]
    out = []
    for i in range(max(1, len(hashes) - window + 1)):
        some = hashes[i : i + window]
        at = i + max(j for j, x in enumerate(some) if x == min(some))
        if not out or out[-1][1] != at:
            out.append((hashes[at], at))
    return out


def alike(a: list[tuple[int, int]], b: list[tuple[int, int]]) -> float:
    x, y = {h for h, _ in a}, {h for h, _ in b}
    return len(x & y) / len(x | y) if x | y else 1.0


def gram_set(text: str) -> set[str]:
    """N-grams of one to three characters; letters and marks stand for themselves in lower case."""
    import unicodedata

    def sign(c: str) -> str:
        kind = unicodedata.category(c)
        if kind[0] in "LM":
            return c.lower()[0]
        return "0" if kind == "Nd" else " " if c.isspace() else "."

    folded = "".join(map(sign, text))
    return {folded[i : i + n] for n in (1, 2, 3) for i in range(len(folded) - n + 1)}


def kernel(a: str, b: str) -> float:
    """Blended-spectrum presence kernel."""
    x, y = gram_set(a), gram_set(b)
    return len(x & y) / ((len(x) or 1) * (len(y) or 1)) ** 0.5


def ridge(texts, labels, marks, ridge_, asked):
    """Values of one-versus-rest kernel ridge regression on landmarks, in closed form without features."""
    import numpy as np

    languages = sorted(set(labels))
    landmark = [texts[i] for i in marks]
    near = np.array([[kernel(t, m) for m in landmark] for t in texts])
    among = np.array([[kernel(a, b) for b in landmark] for a in landmark])
    weight = np.diag([1 / labels.count(x) for x in labels])
    wanted = np.array([[1.0 if x == name else -1.0 for name in languages] for x in labels])
    alpha = np.linalg.lstsq(near.T @ weight @ near + ridge_ / len(labels) * among, near.T @ weight @ wanted, rcond=None)[0]
    return np.array([[kernel(t, m) for m in landmark] for t in asked]) @ alpha
