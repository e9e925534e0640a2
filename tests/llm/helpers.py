"""Small fixtures and brute-force versions for the operators' tests."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLDED = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BYTES = re.compile(rb"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}
DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def texts(n: int = 60, seed: int = 3) -> list[str | None]:
    """Random texts with copies, near copies, shared passages, repeats, empty and null ones, and a long one."""
    rng = random.Random(seed)
    vocabulary = [f"{a}{b}" for a in ("the", "of", "Ünd", "re", "co", "ÀB") for b in ("", "a", "n.", "x1", "é", "it,")]
    some = lambda k: [rng.choice(vocabulary) for _ in range(k)]
    passage = some(45)
    out: list[str | None] = [None, "", " \n\t ", "one", "two words", " \u0085 odd spaces"]
    while len(out) < n:
        words = some(rng.choice((5, 19, 20, 60, 200)))
        if rng.random() < 0.4:
            words[3:3] = passage
        if rng.random() < 0.2:
            words += words[: len(words) // 2] + ["again"] * 30
        out.append(rng.choice((" ", "\n", "  ")).join(words))
        if rng.random() < 0.4:
            out.append(out[-1])
        if rng.random() < 0.3:
            near = out[-1].split()
            near[rng.randrange(len(near))] = "changed"
            out.append(" ".join(near))
    out.append(" ".join(some(3000)))
    return out


def rows(values, lang="en", source=lambda k: f"s{k % 3}"):
    return [(k, t, lang, source(k), len(t or "")) for k, t in enumerate(values)]


def frame(spark, values, **kw):
    return spark.createDataFrame(rows(values, **kw), DOCUMENT)


def hits_spec(docs, items, window=8):
    wins: dict[tuple, set[str]] = {}
    for i, t in items:
        w = FOLDED.findall((t or "").translate(LOWER))
        for k in range(max(1, len(w) - window + 1)) if w else ():
            wins.setdefault(tuple(w[k : k + window]), set()).add(str(i))
    out = {}
    for d, t in docs:
        w = FOLDED.findall((t or "").translate(LOWER))
        hit, found = [0] * len(w), set()
        for n in {len(x) for x in wins}:
            for k in range(len(w) - n + 1):
                if own := wins.get(tuple(w[k : k + n])):
                    found |= own
                    hit[k : k + n] = [1] * n
        out[d] = (len(w), sum(hit), len(found), sha(",".join(sorted(found))), len(found) >= 2)
    return out


def repeats_spec(docs, window=20):
    seen, out = set(), {}
    for d, t in sorted(docs):
        w = WORD.findall(t or "")
        gone = [0] * len(w)
        for k in range(len(w) - window + 1):
            x = tuple(w[k : k + window])
            if x in seen:
                gone[k : k + window] = [1] * window
            seen.add(x)
        out[d] = (len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone, strict=True) if not g)))
    return out


def fingerprint_spec(t, size=3):
    w = WORD.findall((t or "").translate(LOWER))
    grams = [" ".join(w[k : k + size]) for k in range(len(w) - size + 1)] or ([" ".join(w)] if w else [])
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def components_spec(fps: dict[int, int], radius=2):
    ids = sorted(fps)
    root = {d: d for d in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if (fps[a] ^ fps[b]).bit_count() <= radius:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: find(d) for d in ids}


def rules_spec(t):
    t = t or ""
    w = WORD.findall(t)
    c = Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
    covered = {k + j for k in range(len(w) - 2) if c[tuple(w[k : k + 3])] > 1 for j in range(3)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    n = len(w)
    failed = n < 50 or 100 * len(covered) > 50 * n
    return n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered), failed


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _luhn(d):
    twice = [int(c) * 2 if k % 2 else int(c) for k, c in enumerate(reversed(d))]
    return sum(x - 9 if x > 9 else x for x in twice) % 10 == 0


def spans_spec(t):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, t or ""):
            d = re.sub("[^0-9]", "", m[0])
            good = {"ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else True, "card": 16 <= len(d) <= 19 and _luhn(d), "phone": 8 <= len(d) <= 15}
            if good.get(kind, True):
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out
