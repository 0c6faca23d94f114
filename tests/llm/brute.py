"""Plain Python counterparts of the operators, for small tables."""

import base64
import hashlib
import math
import re
import zlib
from collections import defaultdict

SPACE_WORDS = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM_WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


def sha(t):
    return hashlib.sha256(t.encode()).hexdigest()


def quality(t):
    t = t or ""
    words = SPACE_WORDS.findall(t)
    lines = [x for x in t.split("\n") if SPACE_WORDS.search(x)]
    at = defaultdict(list)
    for i in range(len(words) - 4):
        at[tuple(words[i : i + 5])].append(i)
    repeated = {j for places in at.values() if len(places) > 1 for i in places for j in range(i, i + 5)}
    failed = len(words) < 10 or 100 * len(repeated) > 20 * len(words)
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(repeated), failed,
    )


PATTERNS = {
    "assign": (re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 12),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 18),
    "hex": (re.compile(r"[0-9a-f]+"), 0, 16),
}


def secrets(t):
    """(spans, counts, digest) of the base patterns."""
    found = sorted(
        (m.start(), rank, m.end(), kind)
        for rank, (kind, (p, g, least)) in enumerate(PATTERNS.items())
        for m in p.finditer(t or "")
        if len(m.group(g)) >= least
    )
    spans = [f"{k}:{s}:{e}" for s, _, e, k in found]
    return spans, [sum(f[3] == k for f in found) for k in PATTERNS], sha(",".join(spans))


def warc(rows):
    groups = defaultdict(list)
    for p, h in rows:
        groups[h or ""].append(p)
    out = {}
    for p, h in rows:
        raw, last = (h or "").encode(), max(groups[h or ""])
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        out[p] = (len(raw), digest, "response", None) if p == last else (len(raw), digest, "revisit", last)
    return out


def hits(t, items):
    """(n_words, hit word numbers, items found)."""
    words = ALNUM_WORDS.findall(lower(t))
    hit, names = set(), set()
    for name, text in items:
        own = ALNUM_WORDS.findall(lower(text))
        n = min(10, len(own))
        windows = {tuple(own[i : i + n]) for i in range(len(own) - n + 1)} if n else set()
        for i in range(len(words) - n + 1 if n else 0):
            if tuple(words[i : i + n]) in windows:
                hit.update(range(i, i + n))
                names.add(str(name))
    return len(words), hit, sorted(names)


def repeats(rows):
    """id -> (words, removed, digest of the rest); ids must differ."""
    words = {d: SPACE_WORDS.findall(t or "") for d, t in rows}
    first = {}
    for d, w in words.items():
        for i in range(len(w) - 49):
            k = tuple(w[i : i + 50])
            first[k] = min(first.get(k, d), d)
    out = {}
    for d, w in words.items():
        gone = {j for i in range(len(w) - 49) if first[tuple(w[i : i + 50])] < d for j in range(i, i + 50)}
        out[d] = (len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def near(rows):
    """id -> (shingles, component); ids must differ."""
    sets = {}
    for d, t in rows:
        w = SPACE_WORDS.findall(lower(t))
        sets[d] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 4 * min(len(x), len(y)) >= 3 * max(len(x), len(y)) and 100 * len(x & y) >= 75 * len(x | y):
                p, q = root(a), root(b)
                parent[max(p, q)] = min(p, q)
    return {d: (len(sets[d]), root(d)) for d in sets}


def features(t):
    """Buckets of all runs of one to three words."""
    words = ALNUM_WORDS.findall(lower(t))
    return [zlib.crc32(" ".join(words[i : i + n]).encode()) % 10_000 for n in (1, 2, 3) for i in range(len(words) - n + 1)], len(words)


def resampled(docs, target):
    """Per row: id, features, weight, score, rank; ids must differ."""
    s, t = [0] * 10_000, [0] * 10_000
    for counts, texts in ((s, [x for _, x in docs]), (t, target)):
        for x in texts:
            for b in features(x)[0]:
                counts[b] += 1
    s_all, t_all = sum(s), sum(t)
    gain = [math.floor(1000 * math.log((b + 1) * (s_all + 10_000) / ((a + 1) * (t_all + 10_000)))) for a, b in zip(s, t, strict=True)]
    rows = []
    for d, x in docs:
        found, words = features(x)
        h = int(hashlib.sha256(f"42:{d}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in found)
        rows.append((d, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), words))
    eligible = sorted((r for r in rows if r[4] >= 20), key=lambda r: (-r[3], r[0]))
    rank = {r[0]: k for k, r in enumerate(eligible[: 5 * len(eligible) // 100], 1)}
    return {(*r[:4], rank.get(r[0])) for r in rows}


def filled(d, t):
    """Per row: n, form, prefix and middle length, output."""
    t = t or ""
    digest = hashlib.sha256(f"1:{'' if d is None else d}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * k : 8 * k + 8], 16) for k in range(4))
    if not t or re.search("<[PSM]>", t) or h3 % 100 >= 90:
        return len(t), "plain", None, None, t
    a, b = sorted((h1 % (len(t) + 1), h2 % (len(t) + 1)))
    p, m, s = t[:a], t[a:b], t[b:]
    if h4 % 100 < 20:
        return len(t), "spm", a, b - a, "<S>" + s + "<P>" + p + "<M>" + m
    return len(t), "psm", a, b - a, "<P>" + p + "<S>" + s + "<M>" + m
