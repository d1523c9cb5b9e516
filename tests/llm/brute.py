"""Plain single-machine versions of the operators, written from their contracts."""

import hashlib
import heapq
import math
import re
import zlib
from collections import defaultdict

LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return (text or "").translate(LOWER)


def shingles(text, n=4):
    words = WORD.findall(lower(text))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1)))


def similarity_classes(texts, n=4, t=(85, 100)):
    """{id: (set size, smallest linked id)} of {id: text}, by comparing all pairs."""
    sets = {k: shingles(v, n) for k, v in texts.items()}
    parent = {k: k for k in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, x in enumerate(ids):
        for y in ids[:i]:
            a, b = sets[x], sets[y]
            shared = len(a & b)
            if shared and t[1] * shared >= t[0] * (len(a) + len(b) - shared):
                parent[find(x)] = find(y)
    classes = defaultdict(list)
    for k in ids:
        classes[find(k)].append(k)
    return {k: (len(sets[k]), min(v)) for v in classes.values() for k in v}


TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def contamination(texts, items, size=13):
    """{id: (words, hit words, items hit, contaminated)} of {id: text} and [(item id, text)]."""
    windows = defaultdict(set)
    for item, text in items:
        found = TERM.findall(lower(text))
        for i in range(max(1, len(found) - size + 1) if found else 0):
            windows[tuple(found[i : i + size])].add(item)
    lengths = {len(w) for w in windows}
    out = {}
    for k, text in texts.items():
        found, hit, names = TERM.findall(lower(text)), set(), set()
        for n in lengths:
            for i in range(len(found) - n + 1):
                names |= (here := windows.get(tuple(found[i : i + n]), set()))
                hit.update(range(i, i + n) if here else ())
        out[k] = (len(found), len(hit), names - {None}, bool(hit) and 20 * len(hit) >= len(found))
    return out


SECRET = {
    "assign": (re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 6),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    "hex": (re.compile(r"[0-9a-f]+"), 0, 24),
}


def secrets(text):
    """Base spans as (start, order of the kind, kind, end)."""
    spans = []
    for order, (kind, (pattern, group, least)) in enumerate(SECRET.items()):
        spans += [(m.start(), order, kind, m.end()) for m in pattern.finditer(text or "") if len(m[group]) >= least]
    return sorted(spans)


def top_k(rows, every=50, k=5, factor=256):
    """[(query id, rank, id, score)] of [(id, vector)] with unique ids, by scoring all pairs."""
    whole = [
        (i, [math.floor(factor * x) for x in v])
        for i, v in rows
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for i, v in whole:
        if i is None or i % every:
            continue
        scores = [(-sum(a * b for a, b in zip(v, w)), j is None, j) for j, w in whole if j != i and len(w) == len(v)]
        out += [(i, rank, j, -score) for rank, (score, _, j) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1)]
    return out


def clusters(rows, dimensions=64, k=40, rounds=5, factor=256, seed="2"):
    """{id: (cluster, distance, cluster's sum, whole sum, digest of the centroid)} of [(id, vector)]."""
    whole = [
        (i, [math.floor(factor * x) for x in v])
        for i, v in rows
        if v is not None and len(v) == dimensions and all(x is not None and math.isfinite(x) for x in v)
    ]
    first = sorted(whole, key=lambda r: (hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[1]))[:k]
    centroids = [v for _, v in first]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        members = defaultdict(list)
        for _, v in whole:
            members[nearest(v)[1]].append(v)
        for j, vs in members.items():
            centroids[j] = [sum(column) // len(vs) for column in zip(*vs)]
    found = [(i, *nearest(v)) for i, v in whole]
    sums = defaultdict(int)
    for _, distance, j in found:
        sums[j] += distance
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return {i: (j, distance, sums[j], sum(sums.values()), digests[j]) for i, distance, j in found}


def damage(rows):
    """Rows (conversation, turn, role, text) after the damage of the contract."""
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(":".join(" " if x is None else str(x) for x in (conv, turn)).encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def repaired(rows):
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, lines) of one conversation's rows (turn, role, text).

    Searches all edits, cheapest first and then by audit.
    """
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    faults, seen = [], set()
    for _, role, text in rows:
        shown = re.findall(r"[^\x20\x09-\x0D]", text)
        faults.append("blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else None)
        seen.add((role, text))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    initials = [role[:1] for _, role, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    # Best (cost, audit, lines) of the edits so far by the initials that may come next.
    after = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    names = {"u": "user", "a": "assistant"}
    queue, done = [(0, "", 0, "", ())], set()
    while queue:
        cost, audit, i, state, lines = heapq.heappop(queue)
        if i == len(rows) and state in ("", "a"):
            break
        if (i, state) in done:
            continue
        done.add((i, state))
        for letter, name in names.items():
            if (state, letter) in after:
                heapq.heappush(queue, (cost + 2, audit + "I", i, letter, (*lines, f"{name}:")))
        if i < len(rows):
            _, role, text = rows[i]
            heapq.heappush(queue, (cost + 3, audit + "D", i + 1, state, lines))
            if faults[i] not in ("blank", "duplicate"):
                more = faults[i] == "truncated"
                if (state, role[:1]) in after:
                    heapq.heappush(queue, (cost + more, audit + "K", i + 1, role[:1], (*lines, f"{role}:{text}")))
                for letter, name in names.items():
                    if (state, letter) in after:
                        heapq.heappush(queue, (cost + 2 + more, audit + "R", i + 1, letter, (*lines, f"{name}:{text}")))
    return (gaps, *(faults.count(x) for x in ("blank", "duplicate", "truncated")), illegal, cost, audit, "\n".join(lines))


def language(rows, model, temper, prior, weight, smoothing, background):
    """[(language or None, confidence)] of [(text, declared, host)] by the rule of the fusion, row by row.

    ``model`` gives the logs of a text's trigrams: a list per trigram with a log for each language, then the background's.
    """
    languages, logs = model
    uniform = 1 / max(1, len(languages))
    texts = [logs(text) if text else [] for text, _, _ in rows]
    near = [[temper * sum(t[k] for t in found) for k in range(len(languages) + 1)] if found else None for found in texts]
    first = [None if n is None else max(range(len(n)), key=lambda k: (n[k], -k)) for n in near]
    keyed = [((host or "").lower(), (declared or "").lower(), f) for (_, declared, host), f in zip(rows, first) if f is not None and f < len(languages)]

    def suffix(host):
        return host.rpartition(".")[2] if "." in host else ""

    def counted(of):
        return [sum(f == k and of(host) for host, _, f in keyed) for k in range(len(languages))]

    def smoothed(counts, outer):
        return [(c + weight * o) / (sum(counts) + weight) for c, o in zip(counts, outer)]

    top = smoothed(counted(lambda h: True), [uniform] * len(languages))
    values = sorted({d for _, d, _ in keyed})
    out = []
    for (_, declared, host), n in zip(rows, near):
        if n is None:
            out.append((None, None))
            continue
        host, declared, total = (host or "").lower(), (declared or "").lower(), list(n)
        if declared in values:
            for k in range(len(languages) + 1):
                of = [(d, f) for _, d, f in keyed if k == len(languages) or f == k]
                total[k] += math.log((sum(d == declared for d, _ in of) + smoothing) / (len(of) + smoothing * len(values)))
        if host in {h for h, _, _ in keyed}:
            outer = smoothed(counted(lambda h: suffix(h) == suffix(host)), top)
            inner = smoothed(counted(lambda h: h == host), outer)
            for k, p in enumerate(inner):
                total[k] += math.log(p * (1 - background))
            total[-1] += math.log(background)
        best = max(range(len(total)), key=lambda k: (total[k], -k))
        confidence = 1 / sum(math.exp(x - total[best]) for x in total)
        out.append((languages[best] if best < len(languages) else None, confidence))
    return out
