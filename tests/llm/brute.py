"""Plain-Python versions of the contracts, for small tables."""

from __future__ import annotations

import hashlib
import re

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def shingles(text, n=5):
    w = SPACE_WORD.findall((text or "").translate(UPPER))
    if not w:
        return set()
    return {tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))}


def near_duplicates(docs):
    """{row number: (doc_id, n_shingles, component_id)} of (doc_id, text) rows."""
    sets = [shingles(t) for _, t in docs]
    by = {}
    for i, s in enumerate(sets):
        for g in s:
            by.setdefault(g, []).append(i)
    parent = list(range(len(docs)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    shared = {}
    for rows in by.values():
        for x in range(len(rows)):
            for y in range(x):
                k = rows[y], rows[x]
                shared[k] = shared.get(k, 0) + 1
    for (a, b), n in shared.items():
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            parent[find(a)] = find(b)
    least = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            r = find(i)
            least[r] = min(least.get(r, d), d)
    return [(d, len(sets[i]), least.get(find(i))) for i, (d, _) in enumerate(docs)]


def repeats_removed(docs, n=20):
    """(doc_id, n_words, n_removed, kept_sha256) of (doc_id, text) rows with distinct ids."""
    seen, out = {}, []
    order = sorted(docs, key=lambda d: d[0])
    words = {d: SPACE_WORD.findall(t or "") for d, t in order}
    for d, _ in order:
        for i in range(len(words[d]) - n + 1):
            seen.setdefault(tuple(words[d][i:i + n]), (d, i))
    for d, _ in docs:
        w, drop = words[d], set()
        for i in range(len(w) - n + 1):
            if seen[tuple(w[i:i + n])] != (d, i):
                drop.update(range(i, i + n))
        kept = " ".join(x for i, x in enumerate(w) if i not in drop)
        out.append((d, len(w), len(drop), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def contamination(docs, items, n=10):
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) of (doc_id, text) rows."""
    windows = {}
    for item, t in items:
        w = ALNUM_WORD.findall((t or "").translate(UPPER))
        for i in range(max(1, len(w) - n + 1) if w else 0):
            windows.setdefault(tuple(w[i:i + n]), set()).add(str(item) if item is not None else "")
    sizes = {len(k) for k in windows}
    out = []
    for d, t in docs:
        w, hit, found = ALNUM_WORD.findall((t or "").translate(UPPER)), set(), set()
        for k in sizes:
            for i in range(len(w) - k + 1):
                if (g := tuple(w[i:i + k])) in windows:
                    hit.update(range(i, i + k))
                    found |= windows[g]
        out.append((d, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return out


PII = (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
       ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"))


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def pii(text):
    """Base spans (start, kind number, end, kind) of a text."""
    out = []
    for k, (kind, pattern) in enumerate(PII):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            good = {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m.group().split(".")),
                    "card": 14 <= len(digits) <= 19 and luhn(digits), "phone": 10 <= len(digits) <= 15}[kind]
            if good:
                out.append((m.start(), k, m.end(), kind))
    return sorted(out)


def spelled(spans):
    return ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in spans)


def targets(sizes, epochs=3):
    """{source: target} by water-filling with exact fractions; sizes: {source: words}."""
    from fractions import Fraction

    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    out = {}
    while True:
        left = Fraction(sum(sizes.values())) - sum(out.values())
        free = [s for s in order if s not in out]
        over = [s for s in free if left * weight[s] / sum(weight[f] for f in free) > epochs * sizes[s]]
        if not over:
            return out | {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        out |= {s: Fraction(epochs * sizes[s]) for s in over}


RULES = {"com/": "allow", "example.com/en/": "block", "www.example.com/en/": "allow", "net/es/": "block", "net/fr/": "block"}


def url_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    path = re.split(r"[?#]", rest[len(host):], maxsplit=1)[0]
    return host.translate(UPPER), path


def url_rule(host, path):
    fits = [r for r in RULES for h, _, p in [r.partition("/")] if (host == h or host.endswith("." + h)) and path.startswith("/" + p)]
    return max(fits, key=len) if fits else None


# ---- secrets


SECRETS = (("assign", re.compile(r"((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]))"
                                 r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"), lambda m: len(m[2]) >= 12),
           ("access", re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 18),
           ("hex", re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 16))


def secrets(text):
    """[(start, rank, end, kind)] of the base kinds, in order."""
    return sorted((m.start(), k, m.end(), kind) for k, (kind, pattern, ok) in enumerate(SECRETS) for m in pattern.finditer(text or "") if ok(m))


# ---- conversations


def cheapest_audit(rows):
    """(cost, audit) by trying every sequence of edits, cheapest and ASCII-least first, of (initial, must go, cut off) rows."""
    import heapq

    heap, done = [(0, "", 0, 0)], set()
    keep = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
    turn = (2, 2, 3, 2)
    while heap:
        cost, audit, i, q = heapq.heappop(heap)
        if i == len(rows) and q in (0, 3):
            return cost, audit
        if (i, q) in done:
            continue
        done.add((i, q))
        heapq.heappush(heap, (cost + 3, audit + "I", i, turn[q]))
        if i == len(rows):
            continue
        initial, must_go, cut = rows[i]
        heapq.heappush(heap, (cost + 4, audit + "D", i + 1, q))
        if not must_go:
            if initial in keep[q]:
                heapq.heappush(heap, (cost + 3 * cut, audit + "K", i + 1, keep[q][initial]))
            heapq.heappush(heap, (cost + 3 + 3 * cut, audit + "R", i + 1, turn[q]))


def repair(rows):
    """{conv_id: (gaps, blank, duplicate, truncated, illegal, cost, audit, sha256)} of (conv_id, turn, role, text) rows."""
    import zlib

    by = {}
    for conv, turn, role, text in rows:
        out = by.setdefault(conv, [])
        spell = lambda v: " " if v is None else str(v)
        fault = zlib.crc32(f"{spell(conv)}:{spell(turn)}".encode()) % 20
        role, text = spell(role), spell(text)
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        if fault:
            out += [(turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    return {conv: _repaired(out) for conv, out in by.items()}


def _repaired(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
    turns = {t for t, _, _ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    seen, codes, counts, illegal, before = set(), [], [0, 0, 0], 0, None
    for _, role, text in rows:
        last = re.search(r"[^\x20\x09-\x0D](?=[\x20\x09-\x0D]*\Z)", text)
        fault = 0 if not last else 1 if (role, text) in seen else 2 if last[0] not in ".!?" else None
        seen.add((role, text))
        if fault is not None:
            counts[fault] += 1
        if before is not None and before + role[:1] not in ("su", "ua", "au"):
            illegal += 1
        before = role[:1]
        codes.append((role[:1], fault in (0, 1), fault == 2))
    cost, audit = cheapest_audit(codes)
    out, at, q, names = [], 0, 0, {2: "user", 3: "assistant"}
    turn, keep = (2, 2, 3, 2), ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
    for edit in audit:
        if edit == "I":
            q = turn[q]
            out.append(f"{names[q]}:")
            continue
        _, role, text = rows[at]
        at += 1
        if edit == "R":
            q = turn[q]
            out.append(f"{names[q]}:{text}")
        elif edit == "K":
            q = keep[q][role[0]]
            out.append(f"{role}:{text}")
    return (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest())


# ---- divergence


def divergence(docs, min_docs=10, top=10):
    """{(lang, source, part, item, value, rank)} of (text, lang, source) rows."""
    docs = [((t or "").translate(UPPER), lang or "", s or "") for t, lang, s in docs]
    term = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    of = [(lang, s, term.findall(t)) for t, lang, s in docs]
    out = set()
    for lang in {d[0] for d in of}:
        df = {}
        for g, _, ts in of:
            for t in set(ts) if g == lang else ():
                df[t] = df.get(t, 0) + 1
        kept = sorted(t for t, n in df.items() if n >= min_docs)
        counts = {s: dict.fromkeys(kept, 0) for g, s, _ in of if g == lang}
        for g, s, ts in of:
            for t in ts if g == lang else ():
                if t in counts[s]:
                    counts[s][t] += 1
        total = {t: sum(c[t] for c in counts.values()) for t in kept}
        p = lambda c: {t: 1 + 10**9 * (n + 2) // (sum(c.values()) + 2 * len(kept)) for t, n in c.items()}
        shares, q = {s: p(c) for s, c in counts.items()}, p(total)
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in counts:
            pairs = sorted((-sum(f(shares[s][t], shares[o][t]) for t in kept), o.encode(), o) for o in counts if o != s)
            out |= {(lang, s, "pair", o, -v, i + 1) for i, (v, _, o) in enumerate(pairs)}
            terms = sorted((-f(shares[s][t], q[t]), t.encode(), t) for t in kept if counts[s][t] and shares[s][t] > q[t])
            out |= {(lang, s, "term", t, -v, i + 1) for i, (v, _, t) in enumerate(terms[:top])}
    return out
