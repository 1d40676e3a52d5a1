"""Plain Python versions of the operators, for small fixtures."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def shingle_set(text, k):
    w = SPACED.findall(lower(text))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def near(docs, k, num, den):
    """{doc_id: (n_shingles, component_id, kept)} for (doc_id, text) rows with unique ids."""
    sets = {i: shingle_set(t, k) for i, t in docs}
    up = {i: i for i in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[n + 1:]:
            same = len(sets[i] & sets[j])
            if same and den * same >= num * (len(sets[i]) + len(sets[j]) - same):
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), root(i), root(i) == i) for i in ids}


def leaks(docs, items, n):
    """{doc_id: (n_words, n_hit, items)}."""
    windows = defaultdict(set)
    for item, text in items:
        w = ALNUM.findall(lower(text))
        for s in range(max(1, len(w) - n + 1) if w else 0):
            windows[tuple(w[s:s + n])].add("" if item is None else str(item))
    out = {}
    for i, text in docs:
        w, hit, found = ALNUM.findall(lower(text)), set(), set()
        for size in {len(x) for x in windows}:
            for s in range(len(w) - size + 1):
                if tuple(w[s:s + size]) in windows:
                    hit |= set(range(s, s + size))
                    found |= windows[tuple(w[s:s + size])]
        out[i] = (len(w), len(hit), sorted(found))
    return out


def repeated(docs, length):
    """[(doc_id, n_bytes, n_removed, n_spans, kept_sha256)] of (doc_id, text) rows, null ids last."""
    least = {}
    rank = lambda i: float("inf") if i is None else i
    for i, t in docs:
        b = (t or "").encode()
        for s in range(len(b) - length + 1):
            x = b[s:s + length]
            least[x] = min(least.get(x, float("inf")), rank(i))
    out = []
    for i, t in docs:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for s in range(len(b) - length + 1):
            if least[b[s:s + length]] < rank(i):
                gone[s:s + length] = b"\1" * length
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out.append((i, len(b), len(b) - len(kept), len(re.findall(b"\1+", bytes(gone))),
                    hashlib.sha256(kept).hexdigest()))
    return out


def line_cut(docs, min_words):
    """{doc_id: text} after deleting repeated runs of lines; (doc_id, text) rows with unique ids."""
    seen, gone = {}, defaultdict(set)
    places = []
    for i, t in sorted((d for d in docs if d[1] is not None)):
        lines = t.split("\n")
        full = [(p, x.strip(" \t\r"), len(SPACED.findall(x))) for p, x in enumerate(lines) if SPACED.search(x)]
        for a in range(len(full)):
            words, run = 0, []
            for p, x, n in full[a:]:
                run.append((p, x))
                words += n
                if words >= min_words:
                    places.append(((i, full[a][0]), tuple(x for _, x in run), run[-1][0]))
                    break
    for place, key, _ in sorted(places):
        seen.setdefault(key, place)
    for (i, p), key, last in places:
        if seen[key] < (i, p):
            gone[i] |= set(range(p, last + 1))
    return {i: None if t is None else "\n".join(x for p, x in enumerate(t.split("\n")) if p not in gone[i])
            for i, t in docs}


def whole_line_cut(docs, min_words):
    """Like line_cut, from the definition: lines of any run of ``min_words`` words or more that stands at an earlier place."""
    first, places, gone = {}, [], defaultdict(set)
    for i, t in sorted((d for d in docs if d[1] is not None)):
        full = [(p, x.strip(" \t\r"), len(SPACED.findall(x))) for p, x in enumerate(t.split("\n")) if SPACED.search(x)]
        for a in range(len(full)):
            for b in range(a + 1, len(full) + 1):
                if sum(n for _, _, n in full[a:b]) >= min_words:
                    run = tuple(x for _, x, _ in full[a:b])
                    first.setdefault(run, (i, a))
                    places.append((i, a, run, range(full[a][0], full[b - 1][0] + 1)))
    for i, a, run, at in places:
        if first[run] < (i, a):
            gone[i] |= set(at)
    return {i: None if t is None else "\n".join(x for p, x in enumerate(t.split("\n")) if p not in gone[i])
            for i, t in docs}


def word_runs(words, exponent, shortest):
    """[(start, length, period)]: every period is tried at every place."""
    out, n = [], len(words)
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            size = j - i + q
            x = words[i:i + size]
            if size >= max(shortest, exponent * q) and not any(x[d:] == x[:-d] for d in range(1, q)):
                out.append((i, size, q))
            i = j + 1 if j > i else i + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def runs_row(i, words, exponent=4, shortest=6):
    """A row of the query on periodic runs."""
    runs = word_runs(words, exponent, shortest)
    gone = {x for s, n, q in runs for x in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (i, len(runs), *(best + (1000 * best[1] // best[2],) if best else (None,) * 4),
            sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)),
            sha(" ".join(w for k, w in enumerate(words) if k not in gone)))


def periodic_tail(i, words):
    """The words of document ``i`` with the tail that the query gives to a tenth of the documents."""
    h = zlib.crc32(str(i).encode())
    if i is None or h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (k - a) % p] for k in range(a, n)]


def ranked(docs, items, k):
    """[(item_id, rank, doc_id, score)] of (doc_id, text) and (item_id, text) rows; every document is scored for every item."""
    rows = [(i, ALNUM.findall(lower(t))) for i, t in docs]
    rows = [(i, Counter(w), len(w)) for i, w in rows if w]
    n_docs, n_terms = len(rows), sum(n for _, _, n in rows)
    df = Counter(t for _, c, _ in rows for t in c)
    wanted = defaultdict(Counter)
    for i, t in {(i, t) for i, t in items}:
        wanted[i].update(ALNUM.findall(lower(t)))
    out = []
    for item, terms in wanted.items():
        w = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) for t in terms}
        scores = []
        for i, c, n in rows:
            m = 100 - 25 + (25 * n * n_docs) // n_terms
            s = sum(q * w[t] * ((10**9 * c[t]) // (1000 * c[t] + 12 * m)) for t, q in terms.items() if t in c)
            if s > 0:
                scores.append((-s, i is None, i or 0))
        out += [(item, r, None if null else i, -s) for r, (s, null, i) in enumerate(sorted(scores)[:k], 1)]
    return out


SECRETS = (("assign", re.compile("([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|"
                                 "[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"), lambda m: len(m[2]) >= 8),
           ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 16), ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 32))


def secrets(text):
    """[(kind, start, stop)] of the fixed patterns, by start, then kind as listed."""
    found = [(m.start(), k, name, m.end()) for k, (name, pattern, ok) in enumerate(SECRETS)
             for m in pattern.finditer(text or "") if ok(m)]
    return [(name, a, b) for a, _, name, b in sorted(found)]
