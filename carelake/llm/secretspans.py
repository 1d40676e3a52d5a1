"""Secret scan: fixed patterns, and a linear-chain conditional random field that finds more.

Patterns (the base): ``assign``, ``access`` and ``hex`` as below; leftmost and non-overlapping per
kind, matches that are too short are dropped.

Field: a text is a chain of tokens (runs of ``[A-Za-z0-9+/_.-]`` and non-ASCII bytes, or one other
character), each tagged secret begin, inside or outside.  Features of a token are its shape
(length, character classes, changes between classes), its neighbours (hashes of the three
tokens before and the one behind; white space before a token ends a secret) and the file (shares of digits and symbols, length).  Weights
are fitted by maximum likelihood on at most ``SAMPLE_DOCS`` texts of at most ``SAMPLE_CHARS`` characters
(those with the least hash), cut into ``WINDOWS`` windows at most: tags come from the base, and
from generated secrets and look-alikes put between the tokens of most windows.  Tags are decoded by
Viterbi: chains of a block of texts are laid end to end and run in sqrt(n) columns at once, which
gives the same path as token by token.  A decoded span counts from ``MIN_CHARS`` characters on, if no base
span overlaps it; base spans always stay.

Nothing is shuffled but the sample.  Texts are handled in blocks of 2 MB or of one longer text, which takes
some 60 bytes a byte.

Defined cases: null and empty texts have no spans; a corpus without texts for the sample gives a field
that was fitted on generated lines alone; repeated rows and repeated or null ids are judged each (for the sample, equal
rows count once); empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import textkernel as tk
from .common import map_batches

SAMPLE_DOCS, SAMPLE_CHARS, WINDOWS, WINDOW = 600, 20_000, 2400, 40
MIN_CHARS = 8
KINDS = ("assign", "access", "hex", "crf")
ASSIGN = re.compile(rb"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
#: How the matches of ASSIGN start, in lower case.
HEADS = (b"passw", b"secret", b"token", b"api")
SPANS = "doc_id long, spans array<struct<kind: string, start: long, stop: long>>"

BEGIN, INSIDE, OUTSIDE = 0, 1, 2
NEVER = -1e6
LENGTHS = np.array([2, 3, 5, 8, 12, 16, 24, 40, 64])
BUCKETS = 4096
#: Number of values of each feature: length x digits, case, hex x length, changes x length, character,
#: own word, three words before, word behind, file shares x random look, file length x random look.
WIDTHS = (40, 20, 20, 50, 257, BUCKETS, BUCKETS, BUCKETS, BUCKETS, BUCKETS, 32, 12)


def _table(chars: bytes, start: int = 256) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    out[start:] = True
    return out


DIGIT, UPPER = _table(b"0123456789"), _table(bytes(range(65, 91)))
LOWER, MARK, HEX = _table(bytes(range(97, 123))), _table(b"+/_.-"), _table(b"0123456789abcdef")
SPACE, HIGH = _table(b" \t\n\x0b\x0c\r"), _table(b"", 128)
WORD = DIGIT | UPPER | LOWER | MARK | HIGH


@dataclass
class Texts:
    """Texts laid end to end, a line feed behind each."""

    data: bytes
    begin: np.ndarray           # of each text, and the end of all

    @staticmethod
    def of(texts: list[bytes]) -> Texts:
        return Texts(b"".join(t + b"\n" for t in texts), np.cumsum([0] + [len(t) + 1 for t in texts]))

    @property
    def bytes(self) -> np.ndarray:
        return np.frombuffer(self.data, np.uint8)


def base_spans(texts: Texts) -> list[tuple[int, int, int]]:
    """(start, stop, kind) in bytes, sorted, of the fixed patterns."""
    low, out = texts.data.lower(), []
    heads = []
    for head in HEADS:
        at = low.find(head)
        while at >= 0:
            heads.append(at)
            at = low.find(head, at + 1)
    reach = 0
    for at in sorted(heads):
        if at >= reach and (m := ASSIGN.match(texts.data, at)):
            reach = m.end()
            if len(m[2]) >= 8:
                out.append((at, reach, 0))
    out += [(m.start(), m.end(), 1) for m in ACCESS.finditer(texts.data) if m.end() - m.start() >= 16]
    edge = np.flatnonzero(np.diff(np.r_[False, HEX[texts.bytes], False]))
    out += [(a, b, 2) for a, b in edge.reshape(-1, 2)[np.diff(edge)[::2] >= 32].tolist()]
    return sorted(out, key=lambda s: (s[0], s[2]))


def tokens(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """(start, stop) of the tokens, in bytes."""
    word, space = WORD[texts.bytes], SPACE[texts.bytes]
    single = ~word & ~space
    first = single | (word & ~np.r_[False, word[:-1]])
    last = single | (word & ~np.r_[word[1:], False])
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def _share(count: np.ndarray, size: np.ndarray, cuts: tuple[float, ...]) -> np.ndarray:
    return np.searchsorted(np.array(cuts), count / np.maximum(size, 1), "right")


def file_features(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of the shares of digits and symbols, bucket of the length) of each text."""
    size = np.diff(texts.begin) - 1
    sums = lambda flags: np.diff(np.r_[0, np.cumsum(flags)][texts.begin])
    digits = _share(sums(DIGIT[texts.bytes]), size, (0.005, 0.03, 0.1))
    symbols = _share(sums(~(WORD | SPACE)[texts.bytes]), size, (0.01, 0.04, 0.1))
    return digits * 4 + symbols, np.searchsorted([200, 1000, 4000, 20_000, 100_000], size, "right")


def features(texts: Texts, start: np.ndarray, stop: np.ndarray, doc: np.ndarray, file: tuple[np.ndarray, np.ndarray]):
    """The value of each feature of ``WIDTHS`` for every token, feature by feature; ``doc``: the text of each token."""
    b, size = texts.bytes, stop - start
    count = lambda flags: np.diff(np.r_[0, np.cumsum(flags, dtype=np.int32)][np.stack([start, stop])], axis=0)[0]
    digit, upper, lower = count(DIGIT[b]), count(UPPER[b]), count(LOWER[b])
    length = np.searchsorted(LENGTHS, size, "right")
    yield length * 4 + np.where(digit == 0, 0, np.where(digit == size, 3, 1 + (4 * digit > size)))
    head = UPPER[b[start]]
    case = np.where(upper == 0, np.where(lower == 0, 0, 1), np.where(lower == 0, 2, np.where(head & (upper == 1), 3, 4)))
    yield case * 4 + (count(MARK[b]) > 0) * 2 + (count(HIGH[b]) > 0)
    yield (count(HEX[b]) == size) * 10 + length
    kind = (DIGIT + 2 * UPPER + 3 * LOWER + 4 * MARK + 5 * HIGH).astype(np.int8)[b]
    changes = count(np.r_[False, kind[1:] != kind[:-1]]) - np.r_[False, kind[1:] != kind[:-1]][start]
    yield _share(changes, size, (0.001, 0.1, 0.25, 0.5)) * 10 + length
    single = ~WORD[b[start]]
    yield np.where(single, b[start].astype(np.int64) + 1, 0)
    low = tk.LOWER[b]
    power, inverse = tk.powers(len(b) + 1)
    sums = np.zeros(len(b) + 1, np.uint64)
    np.cumsum(tk.BYTE_VALUE[low] * power[:len(b)], out=sums[1:])
    h = tk.mixed((sums[stop] - sums[start]) * inverse[start] + size.astype(np.uint64) * tk.MIX[2])
    h = (h >> np.uint64(40)).astype(np.int64) % (BUCKETS - 1) + 1              # 0: no such neighbour
    yield h
    n = len(h)
    for k in (1, 2, 3):
        near = np.zeros(n, np.int64)
        near[k:] = np.where(doc[k:] == doc[:n - k] if k < n else [], h[:n - k] if k < n else [], 0)
        yield near
    near = np.zeros(n, np.int64)
    near[:-1] = np.where(doc[1:] == doc[:-1], h[1:], 0)
    yield near
    random = (size >= 16) & ((digit > 0) | (changes >= 4))
    yield file[0][doc] * 2 + random
    yield file[1][doc] * 2 + random


def apart(start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Tokens that white space parts from the one before: a secret does not go on there."""
    return np.r_[True, start[1:] != stop[:-1]][:len(start)]


@dataclass
class Field:
    """Weights of a linear-chain field: per feature value and tag, per pair of tags, per first tag."""

    weights: list[np.ndarray]
    step: np.ndarray
    first: np.ndarray

    def emissions(self, texts: Texts, start, stop, doc, file) -> np.ndarray:
        out = np.zeros((len(start), 3))
        for w, values in zip(self.weights, features(texts, start, stop, doc, file)):
            out += w[values]
        out[apart(start, stop), INSIDE] += NEVER
        return out

    def tags(self, texts: Texts, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        doc = np.searchsorted(texts.begin, start, "right") - 1
        return viterbi(self.emissions(texts, start, stop, doc, file_features(texts)), np.r_[True, doc[1:] != doc[:-1]][:len(doc)],
                       self.step, self.first)


def viterbi(emit: np.ndarray, head: np.ndarray, step: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Best tags of chains laid end to end; ``head`` marks the first token of each.

    The tokens stand in columns of about sqrt(n).  Down all columns at once go, first, the best
    score from each tag a column is entered with to each tag; from these the scores that enter each
    column; with them the scores of all tokens.  Back pointers are followed up the columns alike.
    """
    n = len(emit)
    if not n:
        return np.empty(0, np.int8)
    rows = int(np.ceil(np.sqrt(n)))
    cols = -(-n // rows)
    fill = rows * cols - n
    e = np.ascontiguousarray(np.concatenate([emit, np.zeros((fill, 3))]).reshape(cols, rows, 3).transpose(1, 2, 0))
    # the rest of the last column are chains of their own
    new = np.ascontiguousarray(np.r_[head, np.ones(fill, bool)].reshape(cols, rows).T)
    go = lambda r: np.where(new[r], first[:, None], step[:, :, None]) + e[r]  # noqa: E731   from, to, column
    most = lambda a, b, c: np.maximum(np.maximum(a, b), c)
    through = np.where(np.eye(3, dtype=bool), 0.0, NEVER * 4)[:, :, None] + np.zeros(cols)
    for r in range(rows):
        g = go(r)
        through = most(*[through[:, j, None] + g[j] for j in range(3)])
    enter = np.zeros((3, cols))
    for c in range(1, cols):
        x = (enter[:, c - 1, None] + through[:, :, c - 1]).max(0)
        enter[:, c] = x - x.max()
    back = np.empty((rows, 3, cols), np.int8)
    score = enter
    for r in range(rows):
        x, y, z = (score[j] + w for j, w in enumerate(go(r)))
        score = most(x, y, z)
        back[r] = np.where(x == score, 0, np.where(y == score, 1, 2))
    # the tag before a column by the tag at its end, then all tags
    every = np.arange(cols)
    lead = np.broadcast_to(np.arange(3)[:, None], (3, cols))
    for r in range(rows - 1, -1, -1):
        lead = back[r][lead, every]
    at = np.empty(cols, np.int64)
    at[-1] = score[:, -1].argmax()
    for c in range(cols - 1, 0, -1):
        at[c - 1] = lead[at[c], c]
    out = np.empty((rows, cols), np.int8)
    for r in range(rows - 1, -1, -1):
        out[r] = at
        at = back[r][at, every]
    return out.T.reshape(-1)[:n]


# -- fitting -------------------------------------------------------------------------------

# Names that secrets are given, and how such a value may stand behind its name.
NAMES = ("password", "passwd", "secret", "token", "api_key", "apikey", "pwd", "passphrase", "private_key",
         "client_secret", "access_key", "auth", "credential", "authorization: bearer", "signing key")
SIGNS = ("=", " = ", ": ", ":", " := ", " => ", " ")


def _text(rng, chars: str, low: int, high: int) -> str:
    return "".join(chars[i] for i in rng.integers(0, len(chars), rng.integers(low, high + 1)))


def generated(rng) -> tuple[str, int, int]:
    """(text, start, stop): a made-up secret in its surroundings, or a look-alike (an empty range)."""
    digits, small = "0123456789", "abcdefghijklmnopqrstuvwxyz"
    both = small + small.upper() + digits
    quote = ("", "", "\"", "'")[rng.integers(4)]
    name, sign = NAMES[rng.integers(len(NAMES))], SIGNS[rng.integers(len(SIGNS))]
    name = (name, name.upper(), name.capitalize(), _text(rng, small, 2, 6) + "_" + name)[rng.integers(4)]
    if rng.random() < 0.6:
        strong = (lambda: _text(rng, "0123456789abcdef", 32, 64), lambda: "AKIA" + _text(rng, small.upper() + digits, 16, 16),
                  lambda: _text(rng, both, 24, 48), lambda: _text(rng, both + "+/", 28, 64) + "=" * rng.integers(3),
                  lambda: ("ghp_", "sk_live_", "xoxb-")[rng.integers(3)] + _text(rng, both, 20, 36),
                  lambda: "eyJ" + ".".join(_text(rng, both + "_-", 14, 40) for _ in range(3)))
        weak = (lambda: _text(rng, both, 9, 20), lambda: _text(rng, small, 4, 8) + _text(rng, digits, 2, 5) + _text(rng, both, 3, 6))
        bare = rng.random() < 0.25
        kinds = strong if bare or rng.random() < 0.7 else weak
        value = kinds[rng.integers(len(kinds))]()
        lead = "" if bare else name + sign + quote
        return lead + value + (quote if not bare else ""), len(lead.encode()), len((lead + value).encode())
    word = lambda: _text(rng, small, 2, 10)
    number = lambda n=3: _text(rng, digits, 1, n)
    mail = lambda: f"{word()}{('.', '', '-')[rng.integers(3)]}{number()}@{word()}{number(1)}.{word()}.{('com', 'org', 'de')[rng.integers(3)]}"
    plain = (mail, mail, mail, lambda: ".".join(number() for _ in range(4)),
             lambda: f"20{number(2)}-0{number(1)}-1{number(1)}", lambda: f"https://{word()}.org/{word()}/{word()}-{word()}.html",
             lambda: f"v{number()}.{number()}.{number()}", lambda: _text(rng, digits, 9, 24), lambda: f"{name}{sign}{word()}",
             lambda: f"{name} {word()} {word()}", lambda: word() + word().capitalize() + word().capitalize(),
             lambda: "_".join(word() for _ in range(4)), lambda: "#" + _text(rng, "0123456789abcdef", 6, 6),
             lambda: "/".join(["", word(), word(), word() + ".txt"]), lambda: "".join(word() for _ in range(4)),
             lambda: f"{word()}{sign}{number(6)}", lambda: f"{word().upper()}-{number(5)}", lambda: f"+{number(2)} {number(3)} {number(8)}")
    return plain[rng.integers(len(plain))](), 0, 0


def training_windows(docs: list[bytes], seed: int = 5) -> tuple[Texts, tuple[np.ndarray, np.ndarray], list[list[tuple[int, int]]]]:
    """(windows, their files' features, secret ranges in bytes) from texts tagged by the base, with generated ones put in."""
    rng = np.random.default_rng(seed)
    docs = docs or [b"the of and to in"]
    whole = Texts.of(docs)
    start, stop = tokens(whole)
    owner = np.searchsorted(whole.begin, start, "right") - 1
    files = file_features(whole)
    known = [(a, b) for a, b, _ in base_spans(whole)]
    near = np.unique(np.searchsorted(start, [a for a, _ in known]) // WINDOW) if known else np.empty(0, np.int64)
    # a quarter of the windows with a base span at most, a half with long tokens that are no plain words, others
    odd = (stop - start >= MIN_CHARS) & (np.diff(np.r_[0, np.cumsum((DIGIT | MARK | UPPER)[whole.bytes])][np.stack([start, stop])], axis=0)[0] > 1)
    odd = np.unique(np.flatnonzero(odd) // WINDOW)
    every = np.arange(-(-max(1, len(start)) // WINDOW))
    pick = np.unique(np.r_[rng.permutation(near)[:WINDOWS // 4], rng.permutation(odd)[:WINDOWS // 2], rng.permutation(every)[:WINDOWS // 2]])
    texts, ranges, of = [], [], []
    for w in pick.tolist():
        lo = w * WINDOW
        d = owner[lo] if len(owner) else 0
        hi = min(lo + WINDOW, int(np.searchsorted(owner, d, "right")))
        a, b = (int(start[lo]), int(stop[hi - 1])) if hi > lo else (0, 0)
        text = whole.data[a:b]
        marks = [(x, y) for x, y, _ in base_spans(Texts.of([text]))]
        # what the assign pattern matches is a secret from its value on
        marks = [(m.start(2), y) if (m := ASSIGN.match(text, x)) and m.end() == y else (x, y) for x, y in marks]
        if not marks and rng.random() < 0.8 and hi > lo:
            made, x, y = generated(rng)
            at = int(start[rng.integers(lo, hi)]) - a
            lead = text[:at].rstrip(b" ") + b" " if at else b""
            text = lead + made.encode() + b" " + text[at:]
            marks = [(len(lead) + x, len(lead) + y)] if y else []
        texts.append(text)
        ranges.append(marks)
        of.append(d)
    of = np.array(of, np.int64)
    return Texts.of(texts), (files[0][of], files[1][of]), ranges


def fit(docs: list[bytes], steps: int = 80, penalty: float = 0.3, seed: int = 5) -> Field:
    """Maximum likelihood with a penalty on the squares, by Adam."""
    texts, files, ranges = training_windows(docs, seed)
    start, stop = tokens(texts)
    doc = np.searchsorted(texts.begin, start, "right") - 1
    tag = np.full(len(start), OUTSIDE)
    for k, marks in enumerate(ranges):
        for a, b in marks:
            a, b = a + texts.begin[k], b + texts.begin[k]
            inside = np.arange(np.searchsorted(stop, a, "right"), np.searchsorted(start, b, "left"))
            tag[inside], tag[inside[:1]] = INSIDE, BEGIN
    values = list(features(texts, start, stop, doc, files))
    # windows as rows, in order of their length; a step handles those that are long enough
    head = np.searchsorted(doc, np.arange(len(ranges)))
    size = np.diff(np.r_[head, len(doc)])
    rank = np.argsort(-size, kind="stable")
    rank = rank[size[rank] > 0]
    head, size = head[rank], size[rank]
    active = [int(np.searchsorted(-size, -t, "left")) for t in range(int(size.max(initial=0)))]
    params = [np.zeros((w, 3)) for w in WIDTHS] + [np.zeros((3, 3)), np.zeros(3)]
    gap = apart(start, stop)
    ban, ban_first = np.zeros((3, 3)), np.zeros(3)
    ban[OUTSIDE, INSIDE] = ban_first[INSIDE] = NEVER
    moment, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    same = np.flatnonzero(doc[1:] == doc[:-1])
    pairs = np.zeros((3, 3))
    np.add.at(pairs, (tag[same], tag[same + 1]), 1)
    firsts = np.bincount(tag[head], minlength=3).astype(float)
    gold = np.eye(3)[tag]
    for it in range(1, steps + 1):
        emit = np.zeros((len(doc), 3))
        for w, v in zip(params, values):
            emit += w[v]
        emit = np.exp(emit - emit.max(1, keepdims=True))
        emit[gap, INSIDE] = 0
        move, begin = np.exp(params[-2] + ban), np.exp(params[-1] + ban_first)
        ahead = np.zeros((len(doc), 3))
        for t, m in enumerate(active):
            at = head[:m] + t
            x = emit[at] * (begin if t == 0 else ahead[at - 1] @ move)
            ahead[at] = x / x.sum(1, keepdims=True)
        behind, expected = np.ones((len(doc), 3)), np.zeros((3, 3))
        for t in range(len(active) - 1, 0, -1):
            at = head[:active[t]] + t
            x = emit[at] * behind[at]
            both = ahead[at - 1][:, :, None] * move * x[:, None, :]
            expected += (both / both.sum((1, 2), keepdims=True)).sum(0)
            y = x @ move.T
            behind[at - 1] = y / y.sum(1, keepdims=True)
        post = ahead * behind
        post /= post.sum(1, keepdims=True)
        diff = gold - post
        slopes = [np.stack([np.bincount(v, diff[:, s], len(w)) for s in range(3)], 1) for w, v in zip(params, values)]
        slopes += [pairs - expected, firsts - post[head].sum(0)]
        for k, g in enumerate(slopes):
            g = g - penalty * params[k]
            moment[k] = 0.9 * moment[k] + 0.1 * g
            second[k] = 0.99 * second[k] + 0.01 * g * g
            params[k] += 0.25 * (moment[k] / (1 - 0.9 ** it)) / (np.sqrt(second[k] / (1 - 0.99 ** it)) + 1e-6)
    return Field(params[:-2], params[-2] + ban, params[-1] + ban_first)


def sample(docs: DataFrame, limit: int = SAMPLE_DOCS) -> list[bytes]:
    """At most ``limit`` different texts of at most SAMPLE_CHARS characters, those with the least hash."""
    rows = docs.count()
    if not rows:
        return []
    share = min(1.0, 4 * limit / rows)                   # cut by the hash first, so that few rows are sorted
    hashed = docs.filter((F.length("text") > 0) & (F.length("text") <= SAMPLE_CHARS)).select(
        "text", F.xxhash64("doc_id", "text").alias("_hash")).filter(F.pmod("_hash", F.lit(1 << 40)) < int(share * (1 << 40)))
    rows = hashed.groupBy("_hash").agg(F.first("text").alias("text")).orderBy("_hash").limit(limit)
    return [bytes(r[0]) for r in rows.select(F.col("text").cast("binary")).collect()]


# -- scanning ------------------------------------------------------------------------------


def spans_of(texts: list[bytes], field: Field) -> list[list[tuple[str, int, int]]]:
    """(kind, start, stop) in characters, by start and kind, of every text."""
    laid = Texts.of(texts)
    found = base_spans(laid)
    start, stop = tokens(laid)
    tag = field.tags(laid, start, stop)
    begin = np.flatnonzero(tag == BEGIN)
    if len(begin):
        over = np.flatnonzero(tag != INSIDE)                     # a span ends before the next token that is not inside
        nxt = np.searchsorted(over, begin, "right")
        last = np.where(nxt < len(over), np.r_[over, len(tag)][nxt], len(tag)) - 1
        a, b = start[begin], stop[last]
        if found:
            lo, hi = np.array(sorted(x for x, _, _ in found)), np.array(sorted(y for _, y, _ in found))
            free = np.searchsorted(lo, b, "left") == np.searchsorted(hi, a, "right")      # started before the end, ended before the start
            a, b = a[free], b[free]
        found = sorted(found + [(x, y, 3) for x, y in zip(a.tolist(), b.tolist())], key=lambda s: (s[0], s[2]))
    out: list[list[tuple[str, int, int]]] = [[] for _ in texts]
    if found:
        chars = np.r_[0, np.cumsum((laid.bytes & 0xC0) != 0x80)]
        for a, b, kind in found:
            k = int(np.searchsorted(laid.begin, a, "right")) - 1
            zero = chars[laid.begin[k]]
            if kind < 3 or chars[b] - chars[a] >= MIN_CHARS:
                out[k].append((KINDS[kind], int(chars[a] - zero), int(chars[b] - zero)))
    return out


def secret_spans(docs: DataFrame, field: Field | None = None) -> DataFrame:
    """(doc_id, spans) of every row of ``docs``; ``field``: as fitted, by default on a sample of ``docs``."""
    field = field or fit(sample(docs.select("doc_id", "text")))
    shared = docs.sparkSession.sparkContext.broadcast(field)         # weights of a fixed number of features

    def run(batches):
        for batch in batches:
            text = batch.column("text")
            _, off = tk.text_bytes(text)
            for lo, hi in tk.blocks(off):
                spans = spans_of([x.as_py() or b"" for x in text.slice(lo, hi - lo)], shared.value)
                rows = [[dict(zip(("kind", "start", "stop"), s)) for s in x] for x in spans]
                kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64())]))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, hi - lo), pa.array(rows, kind)], ["doc_id", "spans"])
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return map_batches(rows, run, SPANS)
