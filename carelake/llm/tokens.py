"""Token counts of a byte-pair piece model by rank-synchronous array merging.

A text is cut at the places over which the model can never merge (before a run of
space marks, around line ends, where no piece has them inside).  The distinct
pre-tokens of a batch are held as ragged numpy arrays of symbol ids; in each round
every sequence applies the leftmost pair of its lowest rank, all sequences at once, and
sequences without a pair to merge leave.  The surviving symbols are counted: one token
for a symbol of the vocabulary, else one for each of its UTF-8 bytes.  Sequences over
``LONG`` symbols go by a heap of pairs in the same order, so that a text without any
cut costs n log n.

The piece model file is a parameter and is only read (pieces, scores, byte fallback);
special strings inside texts are ordinary text, as in the library's default.

Defined cases: null text counts as empty and has no tokens; bytes that are no UTF-8 are
counted as the replacement character; repeated rows are counted each; very long texts are
counted whole, each in one task; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import heapq
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import map_batches

SPACE = "▁"
LONG = 256
#: Pre-tokens whose counts a worker keeps; past it the table starts anew.
MEMORY = 400_000
NONE = np.int64(2**62)


class PieceModel:
    """Merge ranks of a piece model: lower rank merges first."""

    def __init__(self, path: str):
        import sentencepiece

        lib = sentencepiece.SentencePieceProcessor(model_file=path)
        normal = [i for i in range(lib.get_piece_size())
                  if not (lib.is_unknown(i) or lib.is_control(i) or lib.is_unused(i) or lib.is_byte(i))]
        pieces = {lib.id_to_piece(i): lib.get_score(i) for i in normal}
        inner = {c for p in pieces if len(p) > 1 for c in p}
        self.ids = {p: i for i, p in enumerate(pieces)}
        self.tokens = [1] * len(pieces)                 # tokens of a symbol that survives
        for c in sorted(inner - self.ids.keys()):       # characters that are only parts of pieces
            self.ids[c] = len(self.tokens)
            self.tokens.append(len(c.encode()))
        self.alone = {c for c in self.ids if len(c) == 1} - inner
        rank = {p: r for r, p in enumerate(sorted((p for p in pieces if len(p) > 1), key=lambda p: -pieces[p]))}
        self.pairs: dict[int, tuple[int, int]] = {}
        n = self.size = len(self.tokens)
        for p, r in rank.items():
            for cut in range(1, len(p)):
                a, b = self.ids.get(p[:cut]), self.ids.get(p[cut:])
                if a is not None and b is not None:
                    self.pairs[a * n + b] = (r, self.ids[p])
        keys = np.array(sorted(self.pairs), np.int64)
        self.keys = np.append(keys, NONE)
        self.rank = np.array([self.pairs[k][0] for k in keys.tolist()] + [NONE], np.int64)
        self.merged = np.array([self.pairs[k][1] for k in keys.tolist()] + [0], np.int64)
        self.cost = np.array(self.tokens, np.int64)
        #: Where the text may be cut: a line end never merges, and space marks only lead.
        mark, end = re.escape(SPACE), "\n" not in inner
        if any(SPACE in p.lstrip(SPACE) for p in pieces):
            raise ValueError("a piece has a space mark inside: texts cannot be cut at spaces")
        self.cuts = re.compile(f"{mark}+[^{mark}\n]*|\n|[^{mark}\n]+" if end else f"{mark}+[^{mark}]*|[^{mark}]+")
        self.known: dict[str, int] = {}

    def _symbols(self, word: str) -> tuple[list[list[int]], int]:
        """Runs of mergeable symbols, and the tokens of the characters between them."""
        runs, run, rest = [], [], 0
        for c in word:
            i = self.ids.get(c)
            if i is None or c in self.alone:            # never part of a merge
                rest += len(c.encode("utf-8", "replace")) if i is None else 1
                if run:
                    runs.append(run)
                    run = []
            else:
                run.append(i)
        if run:
            runs.append(run)
        return runs, rest

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = left * self.size + right
        at = np.searchsorted(self.keys, key)
        hit = self.keys[at] == key
        return np.where(hit, self.rank[at], NONE), self.merged[at]

    def merge_all(self, runs: list[list[int]]) -> np.ndarray:
        """Tokens of each run."""
        out = np.zeros(len(runs), np.int64)
        lens = np.array([len(r) for r in runs], np.int64)
        sym = np.fromiter((s for r in runs for s in r), np.int64, int(lens.sum()))
        owner = np.arange(len(runs))
        rank = np.full(len(sym), NONE)
        into = np.zeros(len(sym), np.int64)
        if len(sym) > 1:
            rank[:-1], into[:-1] = self._ranks(sym[:-1], sym[1:])
        rank[np.cumsum(lens) - 1] = NONE                # no pair over the end of a sequence
        while len(owner):
            start = np.cumsum(lens) - lens
            least = np.minimum.reduceat(rank, start)
            done = least == NONE
            if done.any():                              # count the symbols of finished sequences and drop them
                out[owner[done]] = np.add.reduceat(self.cost[sym], start)[done]
                stay = np.repeat(~done, lens)
                sym, rank, into = sym[stay], rank[stay], into[stay]
                owner, lens, least = owner[~done], lens[~done], least[~done]
                if not len(owner):
                    break
                start = np.cumsum(lens) - lens
            hits = np.flatnonzero(rank == np.repeat(least, lens))
            seq = np.searchsorted(start, hits, "right") - 1
            at = hits[np.r_[True, seq[1:] != seq[:-1]]]  # the leftmost of each sequence
            sym[at] = into[at]
            rank[at] = rank[at + 1]                     # NONE if the merged symbol is the last one now
            gone = np.zeros(len(sym), bool)
            gone[at + 1] = True
            at = at - np.arange(len(at))                # their places after the removal
            sym, rank, into = sym[~gone], rank[~gone], into[~gone]
            lens = lens - 1
            start = np.cumsum(lens) - lens
            last = start + lens - 1
            right = at[at != last]
            rank[right], into[right] = self._ranks(sym[right], sym[right + 1])
            rank[at[at == last]] = NONE
            left = at[at != start] - 1
            rank[left], into[left] = self._ranks(sym[left], sym[left + 1])
        return out

    def merge_long(self, run: list[int]) -> int:
        """Tokens of one long run: the same merges from a heap of (rank, place)."""
        sym, nxt, prv = list(run), list(range(1, len(run) + 1)), list(range(-1, len(run) - 1))
        heap = []

        def offer(i):
            if i >= 0 and nxt[i] < len(run):
                found = self.pairs.get(sym[i] * self.size + sym[nxt[i]])
                if found:
                    heapq.heappush(heap, (found[0], i, sym[i], sym[nxt[i]], found[1]))
        for i in range(len(run) - 1):
            offer(i)
        while heap:
            _, i, a, b, c = heapq.heappop(heap)
            j = nxt[i]
            if sym[i] != a or j >= len(run) or sym[j] != b:
                continue
            sym[i], sym[j], nxt[i] = c, -1, nxt[j]
            if nxt[i] < len(run):
                prv[nxt[i]] = i
            offer(prv[i])
            offer(i)
        return sum(self.tokens[s] for s in sym if s >= 0)

    def learn(self, words: set[str]) -> None:
        """Count the tokens of new pre-tokens, all at once."""
        runs, owner, counts = [], [], {}
        for w in words:
            own, counts[w] = self._symbols(w)
            for r in own:
                if len(r) > LONG:
                    counts[w] += self.merge_long(r)
                else:
                    runs.append(r)
                    owner.append(w)
        if runs:
            for w, n in zip(owner, self.merge_all(runs).tolist()):
                counts[w] += n
        self.known.update(counts)

    def count(self, texts: list[str]) -> list[int]:
        """Tokens of each text, without any special ones."""
        cut = [self.cuts.findall(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts]
        if len(self.known) > MEMORY:
            self.known.clear()
        self.learn(set().union(*cut) - self.known.keys())
        known = self.known
        return [sum(map(known.__getitem__, c)) for c in cut]


_models: dict[str, PieceModel] = {}


def count_tokens(docs: DataFrame, model_path: str | None = None, limit: int = 4096,
                 block_bytes: int = 1 << 21) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row of ``docs``.

    ``model_path``: the piece model on the executors; default the public 32k model.
    """
    def run(batches):
        path = model_path
        if path is None:
            import public_tokenizers
            path = public_tokenizers.path("piece_bpe_32k.model")
        model = _models.get(path) or _models.setdefault(path, PieceModel(path))
        for batch in batches:
            texts = batch.column("text")
            lo, n = 0, batch.num_rows
            while lo < n:
                hi, size, part = lo, 0, []
                while hi < n and (hi == lo or size < block_bytes):
                    raw = texts[hi].as_py() or b""
                    part.append(raw)
                    size, hi = size + len(raw), hi + 1
                counts = model.count([p.decode("utf-8", "replace") for p in part])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(lo, hi - lo), pa.array([len(p) for p in part], pa.int64()),
                     pa.array(counts, pa.int64()), pa.array([c > limit for c in counts], pa.bool_())],
                    ["doc_id", "n_bytes", "n_tokens", "over_limit"])
                lo = hi
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return map_batches(rows, run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
