"""Periodic runs in word sequences, found by internal pattern matching.

A run is a stretch of consecutive words with smallest period ``q`` (words ``q``
apart are identical), at least ``max(min_length, 3 q)`` words long, that no
neighbouring word extends.  Spark deals the documents out; inside a task the
texts of a block are one integer sequence, with a separator of its own after
each text, and numpy works on all of its positions at once:

1. prefix doubling ranks the 2**k words from every position; the ranks give
   the suffix array and, at every level, the suffix interval of a block;
2. a wavelet tree over the suffix array answers range successor: the next
   place, at or after x, where the words of a suffix interval occur;
3. for each level ``B = 2**k`` the dyadic blocks ``[m B, (m+1) B)`` ask for
   their occurrences in the two neighbouring windows of ``B`` starts.  A run of
   period ``B <= q < 2 B`` holds such a block together with its copy ``q``
   words later (with ``B = 8`` also for all smaller periods, as runs have
   24 words at least);
4. three or more occurrences in a window form an arithmetic progression whose
   difference ``g`` is the block's own period.  Then only ``g`` and the two
   distances that bring the ends of the ``g``-periodic stretches around block
   and progression onto each other can be periods; up to two occurrences
   are candidates themselves;
5. longest common extensions by the ranks of step 1 extend each candidate, and
   equal stretches keep their smallest period.

No candidate is capped and no text is cut.
"""

from __future__ import annotations

from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_WORDS = 200_000      # words of several texts looked at together; a longer text is a block of its own
LEAST = 3                  # smallest level: blocks of 8 words
REPEATS = 3                # a run holds its period three times


class Ranks:
    """Classes of the 2**k words from each position, by prefix doubling; the last word must be unique."""

    def __init__(self, words: np.ndarray):
        n = len(words)
        order = np.argsort(words, kind="stable")
        rank, many = self._number(words[order], order, np.zeros(n, np.int64), np.zeros(n, np.int64))
        self.levels = [rank]
        while len(many):
            h = 1 << (len(self.levels) - 1)
            after = np.full(len(many), -1, np.int64)
            inside = many + h < n
            after[inside] = rank[many[inside] + h]
            key = rank[many].astype(np.int64) * (n + 1) + after + 1
            order = np.argsort(key, kind="stable")
            at = many[order]
            new, many = self._number(key[order], at, rank[at].astype(np.int64), rank)
            rank = new
            self.levels.append(rank)
        self.suffixes = np.empty(n, np.int32)
        self.suffixes[rank] = np.arange(n, dtype=np.int32)

    @staticmethod
    def _number(key, at, base, old):
        """New ranks (the place of a class's first suffix), and the positions that still share theirs."""
        n = len(key)
        first = np.concatenate(([True], key[1:] != key[:-1]))
        of_base = np.concatenate(([True], base[1:] != base[:-1]))
        place = np.arange(n)
        start = np.maximum.accumulate(np.where(first, place, 0)) - np.maximum.accumulate(np.where(of_base, place, 0))
        rank = old.astype(np.int32)
        rank[at] = base + start
        alone = first & np.concatenate((first[1:], [True]))
        return rank, at[~alone]

    def forward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Equal words from i and j on."""
        i, j, total = i.copy(), j.copy(), np.zeros(len(i), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            step = (self.levels[k][i] == self.levels[k][j]).astype(np.int64) << k
            i += step
            j += step
            total += step
        return total

    def backward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Equal words right before i and j, for i < j."""
        i, j, total = i.copy(), j.copy(), np.zeros(len(i), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            inside = i >= 1 << k
            a, b = np.where(inside, i - (1 << k), 0), np.where(inside, j - (1 << k), 0)
            step = (inside & (self.levels[k][a] == self.levels[k][b])).astype(np.int64) << k
            i -= step
            j -= step
            total += step
        return total


class WaveletTree:
    """Counts and order statistics of values in a range of a sequence, one bit a level."""

    def __init__(self, values: np.ndarray):
        self.bits = max(1, int(len(values)).bit_length())
        self.zeros = []
        a = values
        for s in range(self.bits - 1, -1, -1):
            one = ((a >> s) & 1).astype(bool)
            self.zeros.append(np.concatenate((np.zeros(1, np.int32), np.cumsum(~one, dtype=np.int32))))
            a = np.concatenate((a[~one], a[one]))

    def less(self, lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> np.ndarray:
        """How many values of [lo, hi) are below x."""
        lo, hi, total = lo.copy(), hi.copy(), np.zeros(len(lo), np.int64)
        x = np.minimum(x, (1 << self.bits) - 1)
        for level, z in enumerate(self.zeros):
            one = ((x >> (self.bits - 1 - level)) & 1).astype(bool)
            a, b = z[lo], z[hi]
            total += np.where(one, b - a, 0)
            lo, hi = np.where(one, z[-1] + lo - a, a), np.where(one, z[-1] + hi - b, b)
        return total

    def nth(self, lo: np.ndarray, hi: np.ndarray, r: np.ndarray) -> np.ndarray:
        """The r-th smallest value of [lo, hi); with r = less(x) the range successor of x."""
        lo, hi, r, out = lo.copy(), hi.copy(), r.copy(), np.zeros(len(lo), np.int64)
        for level, z in enumerate(self.zeros):
            a, b = z[lo], z[hi]
            one = r >= b - a
            r -= np.where(one, b - a, 0)
            out |= one.astype(np.int64) << (self.bits - 1 - level)
            lo, hi = np.where(one, z[-1] + lo - a, a), np.where(one, z[-1] + hi - b, b)
        return out


def _window(ranks: Ranks, tree: WaveletTree, b, lo, hi, first_rank, end_rank):
    """(block, candidate period) pairs of the occurrences numbered first_rank to end_rank - 1 of a window."""
    some = np.flatnonzero(end_rank > first_rank)
    b, lo, hi, n = b[some], lo[some], hi[some], (end_rank - first_rank)[some]
    f = tree.nth(lo, hi, first_rank[some])
    last = tree.nth(lo, hi, end_rank[some] - 1)
    yield b, f - b
    yield b, last - b
    run = np.flatnonzero(n >= 3)
    b, f, g = b[run], f[run], ((last - f)[run] // (n[run] - 1))
    yield b, g
    yield b, f + ranks.forward(f, f + g) - b - ranks.forward(b, b + g)
    yield b, f - ranks.backward(f, f + g) - b + ranks.backward(b, b + g)


def find_runs(words: np.ndarray, longest: int, min_length: int = 24):
    """(start, end, period) arrays of all runs of an integer sequence, sorted by start, then period.

    ``longest`` is the length of the longest text in it; texts end with a number that occurs only there.
    """
    none = (np.empty(0, np.int64),) * 3
    if min_length < 24:
        raise ValueError("min_length must be 24 at least")
    if longest < min_length:
        return none
    ranks = Ranks(words)
    tree, found = None, []
    for k in range(LEAST, len(ranks.levels)):
        size = 1 << k
        if REPEATS * size > max(longest, 3 << LEAST):
            break
        level = ranks.levels[k]
        many = np.bincount(level, minlength=len(words))
        b = np.arange(0, len(words) - size, size)
        b = b[many[level[b]] > 1]
        if not len(b):
            continue
        if tree is None:
            tree = WaveletTree(ranks.suffixes)
        lo = level[b].astype(np.int64)
        hi = lo + many[lo]
        r = [tree.less(lo, hi, b + d) for d in (1, size + 1, 2 * size)]
        pairs = [p for i in (0, 1) for p in _window(ranks, tree, b, lo, hi, r[i], r[i + 1])]
        at, q = np.concatenate([p[0] for p in pairs]), np.concatenate([p[1] for p in pairs])
        ok = (q >= 1) & (q < 2 * size)
        key = np.unique(at[ok] * (2 * size) + q[ok])
        at, q = key // (2 * size), key % (2 * size)
        start, end = at - ranks.backward(at, at + q), at + q + ranks.forward(at, at + q)
        ok = end - start >= np.maximum(min_length, REPEATS * q)
        found.append((start[ok], end[ok], q[ok]))
    if not found:
        return none
    start, end, q = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((q, end, start))
    start, end, q = start[order], end[order], q[order]
    new = np.concatenate(([True], (start[1:] != start[:-1]) | (end[1:] != end[:-1])))[:len(start)]
    start, end, q = start[new], end[new], q[new]
    order = np.lexsort((q, start))
    return start[order], end[order], q[order]


def _blocks(texts: list[bytes]):
    """(index of the first text, words of each text) of blocks of texts."""
    group, size, first = [], 0, 0
    for i, t in enumerate(texts):
        w = t.split()                       # bytes.split() cuts at runs of 0x20 and 0x09-0x0D
        if group and size + len(w) > BLOCK_WORDS:
            yield first, group
            group, size, first = [], 0, i
        group.append(w)
        size += len(w)
    if group:
        yield first, group


def runs_of_texts(texts: list[bytes], min_length: int = 24):
    """Per text: its words and its runs as (start, end, period), sorted by start, then period."""
    out = []
    for _, group in _blocks(texts):
        number: dict = {}
        ids, starts, at = [], [], 0
        for j, w in enumerate(group):
            starts.append(at)
            at += len(w) + 1
            ids += map(number.setdefault, w, count(len(ids)))
            ids.append(-1 - j)
        start, end, q = find_runs(np.array(ids, np.int64), max(map(len, group)), min_length)
        base = np.array(starts)
        doc = np.searchsorted(base, start, "right") - 1
        per = [[] for _ in group]
        for d, s, e, p in zip(doc.tolist(), (start - base[doc]).tolist(), (end - base[doc]).tolist(), q.tolist()):
            per[d].append((s, e, p))
        out += zip(group, per)
    return out


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """Words outside of the later periods of every run, joined by one blank."""
    kept, at = [], 0
    for s, e in sorted((s + p, e) for s, e, p in runs):
        if s > at:
            kept += words[at:s]
        at = max(at, e)
    return b" ".join(kept + words[at:])


def _find(min_length: int):
    def run(batches):
        for b in batches:
            texts = [t or b"" for t in b.column("_text").cast(pa.binary()).to_pylist()]
            got = runs_of_texts(texts, min_length)
            runs = [[{"start": s, "length": e - s, "period": p} for s, e, p in r] for _, r in got]
            kind = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))
            yield pa.RecordBatch.from_arrays(
                [b.column("_out"), pa.array([len(w) for w, _ in got], pa.int64()), pa.array(runs, kind),
                 pa.array([collapse(w, r) for w, r in got], pa.binary())],
                names=["_out", "n_words", "runs", "collapsed"])
    return run


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 24) -> DataFrame:
    """(id, n_words, runs, collapsed) of every row.

    ``runs``: array of (start, length, period) by start, then period, counted in words
    (separated by ASCII white space).  ``collapsed``: the words, one blank between them, without
    those that a run holds after its first period (UTF-8 bytes).  Null texts and texts without words have no runs and an
    empty ``collapsed``; rows keep their ids, null and repeated ones too, and each is
    judged alone.  An empty table gives no rows; other columns are ignored.  A text is read whole
    however long it is, in one task: about 4 bytes a word for each doubling until all
    positions differ (20 million words with long repeats: 2 GB).  ``min_length``: 24 or more.
    """
    src = docs.select(F.col(id_col).alias("_out"), F.col(text_col).cast("string").alias("_text"))
    kind = src.schema["_out"].dataType.simpleString()
    return src.mapInArrow(_find(min_length), f"_out {kind}, n_words long, "
                          "runs array<struct<start:long,length:long,period:long>>, collapsed binary"
                          ).withColumnRenamed("_out", id_col)
