"""Benchmark decontamination by the q-gram lemma.

A benchmark passage of n characters occurs in a document with at most k
edits only if the two share at least n + 1 - q - k*q q-grams whose
diagonals (place in the document minus place in the passage) span at most k.  Shared q-grams are
counted in bands of 2(k + 1) diagonals that overlap by half, so any such
span lies whole in some band; bands that reach the bound are verified by
banded alignment.  Passages are whole items, cut where they exceed
``passage`` characters; where none of these is found, windows that overlap
over the whole item are, so that excerpts are found too: at a stride of a
third of WINDOW or a tenth of the item, any excerpt of WINDOW * 4 / 3
characters or of 90 % of the item (from 50 characters on) holds a whole window.

Items under SHORTEST characters must occur unchanged and between word ends; under Q characters they must be the
whole document.

Letter case and the kind and amount of white space don't matter: both sides are normalised alike,
and places are those of the document as given.  The q-gram table is broadcast in blocks of
bounded size; a larger benchmark takes more scans of the documents.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Q = 10
EDIT_RATE = 0.06
PASSAGE = 400            # characters; longer items are cut
WINDOW = 150             # characters of the overlapping windows over an item
SHORTEST = 40            # items under this must occur unchanged
BLOCK_CHARS = 4_000_000  # benchmark characters per broadcast table
STRETCH = 1 << 20        # document characters looked at together
_BLANK = np.array([chr(c).isspace() for c in range(0x3002)])   # all white space lies below the last entry
_BASE = np.uint64(0x9E3779B97F4A7C15)


def normalise(text: str) -> tuple[np.ndarray, np.ndarray | None]:
    """Code points of the lowered text, each run of white space as one blank, and where each was in the
    text (None: all in their places)."""
    low = text.lower()
    x = np.frombuffer(low.encode("utf-32-le", "replace"), dtype=np.uint32)
    places = None if len(low) == len(text) else np.repeat(np.arange(len(text)), [len(c.lower()) for c in text])
    blank = _BLANK[np.minimum(x, len(_BLANK) - 1)]
    x = np.where(blank, np.uint32(32), x)
    again = np.flatnonzero(blank[1:] & blank[:-1]) + 1
    if len(again):
        places = np.delete(np.arange(len(x)) if places is None else places, again)
        x = np.delete(x, again)
    return x, places


def gram_hashes(x: np.ndarray, q: int = Q) -> np.ndarray:
    """Polynomial hash of every q-gram, put together from grams of 1, 2, 4 ... characters."""
    n = len(x) - q + 1
    if n < 1:
        return np.empty(0, np.uint64)
    part, size, out, done = x.astype(np.uint64), 1, None, 0
    while True:
        shift = np.uint64(pow(int(_BASE), size, 1 << 64))
        if q & size:
            out = part[done:done + n] if out is None else out * shift + part[done:done + n]
            done += size
        if 2 * size > q:
            return out ^ (out >> np.uint64(29))
        part = part[:-size] * shift + part[size:]
        size *= 2


@dataclass
class Table:
    """Items with all their q-grams, sorted by hash, behind a bitmap."""
    items: np.ndarray        # item id of each text
    texts: list[np.ndarray]
    spans: list[tuple[list, list]]   # of each text: (start, end) of its parts, and of its windows
    least: np.ndarray        # shared q-grams that any span of the text needs
    grams: np.ndarray        # sorted hashes
    owner: np.ndarray        # text of each gram
    place: np.ndarray        # its place there
    seen: np.ndarray         # bitmap over 22 hash bits
    tiny: dict               # items of texts under q characters, by text


def parts_of(n: int, passage: int = PASSAGE, shortest: int = SHORTEST) -> list[tuple[int, int]]:
    """The whole text, or equal parts of at most ``passage`` characters."""
    m = max(1, -(-n // passage))
    cuts = [n * i // m for i in range(m + 1)]
    return [(a, b) for a, b in zip(cuts, cuts[1:]) if m == 1 or b - a >= shortest]


def windows_of(n: int, window: int = WINDOW, shortest: int = SHORTEST) -> list[tuple[int, int]]:
    """Overlapping windows over a text: any stretch of window * 4 / 3 characters, or of 90 % of 50 or more, holds one."""
    w = min(window, max(shortest, n * 4 // 5))
    if n <= w:
        return []
    step = max(1, min(window // 3, n // 10))
    return [(a, a + w) for a in [*range(0, n - w, step), n - w]]


def build_table(rows: list[tuple[int, str]], passage: int = PASSAGE, q: int = Q) -> Table:
    items, texts, spans, least, grams, owner, place, tiny = [], [], [], [], [], [], [], {}
    for item, text in rows:
        x = normalise((text or "").strip())[0]
        if len(x) < q:
            if len(x):
                tiny.setdefault(x.tobytes(), []).append(item)
            continue
        h = gram_hashes(x, q)
        grams.append(h)
        owner.append(np.full(len(h), len(texts)))
        place.append(np.arange(len(h)))
        items.append(item)
        texts.append(x)
        spans.append((parts_of(len(x), passage), windows_of(len(x))))
        least.append(min(needed(b - a, q=q) for s in spans[-1] for a, b in s))
    g, o, p = (np.concatenate(a) if a else np.empty(0, t) for a, t in
               ((grams, np.uint64), (owner, np.int64), (place, np.int64)))
    turn = np.argsort(g, kind="stable")
    seen = np.zeros(1 << 22, bool)
    seen[(g >> np.uint64(42)).astype(np.int64)] = True
    return Table(np.array(items, np.int64), texts, spans, np.array(least, np.int64), g[turn], o[turn], p[turn], seen, tiny)


def budget(n: int, rate: float = EDIT_RATE, q: int = Q) -> int:
    """Edits allowed in n characters: the rate's share, as far as the lemma's bound stays positive."""
    return max(0, min(int(n * rate), (n - q) // q)) if n >= SHORTEST else 0


def needed(n: int, rate: float = EDIT_RATE, q: int = Q) -> int:
    """q-grams that a passage of n characters shares with any place it is found at."""
    return n + 1 - q - budget(n, rate, q) * q


def banded_distance(passage: np.ndarray, text: np.ndarray, low: int, width: int, most: int) -> tuple[int, int]:
    """Least edits (over ``most``: most + 1) between the passage and any stretch of the text whose diagonals
    lie in [low, low + width), and where that stretch ends."""
    if not len(text):
        return min(len(passage), most + 1), 0
    span = np.arange(width)
    row = np.where((low + span >= 0) & (low + span <= len(text)), 0, most + 1)   # free start in the text
    for i in range(1, len(passage) + 1):
        at = low + i + span                      # text characters used so far on each diagonal
        inside = (at >= 1) & (at <= len(text))
        same = inside & (text[np.clip(at - 1, 0, len(text) - 1)] == passage[i - 1])
        new = row + np.where(inside, ~same, most + 1)
        new[:-1] = np.minimum(new[:-1], row[1:] + 1)              # passage character left out
        new = np.where((at >= 0) & (at <= len(text)), new, most + 1)
        row = np.minimum.accumulate(new - span) + span            # text character left out
        if row.min() > most:
            return most + 1, -1
    best = int(row.argmin())
    return int(min(row[best], most + 1)), int(low + len(passage) + best)


def _stands_alone(x: np.ndarray, start: int, end: int) -> bool:
    """Neither end of the stretch cuts a word."""
    word = lambda i: 0 <= i < len(x) and chr(x[i]).isalnum()
    return not (word(start - 1) and word(start)) and not (word(end - 1) and word(end))


def _best_place(x: np.ndarray, passage: np.ndarray, diagonal: np.ndarray, rate: float, q: int):
    """(start, end, edits) of the passage's best place on the diagonals of its shared q-grams, or None."""
    n = len(passage)
    k, need = budget(n, rate, q), needed(n, rate, q)
    if len(diagonal) < need:
        return None
    half = k + 1
    lines, on_line = np.unique(diagonal, return_counts=True)
    if n < SHORTEST:
        return next(((d, d + n, 0) for d in lines[on_line >= need].tolist()
                     if np.array_equal(x[d:d + n], passage) and _stands_alone(x, d, d + n)), None)
    cells, first = np.unique(lines // half, return_index=True)
    both = dict(zip(cells.tolist(), np.add.reduceat(on_line, first).tolist()))
    best = None
    for c in sorted({y for v in both for y in (v - 1, v)}):   # band c covers cells c and c + 1
        if both.get(c, 0) + both.get(c + 1, 0) < need:
            continue
        low = c * half
        inside = slice(*np.searchsorted(lines, (low, low + 2 * half)))
        d = int(lines[inside][on_line[inside].argmax()])
        if d >= 0 and np.array_equal(x[d:d + n], passage):
            return d, d + n, 0
        edits, end = banded_distance(passage, x, low, 2 * half, k)
        if edits <= k and (best is None or edits < best[2]):
            best = (max(0, end - n), end, edits)
            if not edits:
                break
    return best


def regions(x: np.ndarray, table: Table, rate: float = EDIT_RATE, q: int = Q):
    """(item, start, end, edits) of every text of the table found in the document: at its part with the fewest
    edits, else at its window with the fewest."""
    if len(x) < q + 2:   # blanks may stand around a tiny text
        start = int(len(x) > 0 and x[0] == 32)
        bare = x[start:len(x) - 1 if len(x) > start and x[-1] == 32 else len(x)]
        for item in table.tiny.get(bare.tobytes(), ()):
            yield item, start, start + len(bare), 0
    hits_at, hits_gram = [], []
    for s in range(0, max(1, len(x) - q + 1), STRETCH):
        h = gram_hashes(x[s:s + STRETCH + q - 1], q)
        maybe = np.flatnonzero(table.seen[(h >> np.uint64(42)).astype(np.int64)])
        if len(maybe):
            lo = np.searchsorted(table.grams, h[maybe], "left")
            n = np.searchsorted(table.grams, h[maybe], "right") - lo
            first = np.repeat(np.cumsum(n) - n, n)
            hits_gram.append(np.repeat(lo, n) + np.arange(n.sum()) - first)
            hits_at.append(np.repeat(maybe + s, n))
    if not hits_at:
        return
    gram, at = np.concatenate(hits_gram), np.concatenate(hits_at)
    owner = table.owner[gram]
    enough = np.bincount(owner, minlength=len(table.least)) >= table.least
    kept = np.flatnonzero(enough[owner])
    if not len(kept):
        return
    owner, place, at = owner[kept], table.place[gram[kept]], at[kept]
    turn = np.lexsort((place, owner))
    owner, place, at = owner[turn], place[turn], at[turn]
    for part in np.split(np.arange(len(owner)), np.flatnonzero(np.diff(owner)) + 1):
        who = int(owner[part[0]])
        where, diagonal = place[part], at[part] - place[part]
        best = None
        for spans in table.spans[who]:
            for a, b in spans:
                i, j = np.searchsorted(where, (a, b - q + 1))
                if j - i < needed(b - a, rate, q):
                    continue
                got = _best_place(x, table.texts[who][a:b], diagonal[i:j] + a, rate, q)
                if got and (best is None or (got[2], got[0]) < (best[2], best[0])):
                    best = got
                    if not got[2]:
                        break
            if best:
                yield int(table.items[who]), *best
                break


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_col: str = "item_id", item_text_col: str = "text", passage: int = PASSAGE,
               block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(id, item_id, start, end, edits): passages of benchmark items found in documents.

    One row per document row and item, at the part with the fewest edits or else the window; documents without
    any give no row.  Places count characters.  Null and empty texts or items have no passages; texts of any length are searched whole; rows repeated in either
    table are searched each.  Empty tables give no rows; other columns are ignored.
    """
    sc = docs.sparkSession.sparkContext
    src = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("_text"))
    schema = "_id long, item_id long, start long, end long, edits long"

    def search(shared):
        def run(batches):
            table = shared.value
            for b in batches:
                out = []
                for doc, t in zip(b.column("_id").to_pylist(), b.column("_text").to_pylist()):
                    found: dict = {}
                    x, places = normalise(t or "")
                    for item, start, end, edits in regions(x, table):
                        if places is not None:
                            start, end = int(places[start]), int(places[end - 1]) + 1
                        if item not in found or (edits, start) < (found[item][2], found[item][0]):
                            found[item] = (start, end, edits)
                    out += [(doc, item, *v) for item, v in sorted(found.items())]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)],
                                                     names=["_id", "item_id", "start", "end", "edits"])
        return src.mapInArrow(run, schema)

    found, block, size = None, [], 0
    items = benchmark.select(F.col(item_col).cast("long"), F.col(item_text_col).cast("string")).where(
        F.col(item_text_col).isNotNull())
    for r in items.toLocalIterator():      # one bounded block at a time
        block.append((r[0] if r[0] is not None else -1, r[1]))
        size += len(r[1])
        if size >= block_chars:
            part = search(sc.broadcast(build_table(block, passage)))
            found, block, size = part if found is None else found.union(part), [], 0
    if block or found is None:
        part = search(sc.broadcast(build_table(block, passage)))
        found = part if found is None else found.union(part)
    return found.withColumnRenamed("_id", id_col)
