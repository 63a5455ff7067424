"""Exact repeated-substring removal by anchors with direct hashes, in place of rank doubling.

A byte goes if it lies in a ``length``-byte string that also starts earlier
(smaller id, or earlier in the same document).  Prefix doubling ranks all
positions by pairs of ranks at doubling offsets, and drops a position once
its rank is unique.  Here nothing is paired or sorted: only anchors are looked at, in three fixed rounds of
direct hashes of the strings there.  Every window of
``length`` bytes elects the smallest hash among its grams of the shortest
length, leftmost first, so equal windows elect equal anchors at equal
offsets, and an anchor stands for all neighbouring windows that elected
it.  Rounds, each a Spark aggregation by 64-bit hashes (128 bits where
equality decides):

1. grams (the part that all of an anchor's windows share): unique ones drop out;
2. the whole stretch of an anchor's windows: where it is equal to an earlier
   one, all its windows repeat; the first of each stretch stays on if its gram has
   several stretches;
3. the same for runs of 8 windows, whose shared part is longer;
4. single windows, exact.

Positions come back from one scan of the texts per round, cut down by a
Bloom filter of the survivors; a false positive is merely ranked once more.
Texts travel only in the last join.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.bloom import BlockedBloom, xx64
from tallyframe.llm.common import materialise

BLOCK = 1 << 20          # bytes looked at together; below 2**24, see _elect
RUN = 8                  # windows of a round-3 run
BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
_tables: dict = {}


def _powers(base: int, n: int) -> np.ndarray:
    if base not in _tables or len(_tables[base]) < n:
        x = np.full(max(n, 2 * BLOCK), base, np.uint64)
        x[0] = 1
        _tables[base] = np.cumprod(x, dtype=np.uint64)
    return _tables[base][:n]


class Block:
    """Texts joined, with running sums that name any substring in constant time."""

    def __init__(self, data: bytes):
        x = np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1)
        self.n = len(x)
        self.run = [np.concatenate((np.zeros(1, np.uint64), np.cumsum(x * _powers(b, self.n), dtype=np.uint64)))
                    for b in BASES]
        self.inv = [_powers(pow(b, -1, 1 << 64), self.n + 1) for b in BASES]

    def name(self, which: int, start: np.ndarray, end: np.ndarray, salt=0) -> np.ndarray:
        h = (self.run[which][end] - self.run[which][start]) * self.inv[which][start]
        h = h + np.asarray(salt).astype(np.uint64) * np.uint64(0x2545F4914F6CDD1D)
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        return h ^ (h >> np.uint64(32))


def span_of(length: int) -> int:
    """Windows one anchor may stand for: a power of two below two thirds of ``length``, RUN at least."""
    return 1 << max(3, (2 * length // 3).bit_length() - 1)


def _elect(block: Block, ends: np.ndarray, length: int):
    """(anchor, first window, last window) of each anchor; ends: per position the end of its text."""
    w = span_of(length)
    k = length - w + 1
    m = block.n - k + 1
    if block.n < length:
        return (np.empty(0, np.int64),) * 3
    at = np.arange(m, dtype=np.int64)
    low = (block.name(0, at, at + k) >> np.uint64(24) << np.uint64(24)) | at.astype(np.uint64)
    step = 1
    while step < w:
        low = np.minimum(low[:-step], low[step:])
        step *= 2
    p = np.flatnonzero(np.arange(len(low)) + length <= ends[:len(low)])
    if not len(p):
        return (np.empty(0, np.int64),) * 3
    x = (low[p] & np.uint64((1 << 24) - 1)).astype(np.int64)
    new = np.flatnonzero((np.diff(x) != 0) | (np.diff(p) != 1)) + 1
    first, last = np.concatenate(([0], new)), np.concatenate((new - 1, [len(p) - 1]))
    return x[first], p[first], p[last]


def anchors(ids: np.ndarray, texts: list[bytes], length: int):
    """Per block of texts: the block, and per anchor its text's index, base offset, place and window offsets."""
    i = 0
    while i < len(texts):
        if len(texts[i]) > 2 * BLOCK:       # a long text in stretches of windows
            t = texts[i]
            for s in range(0, len(t) - length + 1, BLOCK):
                part = t[s:s + BLOCK + length - 1]
                b = Block(part)
                x, lo, hi = _elect(b, np.full(len(part), len(part)), length)
                yield b, np.full(len(x), i), np.full(len(x), s), x, x - hi, x - lo
            i += 1
            continue
        j, size = i, 0
        while j < len(texts) and len(texts[j]) <= 2 * BLOCK and (size == 0 or size + len(texts[j]) <= BLOCK):
            size += len(texts[j])
            j += 1
        lens = np.array([len(t) for t in texts[i:j]])
        starts = np.cumsum(lens) - lens
        b = Block(b"".join(texts[i:j]))
        x, lo, hi = _elect(b, np.repeat(starts + lens, lens), length)
        doc = np.searchsorted(starts, x, "right") - 1
        yield b, doc + i, -starts[doc], x, x - hi, x - lo
        i = j


def _place(x, lo, hi):
    """Anchor place and window offsets in one number: x, then 7 + 7 bits (offsets are below 128)."""
    return (x << 14) | (lo << 7) | hi


def _runs(x, lo, hi, size: int):
    """Split offset ranges at multiples of ``size``: index of the anchor, low and high of each part."""
    n = hi // size - lo // size + 1
    who = np.repeat(np.arange(len(x)), n)
    part = np.arange(len(who)) - np.repeat(np.cumsum(n) - n, n) + (lo // size)[who]
    return who, np.maximum(lo[who], part * size), np.minimum(hi[who], part * size + size - 1)


def _texts(b):
    return b.column("_id").to_numpy(zero_copy_only=False), [t or b"" for t in b.column("_text").cast(pa.binary()).to_pylist()]


def _gram_names(length: int):
    k = length - span_of(length) + 1

    def run(batches):
        for b in batches:
            for block, _, _, x, _, _ in anchors(*_texts(b), length):
                yield pa.RecordBatch.from_arrays([pa.array(block.name(0, x, x + k).view(np.int64))], names=["g"])
    return run


def _candidates(length: int, filters: list):
    """Per document the surviving places of a round, with the names of shared part and whole stretch.

    ``filters``: Bloom filters of the rounds before, broadcast; their number tells the round.
    """
    k = length - span_of(length) + 1

    def run(batches):
        for b in batches:
            ids, texts = _texts(b)
            docs, places, shared, whole = [], [], [], []
            for block, doc, base, x, lo, hi in anchors(ids, texts, length):
                g = block.name(0, x, x + k)
                ok = np.flatnonzero(filters[0].value.probe(g.view(np.int64)))
                doc, base, x, lo, hi, g = (a[ok] for a in (doc, base, x, lo, hi, g))
                rid = ids[doc]
                for level, size in ((1, RUN), (2, 1)):
                    if len(filters) <= level:
                        break
                    key = xx64(_place(x + base, lo, hi), xx64(rid))
                    ok = np.flatnonzero(filters[level].value.probe(key.view(np.int64)))
                    who, plo, phi = _runs(x[ok], lo[ok], hi[ok], size)
                    doc, base, x, lo, hi = doc[ok][who], base[ok][who], x[ok][who], plo, phi
                    rid = ids[doc]
                    top = lo // size * size      # the run's smallest offset: its shared part starts there
                    g = block.name(0, x - top, x - top - size + 1 + length, salt=top + 1)
                if len(x):
                    docs.append(doc)
                    places.append(_place(x + base, lo, hi))
                    shared.append(g.view(np.int64))
                    whole.append(block.name(1, x - hi, x - lo + length, salt=(lo << 7) | hi).view(np.int64))
            if not docs:
                continue
            doc = np.concatenate(docs)
            cut = np.flatnonzero(np.diff(doc)) + 1
            offsets = pa.array(np.concatenate(([0], cut, [len(doc)])), pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(v))) for v in (places, shared, whole)]
            yield pa.RecordBatch.from_arrays([pa.array(ids[doc[np.concatenate(([0], cut))]]), *lists],
                                             names=["_id", "at", "g", "w"])
    return run


def _finish(length: int, with_text: bool):
    def run(batches):
        for b in batches:
            n_bytes, removed, spans, digest = [], [], [], []
            for t, gone in zip(b.column("_text").cast(pa.binary()).to_pylist(), b.column("gone").to_pylist()):
                t = t or b""
                n_bytes.append(len(t))
                kept, last, cut, runs = [], 0, 0, 0
                if gone:
                    p = np.array(gone, dtype=np.int64)
                    x, lo, hi = p >> 14, (p >> 7) & 127, p & 127
                    start, end = x - hi, x - lo + length
                    order = np.argsort(start, kind="stable")
                    s0 = e0 = -1
                    for s, e in zip(start[order].tolist(), end[order].tolist()):
                        if s > e0 or s0 < 0:
                            if s0 >= 0:
                                kept.append(t[last:s0]); last = e0; cut += e0 - s0; runs += 1
                            s0, e0 = s, e
                        else:
                            e0 = max(e0, e)
                    kept.append(t[last:s0]); last = e0; cut += e0 - s0; runs += 1
                kept.append(t[last:])
                removed.append(cut)
                spans.append(runs)
                digest.append(b"".join(kept))
            yield pa.RecordBatch.from_arrays(
                [b.column("_out"), pa.array(n_bytes, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(spans, pa.int64()), pa.array([hashlib.sha256(d).hexdigest() for d in digest]),
                 *([pa.array(digest, pa.binary())] if with_text else [])],
                names=["_out", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"][:5 + with_text])
    return run


def _numbered(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(_id, _out, _text): ids themselves where they are unique, else numbers in their order."""
    src = docs.select(F.col(id_col).cast("long").alias("_out"), F.col(text_col).cast("string").alias("_text"))
    if src.where("_out is null").isEmpty() and src.groupBy("_out").count().where("count > 1").isEmpty():
        return src.withColumn("_id", F.col("_out"))
    ranged = src.repartitionByRange("_out", F.xxhash64("_text")).sortWithinPartitions("_out", F.xxhash64("_text"))
    return materialise(ranged.withColumn("_id", F.monotonically_increasing_id()), "suffix-docs")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 100,
                   with_text: bool = True) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256) of every row; ``with_text`` adds ``kept``, the remaining bytes.

    Strings are judged on the input and never cross documents.  Null texts are empty;
    texts shorter than ``length`` keep all bytes; texts of any length are read whole.  Rows without an
    id come first, rows of one id follow each other by a hash of the text, so all but the
    first of repeated rows lose their repeats.  An empty table gives no rows;
    other columns are ignored.  ``length``: 24 to 190.
    """
    if not 24 <= length <= 190:
        raise ValueError("length must be 24 to 190")
    sc = docs.sparkSession.sparkContext
    src = _numbered(docs, id_col, text_col)
    scan = src.select("_id", "_text").where(F.octet_length("_text") >= length)
    names = scan.mapInArrow(_gram_names(length), "g long")
    repeated = materialise(names.groupBy("g").count().where("count > 1").select("g"), "suffix-grams")
    filters = [sc.broadcast(BlockedBloom.build(repeated, "g"))]
    rounds = []
    for level in range(3):
        found = materialise(scan.mapInArrow(_candidates(length, list(filters)),
                                            "_id long, at array<long>, g array<long>, w array<long>"), "suffix-round")
        each = found.select("_id", F.explode(F.arrays_zip("at", "g", "w")).alias("x")).select("_id", "x.*")
        firsts = materialise(each.groupBy("g", "w").agg(F.min(F.struct("_id", "at")).alias("f"))
                             .select("g", "f.*"), "suffix-firsts")
        rounds.append((found, firsts))
        if level == 2:
            break
        several = firsts.groupBy("g").count().where("count > 1").select("g")
        survivors = firsts.join(several, "g", "left_semi").select(F.xxhash64("_id", "at").alias("key"))
        filters.append(sc.broadcast(BlockedBloom.build(survivors, "key")))
    gone = None
    for found, firsts in rounds:
        stay = firsts.groupBy("_id").agg(F.collect_list("at").alias("stay"))   # at most a document's anchors
        part = (found.select("_id", "at").groupBy("_id").agg(F.flatten(F.collect_list("at")).alias("at"))
                .join(stay, "_id", "left")
                .select("_id", F.array_except("at", F.coalesce("stay", F.array().cast("array<long>"))).alias("gone"))
                .where(F.size("gone") > 0))
        gone = part if gone is None else gone.union(part)
    gone = materialise(gone.groupBy("_id").agg(F.flatten(F.collect_list("gone")).alias("gone")), "suffix-gone")
    out = (src.join(gone, "_id", "left").select("_out", "_text", "gone")
           .mapInArrow(_finish(length, with_text), "_out long, n_bytes long, n_removed long, n_spans long, "
                                                   "kept_sha256 string" + ", kept binary" * with_text))
    return out.withColumnRenamed("_out", id_col)
