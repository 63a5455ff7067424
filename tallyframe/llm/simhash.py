"""SimHash near-duplicates: pigeonring filtering, then connected components.

Two 64-bit fingerprints that differ in at most ``t`` bits, cut into a ring
of 16 four-bit segments, have a start from which every chain of the next l
segments differs in at most l*t/16 bits in total.  For t = 3 that means: 5 equal
segments (20 bits), at most one difference in the next 5, at most two in the
first 15.  A fingerprint is therefore filed under 32 keys: each start, with the 20 equal
bits and either half of the next 20 (one of the halves has no
difference).  Pairs of one key are pruned by the chain budgets before the
full Hamming check.  Only distinct fingerprints take part, so copies cost
nothing, and a key yields a spanning forest of its links, never all pairs.
Keys with more than ``HOT`` fingerprints go a second, exact way of linear
size: a pair at distance 3 or less meets where one's neighbours at
distance 1 or less coincide with the other's at distance 2 or less.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import materialise, partitions
from tallyframe.llm.components import components

SEGMENTS, SEG_BITS = 16, 4
HOT = 4096       # fingerprints of one key that are compared pairwise in a task
SMALL = 8        # keys of up to so many are compared by shifts, all at once
ROW_CHUNK = 8192


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """64-bit SimHash of lower-cased (A-Z) words split at ASCII white space; no words: 0."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        grams = [joined]
    else:
        size = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1
        ends = np.cumsum(size) - 1
        starts = (ends - size + 1)[: len(words) - shingle + 1].tolist()
        grams = [joined[a:b] for a, b in zip(starts, ends[shingle - 1:].tolist())]
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(g, 42) for g in grams), dtype=np.uint64, count=len(grams))
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, len(h), ROW_CHUNK):
        part = h[i:i + ROW_CHUNK]
        ones += np.unpackbits(part.view(np.uint8).reshape(len(part), 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int = 3) -> DataFrame:
    """(_id, _fp) of every row; whole texts, null as empty."""
    def run(batches):
        for b in batches:
            texts = b.column("_text").cast(pa.binary())
            fp = np.fromiter((fingerprint(t.as_py() or b"", shingle) for t in texts), dtype=np.uint64, count=len(texts))
            yield pa.RecordBatch.from_arrays([b.column("_id"), pa.array(fp.view(np.int64))], names=["_id", "_fp"])

    src = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("_text"))
    return src.mapInArrow(run, "_id long, _fp long")


def ring_keys(fp):
    """The 32 keys of a fingerprint column."""
    keys = []
    for i in range(SEGMENTS):
        k = SEG_BITS * i
        rot = F.shiftleft(fp, k).bitwiseOR(F.shiftrightunsigned(fp, 64 - k)) if k else fp
        head = F.shiftrightunsigned(rot, 44)
        for half, by in ((0, 34), (1, 24)):
            tail = F.shiftrightunsigned(rot, by).bitwiseAND(F.lit(1023))
            keys.append(F.shiftleft(F.lit(2 * i + half).cast("long"), 30)
                        .bitwiseOR(F.shiftleft(head, 10)).bitwiseOR(tail))
    return F.array(*keys)


def _rotated(x: np.ndarray, key: np.ndarray) -> np.ndarray:
    k = ((key >> 31) * SEG_BITS).astype(np.uint64)
    return (x << k) | np.where(k == 0, np.uint64(0), x >> ((np.uint64(64) - k) & np.uint64(63)))


def _linked(x: np.ndarray, key: np.ndarray, t: int) -> np.ndarray:
    """Chain budgets of 10 and 15 segments, then the whole distance."""
    r = _rotated(x, key)
    ok = np.bitwise_count(r >> np.uint64(24)) <= 10 * t // SEGMENTS
    ok &= np.bitwise_count(r >> np.uint64(4)) <= 15 * t // SEGMENTS
    return ok & (np.bitwise_count(x) <= t)


def _forest(fps: np.ndarray, key: int, t: int) -> list[tuple[int, int]]:
    """Spanning forest of the links within one key."""
    u, left, out = fps.view(np.uint64), np.arange(len(fps)), []
    while len(left):
        seed, left = left[:1], left[1:]
        while len(seed) and len(left):
            hit = np.zeros(len(left), dtype=bool)
            frm = np.zeros(len(left), dtype=np.int64)
            for s in seed:
                ok = _linked(u[left] ^ u[s], np.full(len(left), key), t) & ~hit
                frm[ok] = s
                hit |= ok
            out += zip(fps[frm[hit]].tolist(), fps[left[hit]].tolist())
            seed, left = left[hit], left[~hit]
    return out


def _link_keys(t: int):
    """Rows sorted by key in, links (a, b) out; a key's rows lie in one partition."""
    def flush(key: np.ndarray, fp: np.ndarray):
        cut = np.flatnonzero(np.diff(key)) + 1
        start = np.concatenate(([0], cut))
        size = np.diff(np.concatenate((start, [len(key)])))
        each = np.repeat(size, size)
        a, b = [], []
        small = each <= SMALL
        for s in range(1, SMALL):
            ok = (key[s:] == key[:-s]) & small[s:]
            at = np.flatnonzero(ok)
            at = at[_linked(fp[at].view(np.uint64) ^ fp[at + s].view(np.uint64), key[at], t)]
            a.append(fp[at]); b.append(fp[at + s])
        for i in np.flatnonzero(size > SMALL):
            pairs = _forest(fp[start[i]:start[i] + size[i]], int(key[start[i]]), t)
            if pairs:
                x = np.array(pairs, dtype=np.int64)
                a.append(x[:, 0]); b.append(x[:, 1])
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"])

    def run(batches):
        rest_k, rest_f = np.empty(0, np.int64), np.empty(0, np.int64)
        for x in batches:
            k = np.concatenate((rest_k, x.column("key").to_numpy(zero_copy_only=False)))
            f = np.concatenate((rest_f, x.column("fp").to_numpy(zero_copy_only=False)))
            if not len(k):
                continue
            at = int(np.searchsorted(k, k[-1]))   # the last key may go on in the next batch
            if at:
                yield flush(k[:at], f[:at])
            rest_k, rest_f = k[at:], f[at:]
        if len(rest_k):
            yield flush(rest_k, rest_f)
    return run


def _ball_links(fps: DataFrame, t: int) -> DataFrame:
    """Links among all of ``fps`` through shared neighbours: radius 1 against radius t - 1.

    With t = 1 the second radius is 0: a neighbour met there is a fingerprint itself, at most 64 links each.
    """
    one = [0] + [1 << i for i in range(64)]
    two = {1: [0], 2: one, 3: sorted({x ^ y for x in one for y in one})}[t]
    signed = lambda xs: "array(" + ",".join(f"{x - (1 << 64) if x >> 63 else x}L" for x in xs) + ")"
    near = fps.select("fp", F.explode(F.expr(f"transform({signed(one)}, m -> fp ^ m)")).alias("c"))
    if t == 1:
        return near.join(fps.select(F.col("fp").alias("c")), "c").where("fp < c").select(F.col("fp").alias("a"), F.col("c").alias("b"))
    wide = fps.select("fp", F.explode(F.expr(f"transform({signed(two)}, m -> fp ^ m)")).alias("c"))
    low = near.groupBy("c").agg(F.min("fp").alias("a"))
    return wide.join(low, "c").where("fp != a").select("a", F.col("fp").alias("b")).distinct()


def simhash_links(fps: DataFrame, max_bits: int = 3, hot: int = HOT) -> DataFrame:
    """Links (a, b) whose components are those of all pairs within ``max_bits`` (1 to 3)."""
    if not 1 <= max_bits <= 3:
        raise ValueError("max_bits must be 1, 2 or 3")
    keyed = fps.select("fp", F.explode(ring_keys(F.col("fp"))).alias("key"))
    crowded = materialise(keyed.groupBy("key").count().where(F.col("count") > 1), "simhash-keys")
    most = crowded.agg(F.max("count")).first()[0]
    n = partitions(fps.sparkSession)
    cold = keyed.join(crowded.where(F.col("count") <= hot).select("key"), "key", "left_semi")
    links = (cold.repartition(n, "key").sortWithinPartitions("key", "fp").select("key", "fp")
             .mapInArrow(_link_keys(max_bits), "a long, b long"))
    if most is not None and most > hot:
        crowd = keyed.join(crowded.where(F.col("count") > hot).select("key"), "key", "left_semi").select("fp").distinct()
        links = links.union(_ball_links(materialise(crowd, "simhash-hot"), max_bits))
    return links


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                   max_bits: int = 3, hot: int = HOT) -> DataFrame:
    """(id, fingerprint, component_id) for every row.

    Fingerprints link at ``max_bits`` or fewer differing bits; component_id is the
    smallest id reachable, the row's own included.  Null and empty texts have
    fingerprint zero, linked like any other.  Null ids take part but are never a component's
    id unless it has no other; repeated rows come back repeated.  An empty table
    gives no rows; other columns are ignored.
    """
    rows = materialise(fingerprints(docs, id_col, text_col, shingle), "simhash-fp")
    firsts = materialise(rows.groupBy(F.col("_fp").alias("fp")).agg(F.min("_id").alias("low")), "simhash-distinct")
    roots = components(simhash_links(firsts.select("fp"), max_bits, hot), "a", "b")
    named = firsts.join(roots, firsts["fp"] == roots["node"], "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("root"))
    named = materialise(named, "simhash-roots")
    lowest = named.groupBy("root").agg(F.min("low").alias("component_id"))
    labels = materialise(named.join(lowest, "root").select("fp", "component_id"), "simhash-labels")
    return (rows.join(labels, rows["_fp"] == labels["fp"])
            .select(F.col("_id").alias(id_col), F.lpad(F.lower(F.hex("_fp")), 16, "0").alias("fingerprint"),
                    "component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """Rows of ``docs`` whose id names their component: one document of each group.

    Rows that repeat the kept id with the same fingerprint collapse to one; a
    group without any id keeps one row.  Of rows that share an id but not the fingerprint
    only those of components that the id names stay.  Columns come back as they are.
    """
    names = docs.columns
    safe = [c if c in (id_col, text_col) else f"_sim{i}" for i, c in enumerate(names)]
    docs = docs.toDF(*safe)
    groups = materialise(simhash_groups(docs, id_col, text_col, **kw).select(
        F.col(id_col).alias("_kid"), "fingerprint", "component_id"), "simhash-groups")
    kept = groups.where(F.col("_kid").eqNullSafe(F.col("component_id"))).groupBy("_kid", "fingerprint").agg(F.count("*").alias("_n"))
    kept = materialise(kept, "simhash-kept")
    ids = kept.select("_kid").distinct()
    mixed = materialise(groups.groupBy("_kid").agg(F.min("fingerprint").alias("f"), F.max("fingerprint").alias("l"))
                        .where("f != l").select("_kid"), "simhash-mixed")
    # one join plan at every size: the kept ids grow with the input
    same_id = F.col(id_col).eqNullSafe(F.col("_kid"))
    out = docs.join(ids.hint("merge"), same_id, "left_semi")
    if not mixed.isEmpty():
        # rows whose id has several fingerprints: theirs decides
        several = materialise(out.join(mixed.hint("merge"), same_id, "left_semi")
                              .withColumn("_row", F.monotonically_increasing_id()), "simhash-several")
        own = fingerprints(several, "_row", text_col, kw.get("shingle", 3)).select(
            F.col("_id").alias("_rid"), F.lpad(F.lower(F.hex("_fp")), 16, "0").alias("_f"))
        right = several.join(own, F.col("_row") == F.col("_rid")).join(
            kept.hint("merge"), same_id & (F.col("_f") == F.col("fingerprint")), "left_semi")
        out = out.join(mixed.hint("merge"), same_id, "left_anti").unionByName(right.select(*safe))
    if not kept.where("_n > 1").isEmpty():
        out = out.dropDuplicates([id_col, text_col])
    return out.toDF(*names)
