"""Sequence packing along a Hilbert curve over hashed document vectors.

A document's tokens are hashed with signs into ``DIM`` dimensions and
projected to three; the Hilbert key of that point orders the documents, so
neighbours on the curve are alike.  The documents, each with an end token, form one
stream in that order, cut every ``seq_len`` tokens: each id lies in
exactly one piece and only the very last sequence is padded.
"""

from __future__ import annotations

import base64
import re
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.llm.common import materialise, partitions

DIM, AXES, BITS = 256, 3, 20
CACHE_WORDS = 400_000       # distinct pieces remembered by a Python worker
SPECIAL = "<|endoftext|>"
_IRREGULAR = re.compile(r" \s")
_loaded: dict = {}


class _Pieces(dict):
    """Piece of text -> its ids as packed little-endian 16-bit numbers."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, piece):
        if len(self) >= CACHE_WORDS:
            self.clear()
        out = self[piece] = np.array(self.encode(piece), dtype="<u2").tobytes()
        return out


class ByteBpe:
    """Ids of a byte-level BPE vocabulary, as the ``tokenizers`` file gives them.

    Text is cut before single spaces, where this vocabulary never merges, and each
    distinct piece is encoded once, from the rank file of the same vocabulary.  Texts with runs of white space
    after a space, or with the special token's string, go through the ``tokenizers`` file whole.
    """

    def __init__(self, json_path: str, rank_path: str | None, pattern: str):
        from tokenizers import Tokenizer
        self.whole = Tokenizer.from_file(json_path)
        if rank_path:
            import tiktoken
            with open(rank_path, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
            self.pieces = _Pieces(fast.encode_ordinary)
        else:
            self.pieces = _Pieces(lambda s: self.whole.encode(s, add_special_tokens=False).ids)

    def ids(self, text: str) -> np.ndarray:
        if not text:
            return np.empty(0, dtype="<u2")
        if SPECIAL in text or _IRREGULAR.search(text):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, dtype="<u2")
        head, *rest = text.split(" ")
        parts = [self.pieces[head]] if head else []
        get = self.pieces.__getitem__
        parts += [get(" " + p) for p in rest]
        return np.frombuffer(b"".join(parts), dtype="<u2")


def tokenizer(paths: tuple[str, str | None, str]) -> ByteBpe:
    if paths not in _loaded:
        _loaded[paths] = ByteBpe(*paths)
    return _loaded[paths]


def hash_slots(vocab: int) -> np.ndarray:
    """Per token id: its hash dimension, plus DIM where its sign is negative."""
    ids = np.arange(vocab, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((ids >> np.uint64(40)) % np.uint64(DIM) + np.uint64(DIM) * (ids >> np.uint64(63) == 0)).astype(np.int64)


def projection() -> np.ndarray:
    """DIM dimensions to AXES."""
    return np.random.default_rng(20).standard_normal((DIM, AXES))


def hilbert_keys(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Hilbert index of integer points (n, axes), each coordinate below 2**bits."""
    x = points.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            set_ = (x[i] & q) != 0
            swap = np.where(set_, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(set_, x[0] ^ p, x[0] ^ swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t = np.where((x[n - 1] & q) != 0, t ^ (q - 1), t)
        q >>= 1
    x ^= t
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def document_vector(ids: np.ndarray, slots: np.ndarray) -> np.ndarray:
    """Signed counts of the hashed tokens."""
    n = np.bincount(slots[ids], minlength=2 * DIM)
    return n[:DIM] - n[DIM:]


def document_points(vectors: np.ndarray, plane: np.ndarray) -> np.ndarray:
    """The vectors (n, DIM), normalised, projected and squeezed to integers."""
    length = np.sqrt((vectors.astype(float) ** 2).sum(axis=1, keepdims=True))
    v = vectors @ plane / np.maximum(length, 1)
    return ((np.tanh(v / 4) + 1) / 2 * ((1 << BITS) - 1)).astype(np.int64)


def _tokenise(paths, end_id: int):
    def run(batches):
        tok = tokenizer(paths)
        slots, plane = hash_slots(1 << 16), projection()
        squeeze = zstandard.ZstdCompressor(level=1)
        end = np.array([end_id], dtype="<u2")
        for b in batches:
            vectors, counts, packed = [], [], []
            for t in b.column("_text").to_pylist():
                ids = tok.ids(t or "")
                vectors.append(document_vector(ids, slots))
                ids = np.append(ids, end)
                counts.append(len(ids))
                packed.append(squeeze.compress(ids.tobytes()))
            key = hilbert_keys(document_points(np.array(vectors).reshape(-1, DIM), plane))
            yield pa.RecordBatch.from_arrays(
                [b.column("_id"), pa.array(key), pa.array(counts, pa.int64()), pa.array(packed, pa.binary())],
                names=["_id", "_key", "_n", "_ids"])
    return run


def _cut(seq_len: int):
    def run(batches):
        open_ = zstandard.ZstdDecompressor()
        for b in batches:
            out = [[] for _ in range(7)]
            for doc, n, packed, at in zip(b.column("_id").to_pylist(), b.column("_n").to_pylist(),
                                          b.column("_ids").to_pylist(), b.column("_at").to_pylist()):
                ids = np.frombuffer(open_.decompress(packed), dtype="<u2").astype("<u4")
                start = 0
                while start < n:
                    seq, off = divmod(at + start, seq_len)
                    size = min(seq_len - off, n - start)
                    for col, v in zip(out, (doc, start, size, zlib.crc32(ids[start:start + size].tobytes()), n, seq, off)):
                        col.append(v)
                    start += size
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=PIECE)
    return run


PIECE = ["_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def pack(docs: DataFrame, paths: tuple[str, str | None, str], id_col: str = "doc_id", text_col: str = "text",
         seq_len: int = 2048, end_id: int = 1) -> DataFrame:
    """Pieces (id, start, length, ids_crc32, doc_tokens, sequence_id, offset) of packed documents.

    ``paths``: the tokenizers file, optionally the rank file of the same
    vocabulary, and its split pattern.  Null and empty texts are a lone end token.  Documents
    of any length are cut at sequence ends.  Equal keys are ordered by id, then row;
    repeated rows are packed each.  An empty table gives no pieces; other columns are ignored.
    """
    spark = docs.sparkSession
    src = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("_text"))
    tokens = materialise(src.mapInArrow(_tokenise(paths, end_id), "_id long, _key long, _n long, _ids binary")
                         .withColumn("_row", F.monotonically_increasing_id()), "pack-tokens")
    order = ["_key", "_id", "_row"]
    parts = partitions(spark)
    thin = materialise(tokens.select("_row", "_key", "_id", "_n").repartitionByRange(parts, *order)
                       .withColumn("_part", F.spark_partition_id()), "pack-order")
    sums = thin.groupBy("_part").agg(F.sum("_n").alias("_sum"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    base = sums.select("_part", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_base"))
    within = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = (thin.withColumn("_run", F.coalesce(F.sum("_n").over(within), F.lit(0))).join(base, "_part")
              .select("_row", (F.col("_base") + F.col("_run")).alias("_at")))
    pieces = tokens.join(placed.hint("merge"), "_row").select("_id", "_n", "_ids", "_at").mapInArrow(
        _cut(seq_len), ", ".join(f"{c} long" for c in PIECE))
    return pieces.withColumnRenamed("_id", id_col)
