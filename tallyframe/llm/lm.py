"""Gated recurrent language model with a class-factored softmax, in numpy.

Word counts cover all training documents.  The ``n_frequent`` most frequent
words form equal-sized classes by rank; every other word belongs to one of ``N_REST`` further
classes by a hash of its first bytes.  The network gives the class and,
for frequent words, the word within its class; other words follow
their counts (plus one) within their class, one share being kept for unseen
words, so the probabilities of known and unseen words sum to one.

Training: all training documents are dealt by a hash of id and text to rounds and, within each, to trainer tasks,
whose number grows with the text, so that copies of one text spread over all of them.  Each runs truncated
backpropagation from common starting weights on its part; the weighted mean of their weights, summed on Spark, is
the next round's start.  Every training document is trained on once.  Scoring carries the state over
the windows of a whole document, however long.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import materialise

END = "\n"             # the end token's key; no word holds white space
CLASS_WORDS = 64
N_REST = 96
HIDDEN = 16
WINDOW = 32
ROWS = 512             # targets per block of the class softmax
LOGIT = 60.0           # logits up to this size are exponentiated as they are (32-bit floats hold e to the 88)
LANES = (32, 512)      # least and most stretches trained side by side
PIECE = 256            # training stretch; scoring runs over whole documents
COUNTER_WORDS = 400_000  # distinct words that a counting task holds before it passes them on
TRAINER_CHARS = 1 << 25  # characters of training text per trainer task, from the least number of trainers on
CHUNK = 1 << 14          # weights in a row of the trainers' sums
KEPT_WORDS = 1 << 17     # most frequent words whose counts every task gets


def rest_class(word: str) -> int:
    return zlib.crc32(word.encode("utf-8")[:3]) % N_REST


def rest_class_column(word):
    return F.crc32(F.substring(F.encode(word, "utf-8"), 1, 3)) % N_REST


def held_out(id_col: str):
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 7 == 2, F.lit(False))


def _words(text: bytes) -> list[bytes]:
    return text.lower().split()


def count_words(docs: DataFrame, text_col: str) -> DataFrame:
    """(word, n) over whole texts, one end token per row; counted in tasks, then summed."""
    def run(batches):
        seen: Counter = Counter()

        def passed_on():
            out = pa.RecordBatch.from_arrays(
                [pa.array(list(seen), pa.binary()).cast(pa.string()), pa.array(list(seen.values()), pa.int64())],
                names=["word", "n"])
            seen.clear()
            return out

        for b in batches:
            for t in b.column(0).cast(pa.binary()):
                seen.update(_words(t.as_py() or b""))
                seen[END.encode()] += 1
                if len(seen) > COUNTER_WORDS:
                    yield passed_on()
        if seen:
            yield passed_on()

    part = docs.select(F.col(text_col).cast("string").alias("t")).mapInArrow(run, "word string, n long")
    return part.groupBy("word").agg(F.sum("n").alias("n"))


@dataclass
class Vocab:
    ids: dict          # kept word -> rank
    counts: np.ndarray  # of kept words
    n_frequent: int
    rest_total: np.ndarray  # counts plus one of the words outside the network, by rest class
    n: int
    v: int

    @property
    def n_classes(self) -> int:
        return self.n_frequent // CLASS_WORDS + N_REST


def build_vocab(counts: DataFrame, n_frequent: int, kept: int = KEPT_WORDS) -> Vocab:
    """At most ``kept`` words and one number per rest class reach the driver."""
    n, v = counts.agg(F.sum("n"), F.count("*")).first()
    n, v = n or 0, v or 0
    # smallest count that at most ``kept`` words reach, read from a histogram of the counts
    coarse = F.when(F.col("n") < 1024, F.col("n")).otherwise(F.expr("shiftleft(1L, cast(floor(log2(n)) as int))"))
    least, so_far = None, 0
    for r in sorted(counts.groupBy(coarse.alias("c")).count().collect(), reverse=True):
        so_far += r["count"]
        if so_far > kept:
            break
        least = r["c"]
    top = counts.where(F.col("n") >= least) if least is not None else counts.limit(0)
    top = top.toPandas().sort_values(["n", "word"], ascending=[False, True])
    n_frequent = min(n_frequent, len(top)) // CLASS_WORDS * CLASS_WORDS
    ids = {w: i for i, w in enumerate(top["word"].tolist())}
    all_rest = {r["c"]: r["s"] for r in counts.groupBy(rest_class_column(F.col("word")).alias("c"))
                .agg(F.sum(F.col("n") + 1).alias("s")).collect()}
    rest = np.array([all_rest.get(c, 0) for c in range(N_REST)], dtype=np.float64)
    kept_n = top["n"].to_numpy(dtype=np.int64)
    for w, c in zip(top["word"].iloc[:n_frequent], kept_n[:n_frequent]):
        rest[rest_class(w)] -= c + 1
    return Vocab(ids, kept_n, n_frequent, rest, int(n), int(v))


def initial(vocab: Vocab, seed: int = 8) -> dict[str, np.ndarray]:
    """Small random weights; output biases start at the counts."""
    rng = np.random.default_rng(seed)
    k, h, c = vocab.n_frequent, HIDDEN, vocab.n_classes
    freq = vocab.counts[:k].astype(np.float64) + 1
    by_class = np.concatenate((freq.reshape(-1, CLASS_WORDS).sum(axis=1) if k else np.empty(0), vocab.rest_total + 1))
    w = {"in": rng.normal(0, 0.1, (k + N_REST, 3 * h)), "rec": rng.normal(0, 0.2, (h, 3 * h)),
         "gate": np.zeros(3 * h), "cls": rng.normal(0, 0.1, (h, c)), "cls_b": np.log(by_class / by_class.sum()),
         "word": rng.normal(0, 0.1, (k, h)), "word_b": np.log(freq)}
    return {n: x.astype(np.float32) for n, x in w.items()}


def _by_gate(x):
    """Weights of the three gates side by side as three blocks, so that what is done to one gate's values runs over unbroken memory."""
    return np.ascontiguousarray(x.reshape(len(x), 3, HIDDEN).transpose(1, 0, 2))


def _step(a, rec, h):
    """One gated step for prepared inputs ``a`` (input weights and gate biases) and states ``h``: new state and
    what backpropagation needs.  ``a`` and ``rec`` hold one block a gate."""
    u = h @ rec
    rz = a[:2] + u[:2]
    np.negative(rz, out=rz)
    np.exp(rz, out=rz)
    rz += 1
    np.reciprocal(rz, out=rz)
    r, z, uc = rz[0], rz[1], u[2]
    c = r * uc
    c += a[2]
    np.tanh(c, out=c)
    new = h - c
    new *= z
    new += c
    return new, (r, z, c, uc)


def _small(into_logits, bias) -> bool:
    """No logit of states within -1 and 1 can pass LOGIT, so that exponentials need no shift.  One row a column of logits."""
    return not bias.size or float((np.abs(into_logits).sum(axis=1) + np.abs(bias)).max()) < LOGIT


def _softmax(z, at, small, probs):
    """Log-probability of column ``at`` of each row; with ``probs``, ``z`` becomes the probabilities."""
    if not small:
        z -= z.max(axis=1, keepdims=True)
    row = np.arange(len(z))
    out = z[row, at]
    np.exp(z, out=z)
    total = z @ np.ones(z.shape[1], z.dtype)
    if probs:
        z *= (1 / total)[:, None]
    return out - np.log(total)


def _class_of(y, k):
    """Class of a target id: frequent words by rank, then the rest classes."""
    return np.where(y < k, y // CLASS_WORDS, y - k + k // CLASS_WORDS)


def window_log_probs(w, hs, y, k, grads=None):
    """Natural log-probability of each target; with ``grads``, adds gradients and returns d(-logp)/d(hs) too.

    Works in blocks that fit a cache: ROWS targets for the classes, one class for the words.
    """
    cls, probs = _class_of(y, k), grads is not None
    small = _small(w["cls"].T, w["cls_b"])
    out = np.empty(len(y))
    back = None if grads is None else np.empty_like(hs)
    for i in range(0, len(y), ROWS):
        part = slice(i, i + ROWS)
        d, at = hs[part] @ w["cls"], cls[part]
        d += w["cls_b"]
        out[part] = _softmax(d, at, small, probs)
        if grads is not None:
            d[np.arange(len(d)), at] -= 1
            grads["cls"] += hs[part].T @ d
            grads["cls_b"] += d.sum(axis=0)
            back[part] = d @ w["cls"].T
    if not k:
        return out, back
    small = _small(w["word"], w["word_b"])
    # targets in order of their class (few enough classes for a sort of 16-bit numbers)
    order = np.argsort(cls.astype(np.uint16) if w["cls_b"].size < 1 << 16 else cls, kind="stable")
    bounds = np.searchsorted(cls[order], np.arange(k // CLASS_WORDS + 1))
    order = order[:bounds[-1]]
    h, word, log_p = hs[order], y[order] % CLASS_WORDS, np.empty(len(order))
    deep = None if grads is None else np.empty_like(h)
    for c in range(k // CLASS_WORDS):
        part = slice(bounds[c], bounds[c + 1])
        if part.start == part.stop:
            continue
        block = slice(c * CLASS_WORDS, (c + 1) * CLASS_WORDS)
        d, at = h[part] @ w["word"][block].T, word[part]
        d += w["word_b"][block]
        log_p[part] = _softmax(d, at, small, probs)
        if grads is not None:
            d[np.arange(len(d)), at] -= 1
            grads["word"][block] += d.T @ h[part]
            grads["word_b"][block] += d.sum(axis=0)
            deep[part] = d @ w["word"][block]
    out[order] += log_p
    if grads is not None:
        back[order] += deep
    return out, back


def _padded(seqs: list[np.ndarray], order: np.ndarray, start: int, size: int):
    """(tokens, lanes) targets of one window, with how many of the longest-first lanes reach each step."""
    y = np.zeros((size, len(order)), dtype=np.int64)
    live = np.zeros(size, dtype=np.int64)
    for lane, i in enumerate(order):
        part = seqs[i][start:start + size]
        if not len(part):
            break
        y[:len(part), lane] = part
        live[:len(part)] += 1
    return y, live[:int((live > 0).sum())]


def train_on(w0, seqs: list[np.ndarray], k: int, end_id: int, rate: float = 0.02, lanes: int = 0, seed: int = 4):
    """Truncated backpropagation (window WINDOW, AdaGrad) over the sequences; returns new weights and tokens seen.

    Sequences are trained in stretches of up to PIECE tokens, so that lanes stay full; a
    stretch starts from the token before it.  ``lanes`` stretches are trained side by side: by default a 16th of
    them within LANES, so that few sequences still give many updates.
    """
    w = {n: x.copy() for n, x in w0.items()}
    memory = {n: np.full_like(x, 1e-3) for n, x in w.items()}
    seen, n = 0, HIDDEN
    pieces, before = [], []
    for s in seqs:
        for i in range(0, len(s), PIECE):
            pieces.append(s[i:i + PIECE])
            before.append(end_id if i == 0 else s[i - 1])
    before = np.array(before)
    lanes = lanes or min(max(len(pieces) // 16, LANES[0]), LANES[1])
    pick = np.random.default_rng(seed).permutation(len(pieces))
    for g in range(0, len(pieces), lanes):
        at = pick[g:g + lanes]
        at = at[np.argsort([-len(pieces[i]) for i in at], kind="stable")]
        group, order = [pieces[i] for i in at], np.arange(len(at))
        h = np.zeros((len(group), n), np.float32)
        prev = before[at]
        start = 0
        while True:
            y, live = _padded(group, order, start, WINDOW)
            if not len(live):
                break
            start += WINDOW
            xs = [prev[:m] if t == 0 else y[t - 1, :m] for t, m in enumerate(live)]
            rows, ends = np.concatenate(xs), np.cumsum(live)
            inputs, rec = _by_gate((w["in"] + w["gate"])[rows]), _by_gate(w["rec"])
            states, kept = [h], []
            for t, m in enumerate(live):
                new, parts = _step(inputs[:, ends[t] - m:ends[t]], rec, states[-1][:m])
                kept.append(parts)
                states.append(new)
            grads = {name: np.zeros_like(v) for name, v in w.items()}
            flat_h = np.concatenate(states[1:])
            flat_y = np.concatenate([y[t, :m] for t, m in enumerate(live)])
            _, back = window_log_probs(w, flat_h, flat_y, k, grads)
            dh, da_all, du_all = np.zeros((0, n), np.float32), np.empty_like(inputs), np.empty_like(inputs)
            back_rec = np.ascontiguousarray(rec.transpose(0, 2, 1))
            for t in range(len(live) - 1, -1, -1):
                m, part = live[t], slice(ends[t] - live[t], ends[t])
                full = back[part]
                full[:len(dh)] += dh
                r, z, c, uc = kept[t]
                da, du, keep = da_all[:, part], du_all[:, part], 1 - z
                dac = np.multiply(full, keep, out=da[2])
                dac *= 1 - c * c
                np.multiply(dac, r, out=du[2])
                np.multiply(dac, uc, out=da[0])
                da[0] *= r
                da[0] *= 1 - r
                np.subtract(states[t][:m], c, out=da[1])
                da[1] *= full
                da[1] *= z
                da[1] *= keep
                du[:2] = da[:2]
                dh = full * z
                for gate in range(3):
                    dh += du[gate] @ back_rec[gate]
            before_step = np.concatenate([states[t][:m] for t, m in enumerate(live)])
            grads["rec"] += np.concatenate(before_step.T @ du_all, axis=1)
            da_all = da_all.transpose(1, 0, 2).reshape(len(rows), 3 * n)
            grads["gate"] += da_all.sum(axis=0)
            turn = np.argsort(rows.astype(np.uint16) if len(w["in"]) <= 1 << 16 else rows, kind="stable")
            first = np.flatnonzero(np.diff(rows[turn], prepend=-1))
            grads["in"][rows[turn][first]] = np.add.reduceat(da_all[turn], first)
            count = len(flat_y)
            seen += count
            for name, gr in grads.items():
                gr /= count ** 0.5
                memory[name] += gr * gr
                w[name] -= rate * gr / np.sqrt(memory[name])
            h, prev, order = states[-1], y[len(live) - 1, :live[-1]], order[:live[-1]]
            if len(live) < WINDOW:
                break
    return w, seen


def score_sequences(w, seqs: list[np.ndarray], k: int, end_id: int, window: int = 64, lanes: int = 1024) -> np.ndarray:
    """Natural log-probability of each whole sequence, states carried from window to window."""
    total, w_in, rec = np.zeros(len(seqs)), _by_gate(w["in"] + w["gate"]), _by_gate(w["rec"])
    by_length = np.argsort([-len(s) for s in seqs], kind="stable")
    for g in range(0, len(seqs), lanes):
        order = by_length[g:g + lanes]
        h = np.zeros((len(order), HIDDEN), np.float32)
        prev = np.full(len(order), end_id)
        start = 0
        while True:
            y, live = _padded(seqs, order, start, window)
            if not len(live):
                break
            start += window
            states, lane = [], []
            for t, m in enumerate(live):
                h, _ = _step(w_in.take(prev[:m], axis=1), rec, h[:m])
                prev = y[t, :m]
                states.append(h)
                lane.append(order[:m])
            lp, _ = window_log_probs(w, np.concatenate(states), np.concatenate([y[t, :m] for t, m in enumerate(live)]), k)
            total += np.bincount(np.concatenate(lane), lp, minlength=len(seqs))
            if len(live) < window:
                break
            order = order[:live[-1]]
    return total


def _pack_weights(w) -> bytes:
    return b"".join(w[n].astype(np.float32).tobytes() for n in sorted(w))


def _unpack_weights(data: bytes, like) -> dict:
    out, at, flat = {}, 0, np.frombuffer(data, np.float32)
    for n in sorted(like):
        out[n] = flat[at:at + like[n].size].reshape(like[n].shape).copy()
        at += like[n].size
    return out


def _rest_id(word: bytes, k: int) -> int:
    return k + zlib.crc32(word[:3]) % N_REST


def _end_id(vocab: Vocab) -> int:
    i = vocab.ids.get(END, vocab.n_frequent)
    return i if i < vocab.n_frequent else vocab.n_frequent + rest_class(END)


def _weighted_sums(batches):
    """One row per chunk of the weights: the sum over trainers of weights times tokens seen, and the tokens."""
    flat, seen = {}, Counter()
    for b in batches:
        for c, data, n in zip(*(b.column(x).to_pylist() for x in ("chunk", "weights", "seen"))):
            part = np.frombuffer(data, np.float32).astype(np.float64) * n
            flat[c] = flat[c] + part if c in flat else part
            seen[c] += n
    if seen:
        yield pa.RecordBatch.from_arrays([pa.array(list(flat), pa.int64()), pa.array([x.tobytes() for x in flat.values()], pa.binary()),
                                          pa.array([seen[c] for c in flat], pa.int64())], names=["chunk", "total", "seen"])


def weighted_mean(trained: DataFrame, parts: int) -> np.ndarray | None:
    """Mean of the trainers' weights by tokens seen, None without tokens.

    ``trained`` holds (part, chunk, weights, seen); chunks are summed on Spark, so that the driver gets
    one set of weights, however many trainers there are.
    """
    got = (trained.repartition(parts, "chunk").sortWithinPartitions("chunk", "part")
           .mapInArrow(_weighted_sums, "chunk long, total binary, seen long").collect())
    if not got:
        return None
    return np.concatenate([np.frombuffer(g["total"], np.float64) / g["seen"] for g in sorted(got, key=lambda g: g["chunk"])])


def _id_kind(vocab: Vocab):
    return np.uint16 if vocab.n_frequent + N_REST <= 1 << 16 else np.uint32


def network_rows(docs: DataFrame, id_col: str, text_col: str, vocab: Vocab) -> DataFrame:
    """Every row's network ids and what its score needs beside them, written once, for training and scoring alike.

    (_id, _held, h, chars, n_tokens, known, logs, rest, _rare, y, _row): ``y`` the ids, ``logs`` the logarithms of
    the kept words' counts, ``rest`` the shares of kept words within the rest classes, ``_rare`` words that are not kept.
    """
    kind, shared = _id_kind(vocab), docs.sparkSession.sparkContext.broadcast(vocab)
    names = ["_id", "_held", "h", "chars", "n_tokens", "known", "logs", "rest", "_rare", "y"]

    def run(batches):
        voc = shared.value
        k = voc.n_frequent
        get = {x.encode("utf-8"): i for x, i in voc.ids.items()}.get
        ids = np.append(np.arange(len(voc.counts)), -1)    # network id of a rank
        ids[k:-1] = [_rest_id(x.encode("utf-8"), k) for x, i in voc.ids.items() if i >= k]
        log_c = np.log10(np.append(voc.counts, 0) + 1.0)
        log_z = np.log10(voc.rest_total + 1)
        unkept = len(voc.counts)
        for b in batches:
            seqs, tokens, known, logs, rest, rare = [], [], [], [], [], []
            for t in b.column("t").cast(pa.binary()):
                words = _words(t.as_py()) + [END.encode()]
                i = np.fromiter(map(get, words, repeat(unkept)), dtype=np.int64, count=len(words))
                y = ids[i]
                new = np.flatnonzero(i == unkept)
                y[new] = [_rest_id(words[j], k) for j in new.tolist()]
                out = np.flatnonzero(i >= k)
                cls = y[out] - k
                seqs.append(y.astype(kind).tobytes())
                tokens.append(len(words))
                known.append(len(words) - len(new))
                logs.append(float(log_c[i].sum()))
                rest.append(float(log_c[i[out]].sum() - log_z[cls].sum()))
                rare.append([words[j].decode("utf-8") for j in new.tolist()])
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in names[:4]), pa.array(tokens, pa.int64()), pa.array(known, pa.int64()),
                 pa.array(logs, pa.float64()), pa.array(rest, pa.float64()), pa.array(rare, pa.list_(pa.string())),
                 pa.array(seqs, pa.binary())], names=names)

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    src = docs.select(F.col(id_col).alias("_id"), held_out(id_col).alias("_held"), text.alias("t"),
                      F.xxhash64(text, F.col(id_col), F.lit(21)).alias("h"), F.length(text).alias("chars"))
    kind_of_id = dict(src.dtypes)["_id"]
    rows = src.mapInArrow(run, f"_id {kind_of_id}, _held boolean, h long, chars int, n_tokens long, known long, "
                               "logs double, rest double, _rare array<string>, y binary")
    rows = materialise(rows.withColumn("_row", F.monotonically_increasing_id()), "lm-rows")
    shared.unpersist()
    return rows


def fit(docs: DataFrame, id_col: str, text_col: str, vocab: Vocab, share: int = 1, trainers: int = 12,
        rounds: int = 2, trainer_chars: int = TRAINER_CHARS) -> dict:
    """Weights after one pass over every row of ``docs``, see ``fit_rows``."""
    return fit_rows(network_rows(docs, id_col, text_col, vocab), vocab, share, trainers, rounds, trainer_chars)


def fit_rows(rows: DataFrame, vocab: Vocab, share: int = 1, trainers: int = 12, rounds: int = 2,
             trainer_chars: int = TRAINER_CHARS) -> dict:
    """Weights after one pass over every training row, dealt by hash to ``rounds`` rounds of parallel training;
    ``share`` > 1 keeps one row in so many by hash.

    Rows are network ids, on disk and in the rounds' exchanges.  What is trained
    on grows with the input, batch by batch in each task.  There are at least ``trainers`` tasks, and
    one more per ``trainer_chars`` characters beyond them; the driver gets one set of weights a round.
    """
    sc = rows.sparkSession.sparkContext
    w, kind = initial(vocab), _id_kind(vocab)
    chosen = rows.where(F.pmod("h", F.lit(share)) == 0)
    chars = chosen.agg(F.sum("chars")).first()[0] or 0
    trainers = max(trainers, math.ceil(chars / trainer_chars))
    for r in range(rounds):
        shared = sc.broadcast((w, vocab.n_frequent, _end_id(vocab), 0.05 if r == 0 else 0.02))

        def run(batches):
            new, k, end, rate = shared.value
            seen, part = 0, TaskContext.get().partitionId()
            for b in batches:   # one batch of texts in memory at a time
                seqs = [np.frombuffer(y, kind).astype(np.int64) for y in b.column("y").to_pylist()]
                new, n = train_on(new, seqs, k, end, rate)
                seen += n
            if seen:
                data = _pack_weights(new)
                chunks = [data[i:i + 4 * CHUNK] for i in range(0, len(data), 4 * CHUNK)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * len(chunks), pa.int64()), pa.array(range(len(chunks)), pa.int64()),
                     pa.array(chunks, pa.binary()), pa.array([seen] * len(chunks), pa.int64())],
                    names=["part", "chunk", "weights", "seen"])

        trained = (chosen.select("y", "h").where(F.pmod(F.xxhash64("h", F.lit(5)), F.lit(rounds)) == r).repartition(trainers, "h").sortWithinPartitions("h", "y")
                   .mapInArrow(run, "part long, chunk long, weights binary, seen long"))
        flat = weighted_mean(trained, math.isqrt(trainers))
        if flat is not None:
            w = _unpack_weights(flat.astype(np.float32).tobytes(), w)
        shared.unpersist()
    return w


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_frequent: int = 3072,
              share: int = 1, trainers: int = 12, kept: int = KEPT_WORDS) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row.

    Learns from rows whose crc32(id as text) mod 7 is not 2 (null ids count as
    training rows).  base_score: add-one unigram log10 probability; score: the
    network's.  Null and empty texts are a lone end token; texts of any length
    are scored whole; repeated rows each count and score alike; an empty table gives no
    rows; without training tokens all words are unseen.  Other columns are ignored.
    """
    spark = docs.sparkSession
    train_docs = docs.where(~held_out(id_col))
    counts = materialise(count_words(train_docs, text_col), "lm-counts")
    vocab = build_vocab(counts, n_frequent, kept)
    rows = network_rows(docs, id_col, text_col, vocab)
    weights = fit_rows(rows.where(~F.col("_held")), vocab, share, trainers)
    shared = spark.sparkContext.broadcast((weights, vocab.n_frequent, _end_id(vocab), _id_kind(vocab)))
    log_all = math.log10(vocab.n + vocab.v + 1)
    passed = ["_row", "_id", "_held", "n_tokens", "known", "logs"]

    def run(batches):
        w, k, end, id_kind = shared.value
        for b in batches:
            seqs = [np.frombuffer(y, id_kind).astype(np.int64) for y in b.column("y").to_pylist()]
            lp = score_sequences(w, seqs, k, end) / math.log(10) + b.column("rest").to_numpy()
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in passed), pa.array(lp, pa.float64())],
                                             names=[*passed, "score"])

    kind = dict(rows.dtypes)["_id"]
    scored = rows.select(*passed, "rest", "y").mapInArrow(
        run, f"_row long, _id {kind}, _held boolean, n_tokens long, known long, logs double, score double")
    scored = materialise(scored, "lm-scored")
    # words beyond the kept ones: their counts come by a join, whatever their number
    rare = rows.select("_row", F.explode("_rare").alias("word")).groupBy("_row", "word").agg(F.count("*").alias("m"))
    known = (rare.join(counts, "word").groupBy("_row")
             .agg(F.sum("m").alias("more"), F.sum(F.col("m") * F.log10(F.col("n") + 1)).alias("more_logs")))
    more_logs = F.coalesce("more_logs", F.lit(0.0))
    return scored.join(known, "_row", "left").select(
        F.col("_id").alias(id_col), F.col("_held").alias("held_out"), "n_tokens",
        (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(vocab.n).cast("long").alias("train_tokens"),
        (F.col("logs") + more_logs - F.col("n_tokens") * F.lit(log_all)).alias("base_score"),
        (F.col("score") + more_logs).alias("score"))
