"""Line labelling: a linear-chain conditional random field marks each line content or boilerplate.

A line with a word is described by the buckets of a few figures of its own
(words, letters, capitals, symbols, digits, word length, last sign, words in
repeated three-word windows, repeats of an earlier line).  Each bucket has a learned
weight per label and each pair of neighbouring labels another one; Viterbi decoding finds
the best labels of a whole document, and its share of words in content lines decides
whether it stays.

Training is numpy: gradients by forward and backward sums over all lines of
at most about ``fit_rows`` labelled documents.  Labels are given by document, so lines
get theirs in two steps: a first model without transitions learns each line
under its document's label; lines of bad documents that it takes for content count
as content in the second, whole model.
"""

from __future__ import annotations

from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SYMBOLS = "#*$%&|<>"
STRETCH = 256
SPACES = " \t\n\x0b\x0c\r"
#: Upper bounds of the buckets of each figure of a line.
CUTS = {
    "words": (1, 2, 4, 8, 16, 32, 64),
    "word_bytes": (2, 3, 4, 5, 6, 7, 8, 10, 14, 20),
    "capitals": (0, .02, .05, .1, .2, .4, .6, .9),
    "letters": (.3, .5, .6, .7, .75, .8, .85, .9, .95),
    "symbols": (0, .01, .02, .05, .1, .2, .4),
    "marks": (0, .01, .02, .03, .05, .08, .12, .2, .3),
    "digits": (0, .01, .05, .1, .3),
    "repeated": (0, .1, .3, .6, .9),
    "again": (0,),
    "ending": (0, 1, 2),
}
_BOUNDS = [(n, np.array(c, float)) for n, c in CUTS.items()]
SIZES = [len(c) + 1 for c in CUTS.values()]
STARTS = np.cumsum([0, *SIZES])[:-1]
FEATURES = sum(SIZES)

# What a byte is: 0 anything else, 1 capital, 2 other letter (bytes of non-ASCII too), 3 digit, 4 symbol, 5 mark, 6 space
_KIND = np.zeros(256, np.int64)
_KIND[65:91] = 1
_KIND[97:123] = 2
_KIND[128:] = 2
_KIND[48:58] = 3
_KIND[[ord(c) for c in SYMBOLS]] = 4
_KIND[[ord(c) for c in ".,;:!?\"'()-"]] = 5
_KIND[[ord(c) for c in SPACES]] = 6
_END = np.zeros(256, np.uint8)      # last sign of a line: 0 other, 1 end of a sentence, 2 shout or question, 3 symbol
_END[ord(".")] = 1
_END[[ord(c) for c in "!?"]] = 2
_END[[ord(c) for c in SYMBOLS]] = 3


def repeated_words(words: list) -> np.ndarray:
    """Per word: whether a three-word window that holds it is found twice or more."""
    n = len(words)
    mark = np.zeros(n, bool)
    if n < 4:
        return mark
    number: dict = {}
    ids = np.fromiter(map(number.setdefault, words, count()), np.int64, n)
    key = ids[:-1] * n + ids[1:]
    if n > 2_000_000:           # else three numbers fit into 63 bits
        key = np.unique(key, return_inverse=True)[1]
    key = key[:-1] * n + ids[2:]
    order = np.argsort(key)
    same = np.flatnonzero(key[order[1:]] == key[order[:-1]])
    twice = np.concatenate((order[same], order[same + 1]))
    for k in range(3):
        mark[twice + k] = True
    return mark


class Lines:
    """The lines of a text that hold a word: figures of the base rules, and feature numbers of each line."""

    def __init__(self, text: str, features: bool = True):
        self.word_chars = len(text) - sum(map(text.count, SPACES))
        self.n_symbols = sum(map(text.count, SYMBOLS))
        raw = text.encode("utf-8", "surrogatepass")
        parts = raw.split(b"\n")
        words = [p.split() for p in parts]
        self.at = [i for i, w in enumerate(words) if w]         # line numbers
        self.parts = parts
        counts = np.array([len(words[i]) for i in self.at], np.int64)
        flat = [x for w in words for x in w]
        self.n_words = len(flat)
        seen: set = set()
        again = np.zeros(len(self.at), np.int64)
        for j, i in enumerate(self.at):
            if parts[i] in seen:
                again[j] = 1
            seen.add(parts[i])
        self.n_dup_lines = int(again.sum())
        repeated = repeated_words(flat)
        self.n_repeat_words = int(repeated.sum())
        self.words = counts
        self.features = self._features(raw, counts, again, repeated) if features and self.at else np.empty((0, len(CUTS)), np.int64)

    def _features(self, raw, counts, again, repeated):
        n = len(self.parts)
        lens = np.fromiter(map(len, self.parts), np.int64, n)
        line = np.repeat(np.arange(n) * 7, lens + 1)[:len(raw)]
        of = np.bincount(line + _KIND[np.frombuffer(raw, np.uint8)], minlength=7 * n).reshape(n, 7)[self.at]
        solid = of[:, :6].sum(axis=1)
        letters = of[:, 1] + of[:, 2]
        words_to = np.cumsum(counts)
        rep = np.concatenate((np.zeros(1, np.int64), np.cumsum(repeated)))
        figures = {
            "words": counts, "word_bytes": solid / counts, "capitals": of[:, 1] / np.maximum(1, letters),
            "letters": letters / solid, "symbols": of[:, 4] / solid, "marks": of[:, 5] / solid, "digits": of[:, 3] / solid,
            "repeated": (rep[words_to] - rep[words_to - counts]) / counts, "again": again,
            "ending": _END[[self.parts[i].rstrip()[-1] for i in self.at]],
        }
        return np.stack([c.searchsorted(figures[n]) + s for (n, c), s in zip(_BOUNDS, STARTS)], axis=1)


class Model:
    """Weights: feature by label (0 boilerplate, 1 content), label by next label, label of the first line."""

    def __init__(self, emit: np.ndarray, step: np.ndarray, first: np.ndarray):
        self.emit, self.step, self.first = emit, step, first

    @classmethod
    def none(cls):
        """Without labels to learn from: every line is content."""
        return cls(np.zeros((FEATURES, 2)), np.zeros((2, 2)), np.array([0.0, 1.0]))

    def decode(self, features: np.ndarray) -> np.ndarray:
        """Viterbi: the best labels of a document's lines; ties go to content."""
        if not len(features):
            return np.empty(0, np.int64)
        score = self.emit[features].sum(axis=1)
        (s00, s01), (s10, s11) = self.step.tolist()
        a, b = (self.first + score[0]).tolist()
        back = []
        for e0, e1 in score[1:].tolist():
            to0, to1 = b + s10 >= a + s00, b + s11 >= a + s01
            back.append((to0, to1))
            a, b = (b + s10 if to0 else a + s00) + e0, (b + s11 if to1 else a + s01) + e1
        out = [1 if b >= a else 0]
        for pair in reversed(back):
            out.append(int(pair[out[-1]]))
        return np.array(out[::-1])


def _soft(z, axis):
    top = z.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(z - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def _by_feature(flat, wanted):
    """Sums of a (line, label) array by feature and label."""
    return np.stack([np.bincount(flat.ravel(), np.repeat(wanted[:, y], flat.shape[1]), FEATURES) for y in (0, 1)], axis=1)


def _line_gradient(model: Model, docs: list[np.ndarray], labels: list[np.ndarray]):
    """The same as _gradient for lines taken one by one, without transitions."""
    flat, gold = np.concatenate(docs), np.concatenate(labels)
    score = model.emit[flat].sum(axis=1)
    total = _soft(score, 1)
    wanted = np.eye(2)[gold] - np.exp(score - total[:, None])
    return score[np.arange(len(flat)), gold].sum() - total.sum(), _by_feature(flat, wanted)


def _gradient(model: Model, docs: list[np.ndarray], labels: list[np.ndarray]):
    """Log-likelihood of the labels and its gradients; documents sorted by falling number of lines."""
    lens = np.array([len(x) for x in docs])
    longest = lens[0]
    alive = [int((lens > t).sum()) for t in range(longest)]
    starts = np.cumsum(lens) - lens
    flat, gold = np.concatenate(docs), np.concatenate(labels)
    score = model.emit[flat].sum(axis=1)
    step, first = model.step, model.first
    fore, after = np.zeros((len(flat), 2)), np.zeros((len(flat), 2))
    fore[starts] = first + score[starts]
    for t in range(1, longest):
        at = starts[:alive[t]] + t
        fore[at] = score[at] + _soft(fore[at - 1][:, :, None] + step, 1)
    for t in range(longest - 2, -1, -1):
        at = starts[:alive[t + 1]] + t
        after[at] = _soft(step[None] + (score[at + 1] + after[at + 1])[:, None, :], 2)
    total = _soft(fore[starts + lens - 1], 1)
    each = np.repeat(total, lens)
    wanted = np.eye(2)[gold] - np.exp(fore + after - each[:, None])
    inner = np.delete(np.arange(len(flat)), starts)
    pair = np.exp(fore[inner - 1][:, :, None] + step + (score[inner] + after[inner])[:, None, :] - each[inner][:, None, None])
    seen = np.zeros((2, 2))
    np.add.at(seen, (gold[inner - 1], gold[inner]), 1)
    path = score[np.arange(len(flat)), gold].sum() + first[gold[starts]].sum() + step[gold[inner - 1], gold[inner]].sum()
    return path - total.sum(), _by_feature(flat, wanted), seen - pair.sum(axis=0), wanted[starts].sum(axis=0)


def train(docs: list[np.ndarray], labels: list[np.ndarray], chain: bool = True, rounds: int = 50, decay: float = 1.0) -> Model:
    """Whole-batch gradient steps with per-weight step sizes; ``decay``: weight of the squared-weight penalty."""
    order = sorted(range(len(docs)), key=lambda i: -len(docs[i]))
    docs, labels = [docs[i] for i in order], [labels[i] for i in order]
    model = Model(np.zeros((FEATURES, 2)), np.zeros((2, 2)), np.zeros(2))
    w = [model.emit, model.step, model.first]
    m, v = [np.zeros_like(x) for x in w], [np.zeros_like(x) for x in w]
    lines = sum(map(len, docs))
    for t in range(1, rounds + 1):
        _, *grads = (_gradient if chain else _line_gradient)(model, docs, labels)
        for i, grad in enumerate(grads):
            g = (grad - decay * w[i]) / lines
            m[i] = .9 * m[i] + .1 * g
            v[i] = .99 * v[i] + .01 * g * g
            w[i] += .15 * (m[i] / (1 - .9 ** t)) / (np.sqrt(v[i] / (1 - .99 ** t)) + 1e-9)
    return model


def fit_lines(texts: list[str], good: list[int]) -> Model:
    """Model from documents and their labels (1 good, 0 bad); without both kinds every line is content.

    Chains of over STRETCH lines are learned in stretches of that many.
    """
    pairs = []
    for t, y in zip(texts, good):
        x = Lines(t).features
        pairs += [(x[i:i + STRETCH], y) for i in range(0, len(x), STRETCH)]
    if len({y for _, y in pairs}) < 2:
        return Model.none()
    docs, good = [x for x, _ in pairs], [y for _, y in pairs]
    labels = [np.full(len(x), y) for x, y in zip(docs, good)]
    plain = train(docs, labels, chain=False)
    for i, y in enumerate(good):
        if y == 0:
            score = plain.emit[docs[i]].sum(axis=1)
            odds = score[:, 1] - score[:, 0]
            labels[i] = ((odds > 0) & (odds > odds.min())).astype(np.int64)     # a bad document has a bad line
    return train(docs, labels)


def _fit(batches):
    rows = []
    for b in batches:
        rows += zip(b.column("_id").to_pylist(), b.column("_text").to_pylist(), b.column("_y").to_pylist())
    rows = sorted((i, t or "", y) for i, t, y in rows)
    if rows:
        model = fit_lines([t for _, t, _ in rows], [y for _, _, y in rows])
        yield pa.RecordBatch.from_arrays([pa.array([x.astype("<f8").tobytes()]) for x in (model.emit, model.step, model.first)],
                                         names=["emit", "step", "first"])


def fit_line_crf(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 label_col: str = "quality", fit_rows: int = 3000) -> Model:
    """Train on at most about ``fit_rows`` labelled documents, those whose ids have the smallest hashes.

    An id with several labels counts with the larger one, an id with several rows with one of its texts (the
    smallest), so the bound fixes the number of training texts.  Labels other than 0 and 1, null ids and ids without a
    document are ignored; without both labels every line is content.
    """
    usable = (labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
              .groupBy(F.col(id_col).alias("_lid")).agg(F.max(label_col).cast("int").alias("_y")))
    share = min(1.0, fit_rows / max(1, usable.count()))
    cut = int((share * 2 - 1) * (1 << 62)) * 2 if share < 1 else (1 << 63) - 1
    chosen = usable.where(F.xxhash64("_lid", F.lit(12)) <= F.lit(cut))      # about fit_rows rows: broadcast
    rows = (docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
            .join(F.broadcast(chosen), F.col("_id") == F.col("_lid"))
            .groupBy("_id", "_y").agg(F.min("_text").alias("_text")))
    got = rows.repartition(1).mapInArrow(_fit, "emit binary, step binary, first binary").collect()
    if not got:
        return Model.none()
    emit, step, first = (np.frombuffer(got[0][n], "<f8") for n in ("emit", "step", "first"))
    return Model(emit.reshape(FEATURES, 2), step.reshape(2, 2), first)


RESULT = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long, "
          "content_words long, base_failed boolean, kept boolean")


def _judge(model, least_share: float, min_words: int, repeat_percent: int, with_content: bool):
    def run(batches):
        crf = model.value
        for b in batches:
            rows, content = [], []
            for t in b.column("_text").to_pylist():
                x = Lines(t or "")
                label = crf.decode(x.features)
                good = int(x.words[label == 1].sum())
                failed = x.n_words < min_words or 100 * x.n_repeat_words > repeat_percent * x.n_words
                rows.append((x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words, len(x.at), good,
                             failed, not failed and good >= least_share * x.n_words))
                if with_content:
                    content.append(b"\n".join(x.parts[i] for i, y in zip(x.at, label) if y).decode("utf-8", "surrogatepass"))
            kinds = [pa.int64()] * 7 + [pa.bool_()] * 2
            columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)] if rows else [pa.array([], k) for k in kinds]
            names = [c.split()[0] for c in RESULT.split(", ")]
            yield pa.RecordBatch.from_arrays([b.column("_out"), *columns, *([pa.array(content, pa.string())] if with_content else [])],
                                             names=["_out", *names, *["content"][:with_content]])
    return run


def judge_lines(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", least_share: float = 0.5,
                min_words: int = 50, repeat_percent: int = 50, with_content: bool = True) -> DataFrame:
    """(id, base figures, n_lines, content_words, base_failed, kept) of every row; ``with_content`` adds the content lines.

    A document fails the base rules with under ``min_words`` words or with more than ``repeat_percent`` % of
    its words in repeated three-word windows.  It is kept if it passes them and at least ``least_share``
    of its words lie in lines decoded as content.  Lines without a word are no lines of the chain and
    of no content.  Null texts are empty: all figures 0, base_failed, not kept.  Whole texts of any length are
    read; every row is judged alone, ids may repeat or be null.  An empty table gives no rows; other
    columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    src = docs.select(F.col(id_col).alias("_out"), F.col(text_col).cast("string").alias("_text"))
    kind = src.schema["_out"].dataType.simpleString()
    schema = f"_out {kind}, {RESULT}" + (", content string" if with_content else "")
    return src.mapInArrow(_judge(shared, least_share, min_words, repeat_percent, with_content), schema
                          ).withColumnRenamed("_out", id_col)
