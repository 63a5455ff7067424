"""Source audit, line labelling and periodic runs against plain Python."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tallyframe.llm import line_crf, periodic_runs, queries, source_audit
from tallyframe.llm.common import read_table

SF = "/root/testdata/sf0.001"
CLASH = ["_out", "_text", "_id", "runs", "n_words", "kinds", "terms", "bag", "vector", "t", "i", "v", "a", "b", "w", "h", "kept", "a.b"]


def frame(spark, rows):
    """(doc_id, text, lang, source) rows with columns named like internal ones."""
    return spark.createDataFrame([(*r, *range(len(CLASH))) for r in rows], "doc_id long, text string, lang string, source string, "
                                 + ", ".join(f"`{c}` int" for c in CLASH))


def words_of(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


# ---- 11 source audit

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def audit_by_hand(rows, min_docs, top=50):
    docs = [(lang or "", source or "", TERM.findall((text or "").translate({c: c + 32 for c in range(65, 91)})))
            for _, text, lang, source in rows]
    df, n = Counter(), Counter()
    for lang, source, words in docs:
        df.update((lang, w) for w in set(words))
        n.update((lang, source, w) for w in words)
    out = set()
    for lang in {d[0] for d in docs}:
        kept = [w for (la, w), c in df.items() if la == lang and c >= min_docs]
        sources = sorted({d[1] for d in docs if d[0] == lang})
        whole = Counter({w: sum(n[lang, s, w] for s in sources) for w in kept})
        def share(count, total):
            return 1 + 10**9 * (count + 5) // (total + 5 * len(kept))
        p = {s: {w: share(n[lang, s, w], sum(n[lang, s, x] for x in kept)) for w in kept} for s in sources}
        q = {w: share(whole[w], sum(whole.values())) for w in kept}
        for s in sources:
            pair = [(sum(abs(p[s][w] - p[o][w]) for w in kept), o) for o in sources if o != s]
            term = [(p[s][w] - q[w], w) for w in kept if n[lang, s, w] and p[s][w] > q[w]]
            for part, found, limit in (("pair", pair, None), ("term", term, top)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out |= {(lang, s, part, item, value, r) for r, (value, item) in enumerate(found[:limit], 1)}
    return out


def audit_rows():
    rng = random.Random(3)
    pool = {"en": ["the", "The", "cat", "dog's", "x1y", "öl", "Öl", "ÖL", "zebra"], "de": ["die", "ß", "straße", "\U0001F600", "a"]}
    rows = [(i, " ".join(rng.choice(pool[la]) for _ in range(rng.randint(0, 30))), la, f"s{min(3, int(rng.expovariate(1)))}")
            for i in range(60) for la in [rng.choice(["en", "de"])]]
    return rows + [(1, None, None, None), (1, "the the", None, "s0"), (2, "", "en", None), (3, "lone", "xx", "s9"), (None, "a\x01b c", "e\x01n", "s\x01"),
                   (4, "the " * 3000, "en", "s1"), (5, "1 2 3", "yy", "s1"), (5, "1 2 3", "yy", "s2"), *rows[:4]]


@pytest.mark.parametrize("min_docs, part_terms", [(3, 1 << 20), (2, 1), (500, 100)])
def test_audit_against_plain_python(spark, min_docs, part_terms, monkeypatch):
    if part_terms == 1:
        monkeypatch.setattr(source_audit, "_parts", lambda *a: 3)
    rows = audit_rows()
    got = source_audit.source_audit(frame(spark, rows), min_docs=min_docs, part_terms=part_terms)
    assert got.dtypes == [("lang", "string"), ("source", "string"), ("part", "string"), ("item", "string"), ("value", "bigint"), ("rank", "int")]
    got = [tuple(r) for r in got.collect()]
    assert len(got) == len(set(got)) and set(got) == audit_by_hand(rows, min_docs)


def test_audit_top_and_empty(spark):
    rows = audit_rows()
    got = [tuple(r) for r in source_audit.source_audit(frame(spark, rows), min_docs=2, top_terms=2).collect()]
    assert set(got) == audit_by_hand(rows, 2, top=2)
    assert source_audit.source_audit(frame(spark, rows).where("doc_id < 0")).collect() == []


# ---- 12 line labelling

def base_by_hand(text):
    text = text or ""
    words = words_of(text)
    grams = Counter(zip(words, words[1:], words[2:]))
    hit = {j + k for j in range(len(words) - 2) if grams[tuple(words[j:j + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if words_of(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit))


def line_texts():
    rng = random.Random(8)
    def prose(n):
        return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8))) for _ in range(n))
    return [None, "", " \n\t ", "one", "a b c a b c", "x y\x85z w", "ÀÉ #1 <b>\n\nÀÉ #1 <b>\nÀÉ #1 <b>", "a " * 5000, prose(9000), "\n" * 4000 + "a",
            "\n".join(prose(9) for _ in range(300)), "w\x00q\r\nw\x00q\r\n" * 30, *("\n".join(rng.choice(["p q r", "", "p", " p", "\x0b"]) for _ in range(20)) for _ in range(30))]


def test_line_figures_against_plain_python(spark):
    rows = [(i, t, None, None) for i, t in enumerate(line_texts())] + [(None, "a b", None, None), (3, "one", None, None), (3, "one", None, None)]
    out = line_crf.judge_lines(frame(spark, rows), line_crf.Model.none())
    got = sorted((str(r["doc_id"]), tuple(r[n] for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")))
                 for r in out.collect())
    want = []
    for i, t, _, _ in rows:
        b = base_by_hand(t)
        failed = b[0] < 50 or 100 * b[4] > 50 * b[0]
        want.append((str(i), (*b, failed, not failed)))
    assert got == sorted(want)
    assert line_crf.judge_lines(frame(spark, rows).where("doc_id < 0"), line_crf.Model.none()).collect() == []


def test_viterbi_against_all_labellings():
    rng = np.random.default_rng(1)
    model = line_crf.Model(rng.normal(size=(line_crf.FEATURES, 2)), rng.normal(size=(2, 2)), rng.normal(size=2))
    for n in range(1, 9):
        x = np.stack([rng.integers(0, s, n) + o for s, o in zip(line_crf.SIZES, line_crf.STARTS)], axis=1)
        score = model.emit[x].sum(axis=1)
        best = max(itertools.product((0, 1), repeat=n), key=lambda y: model.first[y[0]] + sum(score[i, y[i]] for i in range(n))
                   + sum(model.step[y[i], y[i + 1]] for i in range(n - 1)))
        assert tuple(model.decode(x)) == best


@pytest.mark.parametrize("chain", [True, False])
def test_gradients_by_differences(chain):
    rng = np.random.default_rng(2)
    docs = [np.stack([rng.integers(0, s, n) + o for s, o in zip(line_crf.SIZES, line_crf.STARTS)], axis=1) for n in (5, 3, 3, 1)]
    labels = [rng.integers(0, 2, len(d)) for d in docs]
    model = line_crf.Model(rng.normal(size=(line_crf.FEATURES, 2)), chain * rng.normal(size=(2, 2)), chain * rng.normal(size=2))
    f = line_crf._gradient if chain else line_crf._line_gradient
    base, *grads = f(model, docs, labels)
    for w, g in zip((model.emit, model.step, model.first), grads):
        for _ in range(6):
            at = tuple(rng.integers(0, s) for s in w.shape)
            w[at] += 1e-5
            assert abs((f(model, docs, labels)[0] - base) / 1e-5 - g[at]) < 1e-3
            w[at] -= 1e-5


def test_lines_of_held_out_documents(spark):
    docs, labels = read_table(spark, "/root/testdata/sf0.1", "documents"), read_table(spark, "/root/testdata/sf0.1", "labels")
    learn = labels.where("crc32(cast(cast(doc_id as string) as binary)) % 5 != 0")
    test = labels.where("crc32(cast(cast(doc_id as string) as binary)) % 5 = 0")
    out = line_crf.judge_lines(docs.join(test, "doc_id", "left_semi"), line_crf.fit_line_crf(docs, learn, fit_rows=1500))
    rows = out.join(test, "doc_id").where("not base_failed").collect()
    good, bad = [r for r in rows if r["quality"] == 1], [r for r in rows if r["quality"] == 0]
    assert np.mean([r["kept"] for r in good]) > 0.99 and np.mean([not r["kept"] for r in bad]) > 0.95
    # the lines themselves: nearly all words of good documents, few of bad ones, and text that is really theirs
    assert np.mean([r["content_words"] / r["n_words"] for r in good]) > 0.98 > 0.3 > np.mean([r["content_words"] / r["n_words"] for r in bad])
    assert all(len(r["content"].split()) <= r["n_words"] for r in rows)


def test_lines_without_usable_labels(spark):
    docs = frame(spark, [(1, "a b " * 40, None, None), (2, None, None, None)])
    for labels in ([], [(1, None), (None, 1), (9, 0)], [(1, 1), (2, 1)]):
        model = line_crf.fit_line_crf(docs, spark.createDataFrame(labels, "doc_id long, quality int"))
        got = {r["doc_id"]: (r["content_words"], r["kept"]) for r in line_crf.judge_lines(docs, model, repeat_percent=100).collect()}
        assert got == {1: (80, True), 2: (0, False)}


def test_one_bad_line_and_long_chains():
    good, bad = "Some quiet words follow here, one after another.", "BUY!! | NOW!! | #1 | $$$ | CLICK!!"
    texts, labels = [good + "\n" + good] * 20 + [good + "\n" + "\n".join([bad] * 400)] * 20, [1] * 20 + [0] * 20
    model = line_crf.fit_lines(texts, labels)
    assert model.decode(line_crf.Lines("\n".join([good, good, bad, bad, bad])).features).tolist() == [1, 1, 0, 0, 0]


# ---- 13 periodic runs

def runs_by_hand(w, least=24):
    n, found = len(w), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, 3 * q):
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda x: (x[0], x[2]))


def run_texts(seed, many):
    rng = random.Random(seed)
    def words():
        n, kind = rng.randrange(0, 220), rng.randrange(5)
        if kind == 0:
            return [rng.choice("ab") for _ in range(n)]
        if kind == 1:
            return ([rng.choice("abc") for _ in range(rng.randrange(1, 40))] * 20)[:n]
        if kind == 2:
            out = []
            while len(out) < n:
                out += ([rng.choice("abcdefgh"[:rng.choice([2, 3, 8])]) for _ in range(rng.randrange(1, 30))] * rng.randrange(1, 7))[:rng.randrange(1, 200)]
            return out
        if kind == 3:
            out = (["a"] * rng.randrange(1, 20) + ["b"] + ["a"] * rng.randrange(20)) * rng.randrange(3, 8)
            out[rng.randrange(len(out))] = rng.choice(["a", "z"])
            return out
        a, b = ["a"], ["a", "b"]
        while len(b) < n:
            a, b = b, b + a
        return b[:n] + b[rng.randrange(5):n]
    return [words() for _ in range(many)]


def test_runs_against_plain_python():
    texts = run_texts(5, 400)
    got = periodic_runs.runs_of_texts([" ".join(t).encode() for t in texts])
    assert [[(s, e - s, q) for s, e, q in r] for _, r in got] == [runs_by_hand(t) for t in texts]
    assert sum(len(r) for _, r in got) > 500


def test_runs_of_blocks_and_long_texts(monkeypatch):
    texts = run_texts(6, 60) + [["x"] * 3000 + ["y"] + ["x"] * 3000, list("abcab") * 700]
    raw = [" ".join(t).encode() for t in texts]
    want = periodic_runs.runs_of_texts(raw)
    monkeypatch.setattr(periodic_runs, "BLOCK_WORDS", 100)
    assert periodic_runs.runs_of_texts(raw) == want
    assert want[-2][1] == [(0, 3000, 1), (3001, 6001, 1)] and want[-1][1] == [(0, 3500, 5)]


def digests_by_hand(doc_id, text):
    w = words_of(text)
    n = len(w)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
    runs = runs_by_hand(w)
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None, None, None))
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest(),
            hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in gone).encode()).hexdigest())


def test_runs_query_on_given_and_odd_documents(spark, tmp_path):
    odd = [(None, "a " * 40), (None, None), (7, ""), (7, " \n\t\x0b"), (8, " x " * 30), (9, "a b\x85c " * 30), (9, "a b\x85c " * 30),
           *((i, " ".join(t)) for i, t in enumerate(run_texts(9, 120)))]
    given = [(r["doc_id"], r["text"]) for r in read_table(spark, SF, "documents").collect()]
    frame(spark, [(*r, None, None) for r in odd + given]).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.QUERIES["op13_periodic_runs"](spark, str(tmp_path))
    key = lambda r: tuple(str(x) for x in r)
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted((digests_by_hand(*r) for r in odd + given), key=key)
    assert periodic_runs.periodic_runs(frame(spark, [(1, "a", None, None)]).where("doc_id < 0")).collect() == []
