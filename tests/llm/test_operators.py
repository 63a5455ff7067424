"""Each operator against a plain Python version, on small given tables and made edge cases."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash

from tallyframe.llm import (ann, bloom, components, decontaminate, lm, packing, pii, quality, queries, sharding,
                            simhash, suffix_dedup, url_filter)

SF = "/root/testdata/sf0.001"
CLASH = ["_id", "_text", "size", "node", "key", "g", "at", "score", "fp", "shard", "_k1", "component_id", "kind"]


def frame(spark, rows):
    """(doc_id, text) rows with null metadata and columns named like internal ones."""
    cols = ["doc_id", "text", "lang", "source", *CLASH]
    return spark.createDataFrame([(*r, None, None, *range(len(CLASH))) for r in rows],
                                 "doc_id long, text string, lang string, source string, "
                                 + ", ".join(f"{c} int" for c in CLASH)).select(*cols)


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(n))


@pytest.fixture(scope="module")
def edge_rows():
    rng = random.Random(4)
    base = prose(rng, 120)
    near = base.replace(base.split()[60], "zzz", 1)
    long = prose(rng, 9000)
    rows = [(1, base), (2, base), (3, near), (4, None), (5, ""), (6, "   \n\t "), (7, long), (8, long[500:40000]),
            (9, "word"), (9, "word"), (9, prose(rng, 50)), (None, base), (None, None), (12, "ÀÉ ß Ünï " * 40),
            (13, "x" * 5000), (14, "ab" * 3000), (15, prose(rng, 30) + " " + base[50:400])]
    return rows


def empty(spark):
    return frame(spark, [(1, "a")]).where("doc_id < 0")


def collect(df):
    return [tuple(r) for r in df.collect()]


# ---- 1 sharding

def test_sharding_law_slots_and_groups(spark, edge_rows):
    out = sharding.kd_shards(frame(spark, edge_rows), n_shards=4).collect()
    assert len(out) == len(edge_rows)
    by_text = {}
    for r in out:
        by_text.setdefault((r["size"], r["text_crc32"]), set()).add(r["shard"])
    assert all(len(s) == 1 for s in by_text.values())
    for s in {r["shard"] for r in out}:
        assert sorted(r["slot"] for r in out if r["shard"] == s) == list(range(sum(r["shard"] == s for r in out)))
    want = Counter((len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for _, t in edge_rows)
    assert Counter((r["size"], r["text_crc32"]) for r in out) == want
    assert collect(sharding.kd_shards(empty(spark), n_shards=4)) == []


def test_sharding_balances_given_table(spark):
    out = queries.QUERIES["op1_sharding"](spark, "/root/testdata/sf0.01").groupBy("shard").sum("size").collect()
    sizes = [r[1] for r in out]
    assert len(sizes) == 16 and max(sizes) - min(sizes) < 0.15 * np.mean(sizes)


def test_sharding_by_target_bytes(spark):
    docs = frame(spark, [(i, "t%d " % i * 50) for i in range(200)])
    out = sharding.kd_shards(docs, target_bytes=8000).groupBy("shard").sum("size").collect()
    assert len(out) == math.ceil(sum(len("t%d " % i * 50) + 1 for i in range(200)) / 8000)


# ---- 2 nearest neighbours

def test_nearest_against_brute_force(spark):
    rng = np.random.default_rng(0)
    vecs = rng.standard_normal((400, 16)).astype(np.float32).round(2)
    vecs[200:260] = vecs[0]                      # a third-like group of equal vectors
    rows = [(i, v.tolist()) for i, v in enumerate(vecs)]
    bad = [(400, None), (420, [0.0] * 16), (440, [float("nan")] + [1.0] * 15), (460, [None] + [1.0] * 15),
           (480, [float("inf")] + [1.0] * 15), (500, [1.0, 2.0]), (None, [1.0] * 16)]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows + bad + rows[:3]], "vec_id long, embedding array<float>, _v int, score int")
    got = ann.nearest(df, k=5, query_mod=20, shard_rows=100, block_rows=7).collect()
    by = {}
    for r in sorted(got, key=lambda r: r["rank"]):
        by.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    m = vecs.astype(float)
    hits = 0
    for q in range(0, 400, 20):
        s = m @ m[q]
        best = sorted((-s[j], j) for j in range(400) if j != q)[:5]
        hits += len({j for _, j in best} & {j for j, _ in by[q]})
        assert [x for x, _ in by[q]] == [x for x, _ in sorted(by[q], key=lambda x: (-round(x[1], 9), x[0]))]
        assert all(abs(sc - s[j]) < 1e-9 for j, sc in by[q])
    assert set(by) == set(range(0, 400, 20)) and hits >= 90
    assert ann.nearest(df.where("vec_id < 0")).count() == 0


def test_chi_square_law():
    assert abs(ann.chi2_cdf(np.array([7.344]), 8)[0] - 0.5) < 1e-3
    assert abs(ann.chi2_cdf(np.array([15.507]), 8)[0] - 0.95) < 1e-4


# ---- 3 repeated substrings

def repeats_by_hand(rows, n):
    seen, out = set(), []
    for _, t in rows:
        b = (t or "").encode()
        mark = bytearray(len(b))
        for p in range(len(b) - n + 1):
            w = b[p:p + n]
            if w in seen:
                mark[p:p + n] = b"\1" * n
            seen.add(w)
        kept = bytes(x for x, m in zip(b, mark) if not m)
        out.append((len(b), sum(mark), len(re.findall(b"\1+", bytes(mark))), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("length", [24, 100])
def test_suffix_dedup_unique_ids(spark, edge_rows, length):
    rows = [(i, t) for i, (_, t) in enumerate(edge_rows)]
    got = {r["doc_id"]: tuple(r)[1:5] for r in suffix_dedup.remove_repeats(frame(spark, rows), length=length).collect()}
    assert [got[i] for i in range(len(rows))] == repeats_by_hand(rows, length)


def test_suffix_dedup_long_text_in_stretches(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BLOCK", 1000)
    rng = random.Random(1)
    t = prose(rng, 900)
    ids = np.array([0, 1])
    found = [(d, x + base) for _, doc, base, x, _, _ in suffix_dedup.anchors(ids, [t.encode(), t.encode()], 100)
             for d, x, base in zip(doc, x, base)]
    assert {x for d, x in found if d == 0} == {x for d, x in found if d == 1} and len(found) > 50


def test_suffix_dedup_null_and_repeated_ids(spark, edge_rows):
    got = Counter((r["doc_id"], r["n_bytes"], r["n_removed"]) for r in
                  suffix_dedup.remove_repeats(frame(spark, edge_rows), with_text=False).collect())
    order = sorted(edge_rows, key=lambda r: (r[0] is not None, r[0] or 0))
    want = repeats_by_hand(order, 100)
    assert sum(k[2] * n for k, n in got.items()) == sum(w[1] for w in want)
    assert len(list(got.elements())) == len(edge_rows)
    assert suffix_dedup.remove_repeats(empty(spark)).count() == 0


# ---- 4 SimHash

def simhash_by_hand(text, k=3):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().translate(
        bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))))
    if not words:
        return 0
    grams = [b" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or [b" ".join(words)]
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components_by_hand(fps, t):
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a in fps:
        for b in fps:
            if a < b and (a ^ b).bit_count() <= t:
                root[find(a)] = find(b)
    return {f: find(f) for f in fps}


def test_simhash_groups(spark, edge_rows):
    got = simhash.simhash_groups(frame(spark, edge_rows)).collect()
    fps = [simhash_by_hand(t) for _, t in edge_rows]
    comp = components_by_hand(set(fps), 3)
    low = {}
    for (i, _), f in zip(edge_rows, fps):
        if i is not None:
            low[comp[f]] = min(i, low.get(comp[f], i))
    want = Counter((i, format(f, "016x"), low.get(comp[f])) for (i, _), f in zip(edge_rows, fps))
    assert Counter(tuple(r) for r in got) == want
    assert simhash.simhash_groups(empty(spark)).count() == 0


@pytest.mark.parametrize("bits,hot", [(1, 4096), (2, 4096), (3, 4096), (3, 4), (2, 4), (1, 4)])
def test_simhash_links_keep_components(spark, bits, hot):
    rng = random.Random(bits)
    fps = [rng.getrandbits(64) for _ in range(40)]
    for f in list(fps[:8]):
        for _ in range(12):
            f ^= sum(1 << b for b in rng.sample(range(64), rng.randint(1, 4)))
            fps.append(f)
    signed = [f - (1 << 64) if f >> 63 else f for f in set(fps)]
    links = simhash.simhash_links(spark.createDataFrame([(f,) for f in signed], "fp long"), bits, hot=hot).collect()
    root = {f: f for f in signed}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for r in links:
        assert ((r["a"] ^ r["b"]) & (1 << 64) - 1).bit_count() <= bits or hot == 4
        root[find(r["a"])] = find(r["b"])
    got = {}
    for f in signed:
        got.setdefault(find(f), set()).add(f & (1 << 64) - 1)
    want = {}
    for f, c in components_by_hand(set(fps), bits).items():
        want.setdefault(c, set()).add(f)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_keep_one(spark, edge_rows):
    kept = simhash.keep_one(frame(spark, edge_rows)).collect()
    comp = components_by_hand({simhash_by_hand(t) for _, t in edge_rows}, 3)
    assert len(kept) == len(set(comp.values()))


def test_components_of_a_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 100), (None, 3), (7, 8)], "a long, b long")
    assert dict(collect(components.components(edges, "a", "b"))) == {i: 0 for i in range(1, 61)}
    assert components.components(edges.where("a < 0"), "a", "b").count() == 0


# ---- 5 decontamination

def test_leaks_found_with_few_edits(spark):
    rng = random.Random(9)
    items = [(i, prose(rng, 30)) for i in range(6)] + [(6, None), (7, ""), (8, "short"), (None, prose(rng, 30))]
    clean = [(100 + i, prose(rng, 300)) for i in range(20)]
    item = items[0][1]
    edited = item[:50] + "Q" + item[51:90] + item[92:]
    docs = clean + [(1, prose(rng, 50) + " " + items[1][1].upper() + " " + prose(rng, 50)),
                    (2, edited), (3, (items[2][1] + "\n") * 3), (4, None), (5, ""), (None, items[3][1]),
                    (6, prose(rng, 20000) + " " + items[4][1]), (7, item[:60] + prose(rng, 40) + item[60:])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.find_leaks(frame(spark, docs), bench).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == {(1, 1), (2, 0), (3, 2), (None, 3), (6, 4)}
    assert {r["doc_id"]: r["edits"] for r in got}[2] == 3 and {r["doc_id"]: r["edits"] for r in got}[1] == 0
    blocks = decontaminate.find_leaks(frame(spark, docs), bench, block_chars=300).collect()
    assert sorted(map(str, blocks)) == sorted(map(str, got))
    assert decontaminate.find_leaks(empty(spark), bench).count() == 0
    assert decontaminate.find_leaks(frame(spark, docs), bench.where("item_id < 0")).count() == 0


def test_leaks_whatever_the_white_space(spark):
    rng = random.Random(19)
    lines = [prose(rng, 9) for _ in range(7)]
    indented = "def f():\n\n" + "\n".join("        " + x for x in lines)
    plain = prose(rng, 30)
    unicode = "\u00a0\u2003".join(prose(rng, 30).split())
    bench = spark.createDataFrame([(0, indented), (1, plain), (2, unicode)], "item_id long, text string")
    before = "\u0130x  " + prose(rng, 5) + " "
    docs = [(0, before + indented + " end"), (1, plain.replace(" ", "  ")), (2, "\u0085".join(unicode.split())),
            (3, unicode), (4, " ".join(indented.split())), (5, prose(rng, 100))]
    got = {r["doc_id"]: r for r in decontaminate.find_leaks(frame(spark, docs), bench).collect()}
    assert {(d, r["item_id"], r["edits"]) for d, r in got.items()} == {(0, 0, 0), (1, 1, 0), (2, 2, 0), (3, 2, 0), (4, 0, 0)}
    for d, whole in ((0, indented), (1, docs[1][1]), (2, docs[2][1]), (3, unicode)):
        found = docs[d][1][got[d]["start"]:got[d]["end"]]
        assert found in whole and len(found) > 0.4 * len(whole)
    assert docs[1][1][got[1]["start"]:got[1]["end"]] == docs[1][1]


def test_leaks_of_excerpts_and_short_items(spark):
    rng = random.Random(29)
    middle, long, small = prose(rng, 59), prose(rng, 240), "what is the cube of nine"
    assert len(small) < decontaminate.SHORTEST
    bench = spark.createDataFrame([(0, middle), (1, long), (2, small), (3, "why not"), (4, prose(rng, 12))], "item_id long, text string")
    tenth, cut = len(middle) // 10, decontaminate.parts_of(len(long))[0][1]
    docs = [(1, prose(rng, 40) + " " + middle[tenth:] + " " + prose(rng, 40)), (2, middle[:-tenth]),
            (3, middle[tenth // 2:-tenth // 2]), (4, prose(rng, 40) + long[cut - 130:cut + 130] + prose(rng, 40)),
            (5, long[:600] + " and"), (6, "So, What is the  cube of nine?"), (7, "somewhat is the cube of nine"),
            (8, "what is the cube of ten"), (9, " Why  not "), (10, "why not now"), (11, middle[:len(middle) // 4]), (12, " "), (13, "")]
    got = decontaminate.find_leaks(frame(spark, docs), bench).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == {(1, 0), (2, 0), (3, 0), (4, 1), (5, 1), (6, 2), (9, 3)}
    at = {r["doc_id"]: docs[r["doc_id"] - 1][1][r["start"]:r["end"]] for r in got}
    assert at[1] in middle and at[6] == "What is the  cube of nine" and at[9] == "Why  not"
    for n in range(50, 1000, 7):   # any 90 %, and any 200 characters, hold a window
        for size in {-(-n * 9 // 10), 200}:
            assert all(any(a <= s and e <= a + size for s, e in [*decontaminate.parts_of(n), *decontaminate.windows_of(n)])
                       for a in range(n - size + 1)), (n, size)


def test_banded_distance_equals_plain_dynamic_program():
    rng = random.Random(2)
    for _ in range(60):
        p = np.array([rng.randrange(3) for _ in range(rng.randint(5, 14))])
        t = np.array([rng.randrange(3) for _ in range(rng.randint(0, 25))])
        d = [[0] * (len(t) + 1)]
        for i in range(1, len(p) + 1):
            d.append([i])
            for j in range(1, len(t) + 1):
                d[i].append(min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + int(p[i - 1] != t[j - 1])))
        low, width = -len(p), len(p) + len(t) + 1
        assert decontaminate.banded_distance(p, t, low, width, 99)[0] == min(d[-1])


# ---- 6 URL filter

def test_url_filter_cases(spark):
    urls = [None, "", "no scheme", "http://ORG/x", "http://a.Example.ORG/es/x?q=1", "http://example.org/en/123#f",
            "http://notexample.org/es/", "http://org", "https://x.com/fr/", "https://x.com/de/://y", "ftp://com/fr",
            "http://a.b.c.com/fr/x", "http://q?x/de/", "s://" + "a." * 3000 + "com/de/" + "p" * 5000]
    pages = spark.createDataFrame([(i, u, 1, 2) for i, u in enumerate(urls)] + [(3, urls[3], 1, 2)],
                                  "page_id long, url string, host int, _kh int")
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in
           url_filter.url_filter(pages, url_filter.rules_table(spark)).collect()}
    none = (None, "allow")
    assert got == {0: none, 1: none, 2: none, 3: ("org/", "allow"), 4: ("example.org/es/", "block"),
                   5: ("example.org/en/1", "block"), 6: ("org/", "allow"), 7: none, 8: ("com/fr/", "allow"),
                   9: ("com/de/", "block"), 10: none, 11: ("com/fr/", "allow"), 12: none, 13: ("com/de/", "block")}
    assert url_filter.url_filter(pages, url_filter.rules_table(spark)).count() == len(urls) + 1
    assert url_filter.url_filter(pages, url_filter.rules_table(spark).where("host = ''")).count() == len(urls) + 1
    assert url_filter.url_filter(pages.where("page_id < 0"), url_filter.rules_table(spark)).count() == 0


def test_bloom_has_no_false_negatives_and_few_false_positives(spark):
    keys = spark.range(3000).selectExpr("xxhash64(id) as h", "id")
    b = bloom.BlockedBloom.build(keys, "h")
    there = np.array([r["h"] for r in keys.collect()])
    assert (bloom.xx64(np.arange(3000)).view(np.int64) == there).all()
    assert b.probe(there).all()
    assert b.probe(bloom.xx64(np.arange(10_000, 30_000)).view(np.int64)).mean() < 0.02


# ---- 7 quality

def test_quality_held_out(spark):
    import duckdb
    docs = queries.read_table(spark, "/root/testdata/sf0.01", "documents")
    got = {r["doc_id"]: r for r in queries.QUERIES["op7_quality"](spark, "/root/testdata/sf0.01").collect()}
    assert len(got) == docs.count()
    labels = duckdb.sql("select doc_id, quality from '/root/testdata/sf0.01/labels.parquet'").fetchall()
    held = [(got[d]["predicted"], q) for d, q in labels if d in got and got[d]["held_out"]]
    assert np.mean([p == q for p, q in held]) > 0.9
    assert all(got[d]["held_out"] == (zlib.crc32(str(d).encode()) % 5 == 0) for d in got)


def test_quality_edges(spark, edge_rows):
    docs = frame(spark, edge_rows)
    labels = spark.createDataFrame([(1, 1), (7, 0), (7, 0), (None, 1), (3, None), (12, 1)], "doc_id long, quality int")
    out = quality.quality_scores(docs, quality.fit_quality(docs, labels)).collect()
    assert len(out) == len(edge_rows) and all(0 <= r["score"] <= 1 for r in out)
    none = quality.quality_scores(docs, quality.fit_quality(docs, labels.where("doc_id < 0"))).collect()
    assert {r["score"] for r in none} == {0.5}
    assert quality.quality_scores(empty(spark), quality.fit_quality(empty(spark), labels)).count() == 0


def test_quality_features_do_not_depend_on_blocks(monkeypatch):
    rng = random.Random(3)
    texts = [prose(rng, n).encode() for n in (0, 1, 5, 400, 3000)]
    odds = np.random.default_rng(1).standard_normal(quality.BUCKETS).astype(np.float32)
    whole = quality.score(texts, odds, 0.1)
    one = [quality.score([t], odds, 0.1)[0] for t in texts]
    monkeypatch.setattr(quality, "BLOCK", 700)
    assert np.allclose(whole, one) and np.allclose(whole, quality.score(texts, odds, 0.1), atol=2e-3)


# ---- 8 language model

def test_lm_base_counts_and_gain(spark):
    import duckdb
    rows = duckdb.sql("select doc_id, text from '/root/testdata/sf0.01/documents.parquet'").fetchall()
    got = {r["doc_id"]: r for r in queries.QUERIES["op8_lm"](spark, "/root/testdata/sf0.01").collect()}
    words = lambda t: re.findall(rb"[^\x20\x09-\x0D]+", t.encode().lower()) + [b"\n"]
    c = Counter(w for d, t in rows if zlib.crc32(str(d).encode()) % 7 != 2 for w in words(t))
    n, v = sum(c.values()), len(c)
    for d, t in rows:
        w = words(t)
        assert (got[d]["n_tokens"], got[d]["n_known"], got[d]["train_tokens"]) == (len(w), sum(x in c for x in w), n)
        assert abs(got[d]["base_score"] - sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w)) < 1e-6 * len(w) + 1e-6
    held = [r for r in got.values() if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_lm_rare_words_come_by_join(spark, edge_rows):
    docs = frame(spark, edge_rows)
    few = {(r["doc_id"], r["n_tokens"], r["n_known"], round(r["base_score"], 6)) for r in
           lm.lm_scores(docs, n_frequent=64, share=1, trainers=2, kept=64).collect()}
    many = {(r["doc_id"], r["n_tokens"], r["n_known"], round(r["base_score"], 6)) for r in
            lm.lm_scores(docs, n_frequent=64, share=1, trainers=2).collect()}
    assert few == many
    assert lm.lm_scores(empty(spark)).count() == 0


def test_lm_training_spreads_copies_and_repeats(spark):
    same = " ".join(f"w{i % 40}" for i in range(200))
    docs = spark.range(400).selectExpr("id as doc_id", f"if(id < 200, '{same}', concat('{same} ', id)) as text")
    vocab = lm.build_vocab(lm.count_words(docs, "text"), 64)
    start = lm.initial(vocab)
    a, b = (lm.fit(docs, "doc_id", "text", vocab, share=4, trainers=2, rounds=1, trainer_chars=5000) for _ in range(2))
    for n in start:
        assert np.isfinite(a[n]).all() and np.array_equal(a[n], b[n])
    assert not np.array_equal(a["cls"], start["cls"])
    # one text in many rows is neither taken nor left as a whole
    picked = docs.where("doc_id < 200 and pmod(xxhash64(text, doc_id, 21), 4) = 0").count()
    assert 20 < picked < 90


def test_lm_trains_on_every_training_row(spark):
    n = lm.CLASS_WORDS
    docs = frame(spark, [(i, f"w{i} w{i} w{i}") for i in range(n)])
    vocab = lm.build_vocab(lm.count_words(docs, "text"), n)
    assert vocab.n_frequent == n
    moved = (lm.fit(docs, "doc_id", "text", vocab)["in"] != lm.initial(vocab)["in"]).any(axis=1)
    inputs = [i for word, i in vocab.ids.items() if i < n and word != lm.END]
    assert len(inputs) >= n - 1 and moved[inputs].all()   # the row of each document's own word was trained


def test_lm_probabilities_sum_to_one():
    rng = np.random.default_rng(0)
    k = 2 * lm.CLASS_WORDS
    vocab = lm.Vocab({}, np.arange(k, 0, -1), k, rng.integers(0, 50, lm.N_REST).astype(float), 1, 1)
    w = lm.initial(vocab)
    h = rng.standard_normal((1, lm.HIDDEN)).astype(np.float32)
    y = np.arange(k + lm.N_REST)
    p, _ = lm.window_log_probs(w, np.repeat(h, len(y), axis=0), y, k)
    assert abs(np.exp(p).sum() - 1) < 1e-4


def test_lm_gradients_match_differences():
    rng = np.random.default_rng(1)
    k = lm.CLASS_WORDS
    vocab = lm.Vocab({}, np.arange(k, 0, -1), k, np.ones(lm.N_REST), 1, 1)
    w = {n: x.astype(np.float64) for n, x in lm.initial(vocab).items()}
    h, y = rng.standard_normal((6, lm.HIDDEN)), rng.integers(0, k + lm.N_REST, 6)
    grads = {n: np.zeros_like(x) for n, x in w.items()}
    lp, back = lm.window_log_probs(w, h, y, k, grads)
    for i, j in ((0, 0), (3, 5), (5, 15)):
        moved = h.copy()
        moved[i, j] += 1e-5
        assert abs((lp.sum() - lm.window_log_probs(w, moved, y, k)[0].sum()) / 1e-5 - back[i, j]) < 1e-3


def test_lm_state_is_carried_over_windows():
    rng = np.random.default_rng(2)
    k = lm.CLASS_WORDS
    w = lm.initial(lm.Vocab({}, np.arange(k, 0, -1), k, np.ones(lm.N_REST), 1, 1))
    seqs = [rng.integers(0, k, n) for n in (1, 7, 64, 65, 300)]
    a = lm.score_sequences(w, seqs, k, 0, window=8)
    assert np.allclose(a, lm.score_sequences(w, seqs, k, 0, window=1000), rtol=1e-5)
    assert np.allclose(a, [lm.score_sequences(w, [s], k, 0)[0] for s in seqs], rtol=1e-5)


# ---- 9 packing

def check_pieces(rows, texts):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(queries.tokenizer_paths()[0])
    ids = lambda t: np.array(tok.encode(t or "", add_special_tokens=False).ids + [1], dtype="<u4")
    want = Counter()
    for d, t in texts:
        want[(d, len(ids(t)))] += 1
    for d in {d for d, _ in texts}:
        total = sum(len(ids(t)) for x, t in texts if x == d)
        assert sum(r["length"] for r in rows if r["doc_id"] == d) == total
    one = {d: ids(t) for d, t in texts if sum(x == d for x, _ in texts) == 1}
    for r in rows:
        if r["doc_id"] in one:
            part = one[r["doc_id"]][r["start"]:r["start"] + r["length"]]
            assert zlib.crc32(part.tobytes()) == r["ids_crc32"] and r["doc_tokens"] == len(one[r["doc_id"]])
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for s, parts in by.items():
        at = 0
        for off, n in sorted(parts):
            assert off == at
            at += n
        assert at == 2048 or s == max(by)
    assert sorted(by) == list(range(len(by)))


def test_packing(spark, edge_rows):
    extra = [(20, "two  spaces   three \n lines\n\n end "), (21, "<|endoftext|> x"), (22, " lead"), (23, "it's we'll  'd"),
             (24, "tab\tand\u00a0nbsp \u2003wide 日本語 123 12.5%"), (25, "\n"), (26, "a \n b\r\n c")]
    rows = edge_rows + extra
    check_pieces(packing.pack(frame(spark, rows), queries.tokenizer_paths()).collect(), rows)
    assert packing.pack(empty(spark), queries.tokenizer_paths()).count() == 0


def test_hilbert_curve_steps_to_neighbours():
    n = 8
    grid = np.array([(x, y, z) for x in range(n) for y in range(n) for z in range(n)])
    key = packing.hilbert_keys(grid, bits=3)
    assert sorted(key) == list(range(n ** 3))
    path = grid[np.argsort(key)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


# ---- 10 surrogates

CASES = ["Mail ana.ruiz@mail7.example.com or ANA.RUIZ@MAIL7.EXAMPLE.COM now",
         "call +1 (017) 555-7713, host 97.51.17.173 and 999.1.1.1 stay", "card 4111 1111 1111 1111 and 4111111111111111 end",
         'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962"!', "Mrs. Anna Smith met Mr John Smith; later Mrs. Smith left",
         "ssn 123-45-6789 iban DE89 3704 0044 0532 0130 00", "Госпожа Анна Иванова пришла", None, "", "clean text 0.34 v 3.11 and 12",
         "bob.1@mail1.example.com bob.2@mail1.example.com"]


def luhn(d):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10


def test_surrogates(spark):
    docs = frame(spark, list(enumerate(CASES)) + [(0, CASES[0])])
    out = pii.replace_personal_data(docs)
    assert out.columns == [*docs.columns, "n_entities"]
    got = out.orderBy("doc_id").collect()
    text = {r["doc_id"]: r["text"] for r in got}
    n = {r["doc_id"]: r["n_entities"] for r in got}
    assert len(got) == len(CASES) + 1 and got[0]["text"] == got[1]["text"]
    assert n == {0: 2, 1: 2, 2: 2, 3: 1, 4: 3, 5: 2, 6: 1, 7: 0, 8: 0, 9: 0, 10: 2}
    assert (text[7], text[8], text[9]) == (None, "", CASES[9])
    a, b = re.findall(r"\S+@\S+", text[0])
    assert a != "ana.ruiz@mail7.example.com" and b == a.upper() and re.fullmatch(r"[a-z]{3}\.[a-z]{4}@[a-z]{4}\d\.[a-z]{7}\.com", a)
    m = re.fullmatch(r"call (\+1 \(\d{3}\) \d{3}-\d{4}), host (\d\d\.\d\d\.\d\d\.\d{3}) and 999.1.1.1 stay", text[1])
    assert m and "555-7713" not in text[1] and "97.51" not in text[1] and int(m[2].split(".")[3]) < 256
    m = re.fullmatch(r"card (\d{4} \d{4} \d{4} \d{4}) and (\d{16}) end", text[2])
    assert m[1].replace(" ", "") == m[2] != "4" + "1" * 15 and luhn(m[2]) == 0
    assert re.fullmatch(r'token = "[0-9a-f]{40}"!', text[3]) and text[3] != CASES[3]
    m = re.fullmatch(r"Mrs. ([A-Z][a-z]+a) ([A-Z][a-z]+) met Mr ([A-Z][a-z]+n) ([A-Z][a-z]+); later Mrs. ([A-Z][a-z]+) left", text[4])
    assert m and m[2] == m[4] == m[5] != "Smith"
    assert re.fullmatch(r"ssn \d{3}-\d\d-\d{4} iban DE\d\d \d{4} \d{4} \d{4} \d{4} \d\d", text[5])
    assert re.fullmatch(r"Госпожа [А-Я][а-я]+на [А-Я][а-я]+ пришла", text[6]) and "Иванова" not in text[6]
    x, y = re.findall(r"\S+@\S+", text[10])
    assert x != y and x.split("@")[1] == y.split("@")[1]
    assert pii.replace_personal_data(empty(spark)).count() == 0


def test_surrogates_stay_distinct_when_shapes_are_scarce(spark):
    addresses = [f"{a}.{b}.7.7" for a in range(10) for b in range(10)]     # all addresses of one shape
    mails = [f"{c}@{d}.com" for c in "abcdefghijklmnopqrst" for d in "ab"]
    docs = frame(spark, [(0, " ; ".join(addresses)), (1, " ; ".join(mails))])
    got = {r["doc_id"]: r["text"].split(" ; ") for r in pii.replace_personal_data(docs).collect()}
    assert len(set(got[1])) == len(mails) and not set(got[1]) & set(mails)
    assert len(set(got[0])) == len(addresses)


# ---- faults once found by review

def test_mail_domains_of_any_length(spark):
    texts = ["see a@b" + ".c" * n + " now" for n in (1, 500, 4000, 100_000)] + ["x" * 50_000 + "@" + "y-" * 50_000 + ".org", "a" * 200_000 + " 1.2.3.4"]
    rows = {r["doc_id"]: r for r in pii.replace_personal_data(frame(spark, list(enumerate(texts)))).collect()}
    for i, t in enumerate(texts):
        assert rows[i]["n_entities"] == 1 and rows[i]["text"] != t
    assert all(rows[i]["text"].startswith("see ") and rows[i]["text"].endswith(" now") for i in range(4))


def test_personal_data_beside_odd_columns(spark):
    df = frame(spark, [(1, "mail bob@example.com")]).selectExpr("*", "7 as `a.b`", "8 as _pii_map", "9 as n_entities", "'z' as `k``q`")
    out = pii.replace_personal_data(df)
    r = out.first().asDict()
    assert out.columns == [*[c for c in df.columns if c != "n_entities"], "n_entities"]
    assert (r["a.b"], r["_pii_map"], r["k`q"], r["n_entities"]) == (7, 8, "z", 1) and "bob@" not in r["text"]


@pytest.mark.parametrize("bits", [1, 2, 3])
def test_links_past_the_hot_bound_keep_components(spark, bits):
    rng = random.Random(bits)
    for fps in ([1, 2, 3], [rng.getrandbits(4) | rng.getrandbits(3) << 30 for _ in range(60)]):
        fps = sorted(set(fps))
        df = spark.createDataFrame([(f,) for f in fps], "fp long")
        roots = {r["node"]: r["root"] for r in components.components(simhash.simhash_links(df, bits, hot=1), "a", "b").collect()}
        want = {f: f for f in fps}
        for _ in fps:
            for a in fps:
                want[a] = min(want[b] for b in fps if bin(a ^ b).count("1") <= bits)
        assert {f: roots.get(f, f) for f in fps} == want


def test_keep_one_with_repeated_ids(spark):
    a, b = "one two three four five", "six seven eight nine ten"
    df = frame(spark, [(1, a), (0, b), (1, b)])
    assert sorted((r["doc_id"], r["text"]) for r in simhash.keep_one(df).collect()) == [(0, b), (1, a)]
    odd = df.selectExpr("*", "1 as _kid", "2 as `a.b`", "3 as k")
    assert simhash.keep_one(odd).columns == odd.columns


NAMES = ["Mrs. Anna Smith-Jones came. Anna Smith-Jones left, and Jones's dog; anna stays. Contact John Miller",
         "MR. SMITH and Mr. J. Doe met Dr O'Brien; O'BRIEN saw Doe and Mr K. McDonald. DON'T MISS THE SHOW",
         "Dr. Smith", "no titles: Anna Smith", "Mr Lee Lee, Mrs Lee and Lee", "Mr. A Bc-De-Fg Hi " + "Hi " * 20_000]


def plain_names(texts, words):
    """The rewriting in plain Python, by the surrogates ``words`` that the operator chose."""
    title = (r"(?<![^\W\d_])(?:(?:" + "|".join(t for ts in pii.TITLES.values() for t in ts) + r")\.?|(?:MR|MRS|MS|DR|PROF)\.) ")
    one = r"(?:[A-Z]['’](?=[A-Z]))?[A-Z][a-zA-Z]+"
    named = r"(?:[A-Z]\.? ){0,3}" + one + r"(?:-[A-Z][a-zA-Z]+){0,3}"
    for text in texts:
        known = set()
        for m in re.finditer(title + "(" + named + "(?: " + named + ")?)", text):
            known |= {w.lower() for w in re.findall(r"(?<![a-zA-Z])" + one, m[1])}
        def swap(m):
            s = words.get(m[0].lower()) if m[0].lower() in known else None
            return m[0] if s is None else s.upper() if m[0].isupper() else s[0].upper() + s[1:]
        yield known, re.sub(r"(?<![a-zA-Z])" + one, swap, text)


def test_names_are_replaced_wherever_they_return(spark):
    rows = [r for r in pii.replace_personal_data(frame(spark, list(enumerate(NAMES)))).orderBy("doc_id").collect()]
    got = [r["text"] for r in rows]
    words = {}
    for old, new in zip(NAMES, got):
        a, b = re.findall(r"[A-Za-z'’]+", old), re.findall(r"[A-Za-z'’]+", new)
        assert len(a) == len(b)
        for x, y in zip(a, b):
            if x != y and len(x) > 1:
                x, y = x.removesuffix("'s"), y.removesuffix("'s")
                words[x.lower()] = y.lower()
                assert x.isupper() == y.isupper() and y[0].isupper()
    one_letter = re.compile(r"(?<![A-Za-z'’])[A-Z](?![A-Za-z'’])")
    for (known, want), new in zip(plain_names(NAMES, words), got):
        assert one_letter.sub("?", want) == one_letter.sub("?", new)
        assert not any(re.search(r"(?<![A-Za-z])(?:" + w + "|" + w.title() + "|" + w.upper() + ")(?![A-Za-z])", new)
                       for w in known - {"anna"})
    assert "Contact John Miller" in got[0] and "anna stays" in got[0] and got[3] == NAMES[3] and "DON'T MISS THE SHOW" in got[1]
    assert " J. " not in got[1] and " K. " not in got[1] and len(set(words.values())) == len(words)
    assert [r["n_entities"] for r in rows] == [5, 6, 1, 0, 3, 20_001]
