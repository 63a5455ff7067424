"""The language model's averaged weights: one set for the driver, whatever the number of trainers; softmax without a shift."""

import numpy as np

from tallyframe.llm import lm


def test_driver_gets_one_set_of_weights_from_many_trainers(spark, monkeypatch):
    rng = np.random.default_rng(3)
    weights, seen = rng.normal(size=(40, 50)).astype(np.float32), rng.integers(1, 9, 40)
    rows = [(p, c, weights[p, 20 * c:20 * c + 20].tobytes(), int(seen[p])) for p in range(40) for c in range(3)]
    trained = spark.createDataFrame([(p, c, bytearray(d), n) for p, c, d, n in rows], "part long, chunk long, weights binary, seen long")
    fetched, frame = [], type(trained)
    collect = frame.collect

    def counted(self):
        out = collect(self)
        fetched.append(sum(len(r["total"]) for r in out))
        return out

    monkeypatch.setattr(frame, "collect", counted)
    for parts in (1, 6, 40):
        got = lm.weighted_mean(trained, parts)
        np.testing.assert_allclose(got, (weights.astype(float) * seen[:, None]).sum(axis=0) / seen.sum(), rtol=1e-12)
    assert fetched == [50 * 8] * 3
    assert lm.weighted_mean(trained.limit(0), 6) is None


def test_softmax_with_and_without_shift():
    rng = np.random.default_rng(4)
    for scale, bias in ((1.0, 0.0), (30.0, 0.0), (1.0, 100.0)):   # the last two pass what needs no shift
        w, b = rng.normal(0, scale, (16, 9)).astype(np.float32), np.full(9, bias, np.float32)
        h, at = rng.uniform(-1, 1, (50, 16)).astype(np.float32), rng.integers(0, 9, 50)
        small = lm._small(w.T, b)
        assert small == (scale == 1.0 and bias == 0.0)
        z = (h @ w + b).astype(float)
        want = z[np.arange(50), at] - np.log(np.exp(z - z.max(axis=1, keepdims=True)).sum(axis=1)) - z.max(axis=1)
        np.testing.assert_allclose(lm._softmax(h @ w + b, at, small, True), want, atol=1e-4)


def test_gate_values_lie_in_unbroken_blocks_and_steps_are_right():
    rng = np.random.default_rng(5)
    a, rec = rng.normal(size=(30, 48)).astype(np.float32), rng.normal(size=(16, 48)).astype(np.float32)
    h = rng.uniform(-1, 1, (30, 16)).astype(np.float32)
    new, parts = lm._step(lm._by_gate(a), lm._by_gate(rec), h)
    assert all(p.flags["C_CONTIGUOUS"] for p in parts)
    u = h @ rec
    r, z = (1 / (1 + np.exp(-(a + u)[:, i:i + 16])) for i in (0, 16))
    c = np.tanh(a[:, 32:] + r * u[:, 32:])
    for got, want in zip((new, *parts), (c + z * (h - c), r, z, c, u[:, 32:])):
        np.testing.assert_allclose(got, want, atol=1e-5)


def test_training_gradient_matches_differences():
    """The first AdaGrad update shows the sign of each weight's gradient; where that is clear it is the sign of the loss's slope."""
    rng = np.random.default_rng(6)
    vocab = lm.Vocab({f"w{i}": i for i in range(64)}, rng.integers(1, 50, 64), 64, rng.integers(1, 50, lm.N_REST).astype(float), 900, 90)
    w = {n: x.astype(np.float64) for n, x in lm.initial(vocab).items()}
    seqs = [rng.integers(0, 64 + lm.N_REST, n) for n in (20, 13, 7)]
    new, seen = lm.train_on(w, seqs, 64, 3)
    assert seen == 40
    for name in ("rec", "gate", "in"):
        step = (new[name] - w[name]).ravel()
        for i in np.argsort(-np.abs(step))[:6]:
            sides = []
            for d in (1e-2, -1e-2):
                moved = {n: x.copy() for n, x in w.items()}
                moved[name].ravel()[i] += d
                sides.append(lm.score_sequences(moved, seqs, 64, 3).sum())
            assert np.sign(sides[0] - sides[1]) == np.sign(step[i])


def test_texts_are_split_for_counts_and_once_for_training_and_scores(spark):
    seen, n = spark.sparkContext.accumulator(0), 60

    def tell(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    rows = [(i, None if i == 7 else " ".join(f"w{(i * j) % 90}" for j in range(i))) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").mapInArrow(tell, "doc_id long, text string")
    got = lm.lm_scores(docs, n_frequent=64, trainers=2).collect()
    assert seen.value == 2 * n
    assert {(r["doc_id"], r["n_tokens"]) for r in got} == {(i, 1 if i == 7 else i + 1) for i in range(n)}
    assert all(r["score"] < 0 and r["n_known"] <= r["n_tokens"] for r in got)
