"""Operator 2: gradients, windows, held-out accuracy."""

import random

import numpy as np
import pytest

from ridgeline.llm import toxicity
from ridgeline.llm.toxicity import STEP, WINDOW, Network, Text, window_index


def words(rng, n, bad):
    good = ["".join(rng.choice("aeioustrn") for _ in range(rng.randint(2, 7))) for _ in range(n)]
    for _ in range(bad):
        good[rng.randrange(n)] = rng.choice(["zork", "Zorkling", "gribble", "gribbled", "zorkest"]) + rng.choice(["", ",", "."])
    return " ".join(good)


def sample(seed, n):
    rng = random.Random(seed)
    labels = [int(rng.random() < 0.3) for _ in range(n)]
    return [words(rng, rng.randint(20, 200), rng.randint(2, 5) if y else 0) for y in labels], labels


@pytest.fixture(scope="module")
def net():
    return toxicity.fit(*sample(1, 300), steps=160)


def test_held_out_accuracy(net):
    texts, labels = sample(2, 200)
    assert np.mean((net.scores(texts) >= 0.5) == np.array(labels)) > 0.92


def test_held_out_accuracy_keeps_its_first_floor(net):
    texts, labels = sample(2, 200)
    assert np.mean((net.scores(texts) >= 0.5) == np.array(labels)) > 0.95


def test_steps_follow_the_windows(monkeypatch):
    drawn = []

    def gradient(self, t, index, mask, label, rng):
        drawn.append(label)
        return 0.0, {k: np.zeros_like(v) for k, v in self.p.items()}

    monkeypatch.setattr(Network, "gradient", gradient)
    toxicity.fit(["a " * 16 * 401] * 4 + ["b " * 16 * 301] * 4, [0] * 4 + [1] * 4, steps=4, batch=6)
    # Three texts of each class are fitted on, 400 and 300 windows each.
    assert sum((label == 0).sum() for label in drawn) >= 1200 and sum((label == 1).sum() for label in drawn) >= 900


def test_worst_window_of_every_toxic_text_stands_out():
    net, t = Network(3), Text(["ab cd"] * 20_500)
    net.p["bias"][:] = -100
    first, text = t.windows()
    assert set(text[toxicity.stand_out(net, t, first, t.starts[text + 1], text, np.arange(len(first)))]) == set(range(20_500))


def test_scores_do_not_depend_on_the_batch(net):
    texts = [*sample(3, 20)[0], "", None, "word " * 2000, "x" * 500, "zork"]
    together = net.scores(texts)
    assert np.allclose(together, [net.scores([t])[0] for t in texts], atol=1e-4)
    assert ((0 <= together) & (together <= 1)).all() and together[20] == together[21] == 0


def test_every_word_is_in_a_window_and_windows_overlap():
    t = Text(["", "a " * WINDOW, "b " * (WINDOW + 1), "c", "d " * 333, None])
    first, text = t.windows()
    for k in range(6):
        own, n = first[text == k] - t.starts[k], t.starts[k + 1] - t.starts[k]
        covered = {p for s in own.tolist() for p in range(s, min(s + WINDOW, n))}
        assert covered == set(range(n)) and all(np.diff(own) == STEP)
    whole = Text(["é" * 100 + " ab"])
    assert whole.size.max() <= toxicity.LONGEST and whole.size[whole.word].sum() == 202


def test_gradient():
    rng = np.random.default_rng(0)
    net = Network(3)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    t = Text(["one two three four", "five two six", "one"])
    first, text = t.windows()
    index, mask = window_index(t, first, t.starts[text + 1])
    label = np.array([1.0, 0.0, 1.0])
    seed = lambda: np.random.default_rng(5)
    _, g = net.gradient(t, index, mask, label, seed(), 2)
    for name in net.p:
        flat = net.p[name].reshape(-1)
        grad = g[name].reshape(-1)
        for i in rng.choice(np.flatnonzero(np.abs(grad) > np.abs(grad).max() * 0.1), 2):
            old = flat[i]
            around = []
            for step in (1e-2, -1e-2):
                flat[i] = old + step
                around.append(net.gradient(t, index, mask, label, seed())[0])
            flat[i] = old
            assert abs((around[0] - around[1]) / 2e-2 - grad[i]) < 0.05 * abs(grad).max() + 1e-4, name


def test_table(spark, docs_of, net):
    texts, labels = sample(4, 60)
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "zork"), (900, None), (901, "")]
    docs = docs_of(rows)
    got = {r.doc_id: r for r in toxicity.score(docs, net).collect()}
    import zlib

    assert len(got) == len(rows)
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i in range(60)) and got[None].held_out
    assert all(r.predicted == int(r.score >= 0.5) for r in got.values()) and got[900].score == got[901].score == 0
    kept = toxicity.keep_clean(docs, net)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if not r.predicted}
    labels = spark.createDataFrame([(i, y) for i, y in enumerate(labels)] + [(None, 1), (5, None), (6, 7)], "doc_id bigint, toxic int")
    assert toxicity.train(docs, labels.filter("toxic = 0")) is None
    assert {r.score for r in toxicity.score(docs, None).collect()} == {0.0}
    assert toxicity.score(docs_of([]), net).count() == 0


def test_held_out_labels_are_not_used(spark, docs_of, monkeypatch):
    seen = []
    monkeypatch.setattr(toxicity, "fit", lambda texts, labels: seen.extend(zip(texts, labels)))
    docs = docs_of([(i, f"text {i}") for i in range(100)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(100)] + [(None, 1)], "doc_id bigint, toxic int")
    toxicity.train(docs, labels, sample_rows=10)
    import zlib

    ids = [int(t.split()[1]) for t, _ in seen]
    assert len(ids) == 30 and all(zlib.crc32(str(i).encode()) % 5 for i in ids) and [y for _, y in seen] == [i % 2 for i in ids]
