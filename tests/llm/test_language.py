"""Language identification: sums beside all segmentations written out, learned counts, held-out accuracy."""

import base64
import random
import zlib

import numpy as np
import pytest

from ridgeline.llm import language
from ridgeline.llm.language import Counter, Model, Scorer, Vocabulary

PIECES = [b"a", b"b", b"ab", b"ba", b"aba", b" a", b" ab", b" ", b"bb", "é".encode()]


@pytest.fixture(scope="module")
def path(tmp_path_factory):
    file = tmp_path_factory.mktemp("pieces") / "small.tiktoken"
    file.write_bytes(b"".join(base64.b64encode(p) + b" %d\n" % i for i, p in enumerate(PIECES)))
    return str(file)


def ways(unit, pieces):
    """Every segmentation of a unit."""
    if not unit:
        return [[]]
    return [[unit[:k], *rest] for k in range(1, len(unit) + 1) if unit[:k] in pieces for rest in ways(unit[k:], pieces)]


def model_of(path, languages=("x", "y", "z"), seed=1):
    words = language.vocabulary(path)
    table = np.random.default_rng(seed).dirichlet(np.ones(len(words)), len(languages)).T
    return Model(path, languages, np.array([0.5, 0.3, 0.2][: len(languages)]), np.maximum(table, language.LEAST))


def brute_log(model, text):
    place = {p: i for i, p in enumerate(language.vocabulary(model.path).pieces)}
    out = np.log(model.share)
    for word in text.lower().split():
        data = b" " + word.encode()
        for a in range(0, len(data), language.STRETCH):
            part = data[a : a + language.STRETCH]
            out = out + np.log(sum(np.prod([model.table[place[p]] for p in way], axis=0) for way in ways(part, place)))
    return out


def test_all_segmentations_are_summed(path):
    rng = random.Random(2)
    model, texts = model_of(path), ["", " ", "abab", "ABA  ba\nbb", "é", "abbaababbaab", "q", "ab" * 9]
    texts += [" ".join("".join(rng.choice("abé") for _ in range(rng.randint(1, 8))) for _ in range(rng.randint(1, 9))) for _ in range(30)]
    scorer = Scorer(model)
    for _ in range(2):  # the second time from memory
        assert np.allclose(scorer.scores(texts), [brute_log(model, t) for t in texts], atol=1e-9)


def test_expected_counts(path):
    model, words = model_of(path), language.vocabulary(path)
    texts, langs = ["abab ba", "bb abab", "aba aba", "é"], ["x", "y", "x", "z"]
    counter = Counter(model)
    counter.add(texts, langs)
    counter.walk()
    want = np.zeros((3, len(words)))
    for text, lang in zip(texts, langs):
        c = model.languages.index(lang)
        for word in text.split():
            each = [(way, np.prod([model.table[words.pieces.index(p), c] for p in way])) for way in ways(b" " + word.encode(), set(words.pieces))]
            for way, p in each:
                for piece in way:
                    want[c, words.pieces.index(piece)] += p / sum(q for _, q in each)
    assert np.allclose(counter.total / language._SCALE, want, atol=1e-3)


def test_long_words_and_bounds(path, monkeypatch):
    """Stretches never overflow or vanish, and small bounds change nothing."""
    model = model_of(path)
    texts = ["ab" * 50_000, "\u0001" * 5_000, "aab " * 3_000, "é" * 100 + " b"]
    want = Scorer(model).scores(texts)
    assert np.isfinite(want).all()
    monkeypatch.setattr(language, "WALK_BYTES", 64)
    monkeypatch.setattr(language, "REMEMBER", 8)
    scorer = Scorer(model)
    assert np.allclose(np.concatenate([scorer.scores([t]) for t in texts]), want, rtol=1e-9)
    rare = Model(model.path, ("x",), np.ones(1), np.full((len(model.table), 1), language.LEAST))
    assert np.isfinite(Scorer(rare).scores(["\u0001" * 64])).all()
    sure = Model(model.path, ("x",), np.ones(1), np.ones((len(model.table), 1)))
    assert np.isfinite(Scorer(sure).scores(["ab" * 64])).all()


def test_counts_of_any_dealing(spark, path):
    rows = [(i, "abab ba bb"[: i % 11], "xy"[i % 2]) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    a, b = language.train(docs.repartition(1), path), language.train(docs.repartition(7), path)
    assert a.languages == b.languages == ("x", "y") and (a.share == b.share).all()
    assert np.allclose(a.table, b.table, rtol=1e-3, atol=1e-9)
    assert (a.table == language.train(docs.repartition(1), path).table).all()


def test_cases_and_held_out(spark, path):
    def out(i):
        return i is None or zlib.crc32(str(i).encode()) % 4 == 2

    rng = random.Random(4)
    rows = []
    for i in range(400):
        letters = "aab" if i % 2 else "bbé"
        rows.append((i, " ".join("".join(rng.choice(letters) for _ in range(5)) for _ in range(12)), "x" if i % 2 else "y"))
    # Rows that are held out carry a language of their own, which must not be learned.
    rows = [(i, t, "secret" if out(i) else lang) for i, t, lang in rows]
    rows += [(1000, None, "x"), (1001, "", "x"), (1002, "123 !?", "x"), (None, "aab aab", "never"), (1003, "aab baa", None), (1003, "aab baa", None), (1004, "中文", "y")]
    docs = spark.createDataFrame([(*r, 1.0, "h", 2) for r in rows], "doc_id long, text string, lang string, score double, lang_pred string, letter int")
    model = language.train(docs, path)
    assert model.languages == ("x", "y")
    got = language.identify(docs, model).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append(r)
        assert r["held_out"] == out(r["doc_id"])
    assert [by[i][0]["lang_pred"] for i in (1000, 1001, 1002)] == ["und"] * 3 and by[1000][0]["score"] == 0
    assert by[1003][0] == by[1003][1] and by[1003][0]["lang_pred"] == "x" and by[None][0]["lang_pred"] == "x"
    held = [i for i in range(400) if out(i)]
    assert sum(by[i][0]["lang_pred"] == ("x" if i % 2 else "y") for i in held) / len(held) > 0.97


def test_nothing_learned_and_empty(spark, path):
    docs = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    model = language.train(docs, path)
    assert [r["lang_pred"] for r in language.identify(docs, model).collect()] == ["und"]
    none = docs.filter("doc_id < 0")
    assert language.identify(none, language.train(none, path)).collect() == []
    many = spark.createDataFrame([(i, "a", f"l{i}") for i in range(40)], docs.schema)
    with pytest.raises(ValueError):
        language.train(many, path, most_languages=5)


def test_held_out_accuracy_on_documents(spark):
    from ridgeline.llm.queries import VOCABULARY, tokenizer_path

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language.identify(docs, language.train(docs, tokenizer_path(VOCABULARY)))
    right = got.filter("held_out").join(docs.select("doc_id", "lang"), "doc_id").selectExpr("avg(int(lang = lang_pred))").first()[0]
    assert right >= 0.99


def test_bytes_are_always_pieces():
    words = Vocabulary([b"xyz", b"", b"q" * 40])
    assert len(words) == 257 and words.lattice([]).forward(np.ones((257, 1))).shape == (0, 1)
