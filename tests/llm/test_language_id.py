import random

import numpy as np
import pytest

from keelstone.llm import language_id as lid

SCHEMA = "doc_id long, text string, lang string, score string, source string"


def longest(text: str, at: int, own: str) -> int:
    n = 0
    while at + n < len(text) and text[at : at + n + 1] in own:
        n += 1
    return n


def brute(text: str, own: str) -> int:
    at = n = 0
    while at < len(text):
        at += max(1, longest(text, at, own))
        n += 1
    return n


def test_phrases_are_the_greedy_parse(monkeypatch):
    rng = random.Random(5)
    make = lambda letters, n: "".join(rng.choice(letters) for _ in range(n))
    model = lid.Model({"x": make("abc ", 300), "y": make("cde ", 200)})
    texts = [make("abcdeq ", rng.randint(1, 60)) for _ in range(200)]
    codes = [model.codes(t) for t in texts]
    width = max(map(len, codes))
    windows = np.array([[*c, *[0] * (width - len(c))] for c in codes])
    got = model.phrases(windows)
    rng = random.Random(5)
    again = {"x": " " + " ".join(make("abc ", 300).split()) + " ", "y": " " + " ".join(make("cde ", 200).split()) + " "}
    for i, t in enumerate(texts):
        plain = " " + " ".join(t.split()) + " " if t.split() else " "
        assert len(codes[i]) == len(plain)
        for k, lang in enumerate("xy"):
            assert got[k, i] == brute(plain, again[lang])


@pytest.mark.parametrize("window, cells", [(1, 0), (3, 1 << 30), (16, 0), (512, 0)])
def test_windows_make_no_difference(monkeypatch, window, cells):
    monkeypatch.setattr(lid, "WINDOW", window)
    monkeypatch.setattr(lid, "CELLS", cells)
    rng = random.Random(6)
    make = lambda letters, n: "".join(rng.choice(letters) for _ in range(n))
    own = {"x": make("ab ", 60) + "a" * 50, "y": make("bcd ", 200)}
    model = lid.Model(own)
    again = {k: " " + " ".join(v.split()) + " " for k, v in own.items()}
    texts = [make("abcdq ", rng.randint(1, 90)) for _ in range(80)] + ["a" * 300, "a" * 49, again["y"].strip() * 3, None, "1"]
    rates, known = model.rates(texts)
    for i, t in enumerate(texts):
        plain = " ".join((t or "").replace("1", " ").split())
        assert known[i] == bool(plain)
        for k, lang in enumerate("xy"):
            if plain:
                assert round(rates[i, k] * (len(plain) + 2) / model.bits[k], 6) == brute(f" {plain} ", again[lang])


def words(kind: str, n: int, seed: int) -> str:
    own = {"en": ["the", "and", "thing", "weather"], "fr": ["été", "être", "leçon", "chaud"]}[kind]
    rng = random.Random(seed)
    return " ".join(rng.choice(own) + rng.choice(["", "s"]) for _ in range(n))


def test_accuracy_and_odd_rows(spark):
    rows = [(i, words("en" if i % 3 else "fr", 30, i), "en" if i % 3 else "fr", "x", "y") for i in range(200)]
    odd = [(900, None, "en", "", ""), (901, "", None, "", ""), (902, "12 !? 34", "fr", "", ""), (None, words("fr", 9, 1), None, None, None), (903, words("en", 60_000, 3), None, "", ""), (904, "漢字", None, "", "")]
    docs = spark.createDataFrame(rows + odd + odd[:1], SCHEMA)
    model = lid.train(docs.where("doc_id % 4 <> 2"))
    got = {r.doc_id: r for r in lid.identify(docs, model).collect()}
    assert all(got[i].lang_pred == lang and 0 <= got[i].score <= 1 for i, _, lang, *_ in rows)
    assert [got[i].lang_pred for i in (900, 901, 902, None, 903)] == ["und", "und", "und", "fr", "en"]
    assert got[904].lang_pred in ("en", "fr") and got[900].phrase_rate is None
    assert lid.identify(docs, model).count() == docs.count()
    kept = lid.identify(docs, model, keep=lambda names, scores, rates: names != "und")
    assert kept.columns == docs.columns and kept.count() == docs.count() - 4


def test_a_language_of_many_letters_stays(spark):
    rng = random.Random(8)
    han = [chr(0x4E00 + i) for i in range(3000)]
    own = lambda n: "".join(rng.choice(han) + rng.choice(han[:40]) for _ in range(n))
    rows = [(i, own(150) if i % 2 else words("en", 60, i), "zh" if i % 2 else "en", "", "") for i in range(160)]
    rows += [(900, own(200), None, "", ""), (901, "кот " * 50, None, "", ""), (902, words("en", 50, 1), None, "", ""), (903, None, "en", "", ""), (904, "7", "en", "", "")]
    docs = spark.createDataFrame(rows, SCHEMA)
    model = lid.train(docs)
    assert model.limits["zh"] > model.limits["en"] == lid.NO_LANGUAGE
    assert {r.doc_id for r in lid.in_a_language(docs, model).collect()} == {i for i, *_ in rows} - {901, 903, 904}
    assert {r.doc_id for r in lid.in_a_language(docs, None).collect()} == {i for i, *_ in rows} - {903, 904}


def test_nothing_to_learn(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert lid.train(empty) is None
    assert lid.identify(empty, None).collect() == []
    assert lid.identify(spark.createDataFrame([(1, "abc", None, "", "")], SCHEMA), None).first().lang_pred == "und"
    assert lid.train(spark.createDataFrame([(1, "123", "en", "", "")], SCHEMA)) is None
