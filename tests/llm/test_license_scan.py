import random
import textwrap

from keelstone.llm import license_scan as ls

SCHEMA = "doc_id long, text string, family string"


def lines(n, seed):
    rng = random.Random(seed)
    return [" ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6))) for _ in range(20)) for _ in range(n)]


def test_scan(spark):
    model = ls.train(lines(500, 1))
    body = lines(60, 2)
    rows, want = [], set()
    notices = [(k, t) for k, ts in ls.TEMPLATES.items() for t in ts]
    for i, (family, text) in enumerate(notices):
        own = text.upper() if i % 2 else text + "."
        rows.append((i, "\n".join([body[i], own, body[i + 1]] if i % 3 else [own, own]), "x"))
        want.add((i, family, 1 if i % 3 else 2, 1 if i % 3 else 0))
    rows += [(100 + i, t, "x") for i, t in enumerate(ls.OTHERS + body)]
    rows += [(200, None, ""), (201, "", ""), (202, "\n\n", ""), (None, f"{body[0]}\n" * 3000 + "Released under the MIT License.", ""), rows[1]]
    got = ls.scan(spark.createDataFrame(rows, SCHEMA), model).collect()
    assert {(r.doc_id, r.family, r.n_paragraphs, r.first_line) for r in got} == want | {(None, "MIT", 1, 3000)}
    assert len(got) == len(want) + 2 and all(0.5 <= r.probability <= 1 and r.likeness >= 0.7 for r in got)
    assert ls.scan(spark.createDataFrame([], SCHEMA), ls.train([])).collect() == []
    assert ls.sample(spark.createDataFrame([], SCHEMA)) == []


def test_wrapped_notices(spark):
    model = ls.train(lines(500, 1))
    body = lines(60, 2)
    rows, want = [], set()
    for i, (family, text) in enumerate((k, t) for k, ts in ls.TEMPLATES.items() for t in ts):
        for j, (width, mark) in enumerate(((70, ""), (70, " * "), (70, "\n"), (30, "# "), (12, ""))):
            own = [mark + x for x in textwrap.wrap(text, width, break_on_hyphens=False, break_long_words=False)]
            rows.append((10 * i + j, "\n".join([body[i], *own, body[i + 1]]), "x"))
            want.add((10 * i + j, family, 1, 2 if mark == "\n" else 1))
    got = ls.scan(spark.createDataFrame(rows, SCHEMA), model).collect()
    assert {(r.doc_id, r.family, r.n_paragraphs, r.first_line) for r in got} == want and len(got) == len(want)
    twice = "\n".join(textwrap.wrap(ls.TEMPLATES["MIT"][2], 70) * 2)
    assert [(r.family, r.n_paragraphs, r.first_line) for r in ls.scan(spark.createDataFrame([(1, twice, "")], SCHEMA), model).collect()] == [("MIT", 2, 0)]


def test_several_notices_in_one_line(spark):
    model = ls.train(lines(500, 1))
    body = lines(60, 2)
    every = [(k, t) for k, ts in ls.TEMPLATES.items() for t in ts]
    rows, want = [], set()
    for i, (family, text) in enumerate(every):
        for j, (other, second) in enumerate((every[(i + 5) % len(every)], every[(i + 9) % len(every)])):
            rows.append((10 * i + j, " ".join([body[i], text, *body[20:24], second, body[i + 1]]), ""))
            want |= {(10 * i + j, k, 1, 0) for k in (family, other)}
    got = ls.scan(spark.createDataFrame(rows, SCHEMA), model).collect()
    assert {(r.doc_id, r.family, r.n_paragraphs, r.first_line) for r in got} == want and len(got) == len(want)


def test_unseen_changes_and_unknown_text():
    model = ls.train(lines(500, 1))
    rng = random.Random(9)
    right = total = 0
    for family, texts in ls.TEMPLATES.items():
        for t in texts:
            for _ in range(20):
                w = t.split()
                if len(w) > 7:
                    w[rng.randrange(len(w))] = "changed"
                h = ls.hashes([" ".join(lines(1, rng.random()) + w)])[0]
                guess, sure, _ = model.predict(h)
                number = ls.TEMPLATES[family].index(t)
                told = all(ls.np.isin(x, ls.pairs(h)).mean() >= ls.LIKENESS for x in model.telling[family][number])
                assert told or guess in (family, ls.UNKNOWN)  # the word that tells it from its like was changed: never another licence
                right += told and guess == family and sure >= 0.5
                total += told
    assert right >= 0.95 * total
    assert sum(model.predict(h)[1] >= 0.5 for h in ls.hashes(lines(300, 77))) <= 3


def test_licences_that_are_alike():
    model = ls.train(lines(500, 1))
    gnu = "This library is free software; you can redistribute it and/or modify it under the terms of the GNU {} as published by the Free Software Foundation; either version {} of the License, or (at your option) any later version."
    cases = {
        gnu.format("Lesser General Public License", "2.1"): {"LGPL-2.1"}, gnu.format("General Public License", "2"): {"GPL-2.0"}, gnu.format("General Public License", "3"): {"GPL-3.0"}, gnu.format("Affero General Public License", "3"): {"AGPL-3.0"},
        gnu.format("Free Documentation License", "1.3"): set(), gnu.format("General Public License", "9"): set(), "SPDX-License-Identifier: MIT": {"MIT"}, "// SPDX-License-Identifier: GPL-2.0-only": {"GPL-2.0"}, "SPDX-License-Identifier: Zlib": set(),
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:": {"BSD"}, "Released under the BSD 2-Clause License": {"BSD-2-Clause"},
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.": {"ISC"},
        "This is free and unencumbered software released into the public domain.": {"Unlicense"}, "Licensed under CC BY-ND 4.0": set(), "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License": set(),
    }
    for text, want in cases.items():
        (h,) = ls.hashes([text])
        family, sure, like = model.predict(h)
        assert ({family} - {ls.UNKNOWN} if sure >= ls.CHANCE else set()) == want, (text, family, sure, like)


def test_likeness_and_features_are_what_counting_says():
    model, rng = ls.train(lines(50, 3)), random.Random(4)
    words = lambda t: "".join(c if c.isalnum() else " " for c in t.lower()).split()
    for family, ts in ls.TEMPLATES.items():
        for number, t in enumerate(ts):
            text = " ".join(w for w in words(t) if rng.random() < 0.9)
            own, have = words(t), set(zip(words(text), words(text)[1:]))
            every = set(zip(own, own[1:]))
            got = model.likeness(family, number, ls.distinct(ls.pairs(ls.hashes([text])[0])), 0.0)
            assert abs(got - len(every & have) / len(every)) < 1e-9
            assert int((model.features(ls.hashes([text])[0])[:-2] > 0).sum()) == len(set(words(text))) + len(have & {p for ks in ls.TEMPLATES.values() for x in ks for p in zip(words(x), words(x)[1:])})
