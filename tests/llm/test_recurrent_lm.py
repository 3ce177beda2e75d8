import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from keelstone.llm import recurrent_lm as lm

SCHEMA = "doc_id long, text string, score string, rid string"
HELD = "coalesce(crc32(cast(cast(doc_id as string) as binary)) % 5 = 1, false)"


def test_gradients():
    rng = np.random.default_rng(0)
    net = lm.Network(rng.integers(1, 9, lm.SHORTLIST))
    net.p = {k: v.astype(np.float64) * (1 if k.endswith("b") else 3) for k, v in net.p.items()}
    x, y, h = rng.integers(0, lm.SHORTLIST, (4, 3)), rng.integers(0, lm.SHORTLIST, (4, 3)), rng.standard_normal((3, lm.HIDDEN))
    g, _, _ = net.gradients(x, y, h)
    for k in net.p:
        at = np.unravel_index(np.argmax(np.abs(g[k])), g[k].shape)
        keep = net.p[k][at]
        losses = []
        for d in (1e-4, -1e-4):
            net.p[k][at] = keep + d
            losses.append(net.gradients(x, y, h)[2])
        net.p[k][at] = keep
        assert abs((losses[0] - losses[1]) / 2e-4 - g[k][at]) < 1e-3 * max(1, abs(g[k][at])), k


def test_probabilities_sum_to_one_and_windows_carry_state():
    net = lm.Network(np.arange(1, lm.SHORTLIST + 1))
    h = np.random.default_rng(1).standard_normal((1, lm.HIDDEN)).astype(np.float32)
    p = 10 ** net.log10(np.repeat(h, lm.SHORTLIST, 0), np.arange(lm.SHORTLIST))
    assert abs(p.sum() - 1) < 1e-4
    texts = [np.random.default_rng(i).integers(1, lm.SHORTLIST, n) for i, n in enumerate((0, 1, 50, 3000))]
    for t, got in zip(texts, net.score(texts)):
        h, last, want = np.zeros((1, lm.HIDDEN), np.float32), lm.END, 0.0
        for w in [*t.tolist(), lm.END]:
            h = net.step(net.inputs()[[last]], h)[0]
            want += net.log10(h, np.array([w]))[0]
            last = w
        assert abs(got - want) < 1e-3 * max(1, abs(want))


def corpus():
    rng = random.Random(3)
    own = {"x": [f"x{i}" for i in range(40)], "y": [f"Y{i}" for i in range(40)]}
    rows = [(i, rng.choice([" ", "\n"]).join(rng.choice(own["x" if i % 2 else "y"]) for _ in range(60)), "", "") for i in range(400)]
    return rows + [(900, None, "", ""), (901, "", "", ""), (None, "x1 q", "", ""), (902, "x2 " * 9000, "", ""), *((910 + i, " ".join(f"r{j}" for j in range(900 * i, 4000)), "", "") for i in range(3))] + [(3, rows[3][1], "", "")]


@pytest.mark.parametrize("bound", [1 << 20, 600])
def test_scores(spark, bound):
    rows = corpus()
    words = lambda t: re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) + [None]
    out = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
    c = Counter(w for i, t, *_ in rows if not out(i) for w in words(t))
    n, v = sum(c.values()), len(c)
    want = sorted((i or -1, out(i), len(words(t)), sum(w in c for w in words(t)), n, round(sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words(t)), 6)) for i, t, *_ in rows)
    got = lm.score(spark.createDataFrame(rows, SCHEMA).repartition(3), F.expr(HELD), table_bytes=bound).collect()
    assert sorted((r.doc_id or -1, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert sum(r.score for r in got if r.held_out) > sum(r.base_score for r in got if r.held_out)


def test_nothing_to_learn(spark):
    assert lm.score(spark.createDataFrame([], SCHEMA), F.expr(HELD)).collect() == []
    one = lm.score(spark.createDataFrame([(1, "a b", "", "")], SCHEMA), F.lit(True)).first()
    assert (one.n_tokens, one.n_known, one.train_tokens, one.base_score) == (3, 0, 0, 0.0) and one.score < 0


def test_training_grows_and_no_text_takes_it_all(spark, monkeypatch):
    held = []
    monkeypatch.setattr(lm.Network, "train", lambda self, ids: held.append(np.asarray(ids)))
    for n in (4000, 16000):
        lm.score(spark.createDataFrame([(i, f"a{i} b c d e f g", "", "") for i in range(n)], SCHEMA), F.lit(False), train_rows=5, train_tokens=50)
    assert len(held[1]) > 3 * len(held[0]) > 300
    rows = [(i, f"w{i} x y z", "", "") for i in range(20)] + [(i, "long " * 50_000, "", "") for i in (900, 901)]
    lm.score(spark.createDataFrame(rows, SCHEMA), F.lit(False), train_tokens=2000)
    assert (held[2] == lm.END).sum() >= 20


def test_every_token_is_learned(spark, monkeypatch):
    monkeypatch.setattr(lm, "WORKER", 40_000)
    rng = random.Random(5)
    follower = {f"a{i}": f"b{(7 * i + 3) % 20}" for i in range(20)}
    rows = [(i, " ".join(w + " " + follower[w] for w in (f"a{rng.randrange(20)}" for _ in range(20))), "", "") for i in range(2000)]
    rows += [(5000, "long " * 20_000, "", ""), (5001, None, "", ""), (5001, None, "", "")]
    got = lm.score(spark.createDataFrame(rows, SCHEMA).repartition(3), F.expr(HELD), train_rows=20, train_tokens=800).collect()
    assert {r.learned_tokens for r in got} == {r.train_tokens for r in got} == {sum(r.n_tokens for r in got if not r.held_out)}
    out = [r for r in got if r.held_out and r.doc_id < 2000]
    assert sum(r.score for r in out) / sum(r.n_tokens for r in out) > -1  # base: -1.73; from the 20 rows alone: -1.727
