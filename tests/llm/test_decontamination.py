import math
import random
import re
from collections import Counter

import pyarrow as pa

from keelstone.llm import decontamination as dc

DOCS, ITEMS = "doc_id long, text string, score string", "item_id long, text string, doc_id long"


def vocabulary(rng, n):
    return ["".join(rng.choice("abcdefghñéü") for _ in range(rng.randint(1, 5))) for _ in range(n)]


def test_wand_finds_all_above_the_threshold():
    rng = random.Random(1)
    words = vocabulary(rng, 60)
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(3, 30)))) for i in range(150)]
    index = dc.build(items)
    df = Counter(w for _, t in items for w in set(t.split()))
    average = sum(len(t.split()) for _, t in items) / len(items)

    def impacts(t):
        tf = Counter(t.split())
        s = {w: math.log1p((len(items) - df[w] + 0.5) / (df[w] + 0.5)) * f * 2.2 / (f + 1.2 * (0.25 + 0.75 * len(t.split()) / average)) for w, f in tf.items()}
        total = sum(s.values())
        return {w: x / total for w, x in s.items()}

    own = [impacts(t) for _, t in items]
    number = {w: int((index.terms == dc.words_of(pa.array([w]))[0][0]).argmax()) for w in df}
    for threshold in (0.2, 0.4, 0.7):
        for _ in range(60):
            query = {rng.choice(words) for _ in range(rng.randint(1, 40))} & set(df)
            want = {i: s for i, x in enumerate(own) if (s := sum(x.get(w, 0) for w in query)) >= threshold}
            got = dict(index.retrieve(dc.np.unique([number[w] for w in query]), threshold)) if query else {}
            assert got.keys() == want.keys() and all(abs(got[i] - want[i]) < 1e-9 for i in got)


def make(seed):
    rng = random.Random(seed)
    words = vocabulary(rng, 4000)
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [(i, f"{text(rng.randint(8, 30))}. {text(rng.randint(6, 12))}.") for i in range(40)]
    docs, want = [], set()
    for d in range(120):
        body = text(rng.choice([5, 80, 700]))
        if d % 3 == 0:
            i = rng.randrange(40)
            held = items[i][1].upper() if d % 2 else re.sub(r" ", "\n ", items[i][1])
            body = f"{body} {held} {text(30)}"
            want.add((d, i))
        elif d % 3 == 1:  # a question without its answer, and words in another order
            i = rng.randrange(40)
            mixed = items[i][1].split()
            rng.shuffle(mixed)
            body = f"{body} {items[i][1].split('.')[0]} {text(20)}" if d % 2 else " ".join(mixed)
        docs.append((d, body, "x"))
    return docs, items, want


def test_planted(spark):
    docs, items, want = make(3)
    extra = [(500, None, ""), (501, "", ""), (502, "?!", ""), (None, "word " * 20_000 + items[4][1], "")]
    frame = spark.createDataFrame(docs + extra + docs[:1], DOCS)
    bench = spark.createDataFrame([(*x, 1) for x in items] + [(77, None, 1), (78, "...", 1)], ITEMS)
    for bound in (1 << 20, 1500):
        got = dc.contaminated(frame, bench, bound=bound).collect()
        assert {(r.doc_id, r.item_id) for r in got} == want | {(None, 4)}
        assert len(got) == len(want) + 1 + (0 in {d for d, _ in want})
    kept = dc.clean(frame, bench)
    assert kept.columns == frame.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({d for d, *_ in docs} - {d for d, _ in want} | {500, 501, 502})


def test_short_questions_and_answers(spark):
    rng = random.Random(7)
    words = vocabulary(rng, 4000)
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    sizes = [*((q, a) for q in (1, 2, 3, 4, 5, 20) for a in (1, 2, 3, 4, 5, 20)), (12, 0)]
    items = [(i, f"{text(q)}? {text(a) or '__'}.") for i, (q, a) in enumerate(sizes)]
    docs, want = [], set()
    for i, (q, a) in enumerate(sizes):
        docs.append((i, f"{text(200)} {items[i][1]} {text(200)}", ""))
        want.add((i, i))
        own = items[i][1].split()
        if q >= 2 and a >= 2:  # the words are there, but not the question's and the answer's order
            docs.append((100 + i, f"{text(30)} {' '.join(reversed(own))} {text(30)}", ""))
        docs += [(300 + i, " ".join(own[:4]), ""), (400 + i, " ".join(own[1:4]), "")]  # shorter than a run of five
        docs.append((200 + i, f"{text(30)} {' '.join(own[:q])} {text(30)}" if a >= q else text(60), ""))
    frame, bench = spark.createDataFrame(docs, DOCS), spark.createDataFrame([(*x, 1) for x in items], ITEMS)
    got = {(r.doc_id, r.item_id) for r in dc.contaminated(frame, bench).collect()}
    assert want <= got and not {d for d, i in got - want if 100 <= d < 300 and min(sizes[i]) >= 2}
    assert not {r.doc_id for r in dc.clean(frame, bench).collect()} & {d for d, _ in want}


def test_odd_tables(spark):
    none, items = spark.createDataFrame([], DOCS), spark.createDataFrame([], ITEMS)
    one, item = spark.createDataFrame([(1, "a b c", "")], DOCS), spark.createDataFrame([(1, "a b c", 0)], ITEMS)
    assert dc.contaminated(none, item).collect() == dc.contaminated(one, items).collect() == dc.contaminated(none, items).collect() == []
    assert dc.clean(one, items).count() == 1 and dc.clean(one, item).count() == 0
    assert dc.question_and_answer("Why? Because.") == ("Why? ", "Because.") and dc.question_and_answer("one") == ("one", "one")
