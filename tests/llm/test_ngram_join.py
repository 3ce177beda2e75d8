import random
import re

import pytest

from keelstone.llm import ngram_join
from keelstone.llm.components import components

SCHEMA = "doc_id long, text string, n_shingles string, k1 string"


def brute(rows):
    sets = []
    for i, t, *_ in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append((i, {tuple(w[j : j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()))
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, (_, x) in enumerate(sets):
        for b, (_, y) in enumerate(sets[:a]):
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                root[find(a)] = find(b)
    least = {}
    for a, (i, _) in enumerate(sets):
        least[find(a)] = min(i, least.get(find(a), i))
    return sorted((i, len(s), least[find(a)]) for a, (i, s) in enumerate(sets))


def corpus(seed, n):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 4)))
    base = [[word() for _ in range(rng.choice([3, 12, 60, 200]))] for _ in range(n)]
    shared = [word() for _ in range(60)]
    out = []
    for b in base:
        out.append(b)
        for _ in range(rng.choice([0, 0, 1, 5, 30])):
            c = list(b)
            for _ in range(rng.randint(0, max(1, len(c) // 18))):
                c[rng.randrange(len(c))] = word()
            out.append(c)
        out.append(shared + [word() for _ in range(rng.randint(0, 40))])
    rng.shuffle(out)
    return [(i, rng.choice([" ", "\n", "  "]).join(w).title() if rng.random() < 0.3 else " ".join(w), "x", "y") for i, w in enumerate(out)]


@pytest.mark.parametrize("seed, frequent, marked, tile", [(1, 64, 1 << 24, 1 << 16), (2, 2, 0, 3), (3, 1000, 1 << 24, 3)])
def test_brute_force(spark, monkeypatch, seed, frequent, marked, tile):
    monkeypatch.setattr(ngram_join, "TILE", tile)
    dealt, tiled = [], ngram_join.tiled
    monkeypatch.setattr(ngram_join, "tiled", lambda *a: dealt.append(tiled(*a)) or dealt[-1])
    monkeypatch.setattr(ngram_join, "FREQUENT", frequent)
    monkeypatch.setattr(ngram_join, "MARKED", marked)  # 0: semi joins in place of marks
    rows = corpus(seed, 25)
    n = len(rows)
    rows += [(n + 1, None, "", ""), (n + 2, "", "", ""), (n + 3, " \n\t ", "", ""), (n + 4, "Ein Wort", "", ""), (n + 5, "ein wort", "", ""), (n + 6, "nine " * 4000, "", "")]
    rows += rows[:3]
    rows += [(rows[9][0], rows[20][1], "", ""), (rows[11][0], rows[20][1] + " more", "", ""), (rows[12][0], "of its own kind and like none", "", "")]  # ids with several texts
    got = ngram_join.groups(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    assert sorted(map(tuple, got)) == brute(rows)
    assert frequent < 1000 or max(dealt[0][1]) > 2  # lists in several tiles


def test_odd_tables(spark):
    assert ngram_join.groups(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = [(None, "a b c d e f", "", ""), (4, "a b c d e f", "", ""), (4, "q r s t u v", "", ""), (2, "q r s t u v", "", "")]
    got = ngram_join.groups(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.doc_id or -1, r.n_shingles, r.component_id or -1) for r in got) == [(-1, 2, -1), (2, 2, 2), (4, 2, 2), (4, 2, 4)]


def test_components(spark):
    rng = random.Random(7)
    links = [(i, i + 1) for i in range(60)] + [(rng.randrange(100, 400), rng.randrange(100, 400)) for _ in range(150)] + [(9, 9)]
    got = {r.id: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    near = {}
    for a, b in links:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    for i in got:
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        assert got[i] == min(seen)
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_one_of_each(spark):
    text = " ".join(f"w{i}" for i in range(60))
    near, other, third = text.replace("w7 ", "x "), " ".join(f"v{i}" for i in range(60)), " ".join(f"u{i}" for i in range(9))
    rows = [(4, text, "b", ""), (4, text, "a", ""), (4, other, "", ""), (2, other + " z", "", ""), (9, near, "", ""), (9, third, "", ""), (9, third, "", ""), (None, text, "", ""), (None, text, "", ""), (5, None, "", ""), (5, None, "", ""), (6, " ", "", "")]
    got = sorted(((r.doc_id or -1), r.text or "", r.n_shingles) for r in ngram_join.one_of_each(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == sorted([(4, text, "a"), (2, other + " z", ""), (9, third, ""), (-1, text, ""), (-1, text, ""), (5, "", ""), (5, "", ""), (6, " ", "")])
    assert ngram_join.one_of_each(spark.createDataFrame([], SCHEMA)).collect() == []


def jobs(spark, name, run):
    spark.sparkContext.setJobGroup(name, name)
    run()
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))


def test_the_driver_keeps_few_jobs_on_record(spark):
    values = spark.range(3000).selectExpr("id v")
    got = []
    assert jobs(spark, "marks", lambda: got.append(ngram_join.marks(values))) < 10  # not one for each partition
    assert ngram_join.is_marked(ngram_join.np.arange(3000), got[0]).all()
    sets = ngram_join.sketched(spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e f"), (3, "q r s")], "doc_id long, text string")).cache()
    assert jobs(spark, "summed", lambda: got.append(ngram_join.summed(sets))) < 10
    assert sorted(got[1][got[1] > 0]) == [1, 2, 2]
    stars = spark.createDataFrame([(i, i % 7) for i in range(7, 200)], "a long, b long")
    assert jobs(spark, "stars", lambda: got.append(sorted(map(tuple, components(stars).collect())))) < 12  # nothing to be done but to see that
    assert got[2] == sorted([(i, i % 7) for i in range(200)])
