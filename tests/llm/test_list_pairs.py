"""Pairs of lists against all pairs, for lists on both sides of the length from which they are read one by one."""

import numpy as np

from keelstone.llm.ngram_join import SHORT, list_pairs, overlaps, pairs_of


def found(own):
    return {p for b in pairs_of(own) for p in zip(*(c.to_pylist() for c in b.columns), strict=True)}


def whole(*lists):
    parts = list(list_pairs(*lists))
    return tuple(np.concatenate([p[s] for p in parts]) for s in (0, 1))


def test_pairs_of_whole_lists_are_all_pairs_that_can_meet():
    rng = np.random.default_rng(5)
    sizes = [1, 2, 2, 3, SHORT - 1, SHORT, SHORT + 1, 3 * SHORT, 1]
    token = np.repeat(np.arange(len(sizes)), sizes)
    x = rng.permutation(len(token))
    n = rng.integers(20, 30, len(token))
    own = np.stack([token, x, x + 1000, n, rng.integers(0, 6, len(token)), rng.integers(0, 5, len(token)), np.zeros(len(token), int), np.full(len(token), -1)])
    want = set()
    for i in range(len(token)):
        for j in range(len(token)):
            if token[i] == token[j] and x[i] < x[j] and own[4, i] != own[4, j] and overlaps(n[i], own[5, i], n[j], own[5, j]):
                want.add((x[i], x[i] + 1000, x[j], x[j] + 1000))
    assert found(own) == want and want
    assert found(own[:, :0]) == set()
    halves = [own.copy() for _ in range(3)]  # two tiles by themselves, and each with the other
    for tile, h in enumerate(halves):
        h[6], h[7] = tile, -1 if tile < 2 else x % 2
    parts = [h[:, x % 2 == t] if t < 2 else h for t, h in enumerate(halves)]
    assert found(parts[2]) == {p for p in want if (p[0] + p[2]) % 2}
    both = np.concatenate(parts, axis=1)
    assert found(both[:, np.lexsort((both[6], both[0]))]) == want


def test_blocks_of_long_lists_are_skipped_but_no_pair_is_lost():
    rng = np.random.default_rng(6)
    for groups in (2, 40, 700):
        n = rng.integers(5, 300, 1500)
        pos = rng.integers(0, 1 + n // 5)
        group = rng.integers(0, groups, 1500)
        i, j = whole(n, pos, group)
        a, b = np.triu_indices(1500, 1)
        fits = (group[a] != group[b]) & overlaps(n[a], pos[a], n[b], pos[b])
        assert set(zip(np.minimum(i, j), np.maximum(i, j), strict=True)) == set(zip(a[fits], b[fits], strict=True))
        assert len(i) == fits.sum() > 0


def test_a_shingle_of_many_sets_in_several_groups():
    """100,000 sets, nearly all of one group: only the blocks of other groups are read with them."""
    rng = np.random.default_rng(7)
    n = rng.integers(50, 60, 100_000)
    pos = rng.integers(0, 8, 100_000)
    group = np.zeros(100_000, np.int64)
    group[::20_000] = np.arange(1, 6)
    i, j = whole(n, pos, group)
    rest = np.flatnonzero(group > 0)
    want = sum(int((overlaps(n[r], pos[r], n, pos) & (group != group[r])).sum()) for r in rest)
    twice = sum(int((overlaps(n[r], pos[r], n[rest], pos[rest]) & (group[rest] != group[r])).sum()) for r in rest)
    assert len(i) == want - twice // 2 > 0
