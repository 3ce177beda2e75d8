"""A double-array trie over bytes, walked for many strings at once."""

from __future__ import annotations

from collections import deque

import numpy as np

MOST_NODES = 8_000_000


class DoubleArray:
    """base, check: the child of state s for byte b is t = base[s] + b + 1, if check[t] == s. value[t]: the key's number or -1."""

    def __init__(self, keys: dict[bytes, int]):
        children: list[dict[int, int]] = [{}]
        number = [-1]
        for key, n in keys.items():
            at = 0
            for b in key:
                to = children[at].get(b)
                if to is None:
                    to = children[at][b] = len(children)
                    children.append({})
                    number.append(-1)
                at = to
            number[at] = n
        if len(children) > MOST_NODES:
            raise ValueError(f"a vocabulary of {len(children)} trie nodes passes {MOST_NODES}")
        size = 2 * len(children) + 1024
        base, check, value, used = [0] * size, [-1] * size, [-1] * size, bytearray(size)
        used[0] = 1
        hint, todo = 2, deque([(0, 0)])
        self.order = [(0, -1, 0)]  # state, parent, byte: parents first
        while todo:
            node, state = todo.popleft()
            if not children[node]:
                base[state] = 0
                continue
            codes = sorted(children[node])
            several = len(codes) > 1
            spot, tries = max(hint if several else 2, codes[0] + 2), 0
            while True:
                spot = used.find(0, spot)
                if spot < 0 or spot + 258 >= len(used):
                    spot = len(used) - 258 if spot < 0 else spot
                    grow = len(used)
                    base += [0] * grow
                    check += [-1] * grow
                    value += [-1] * grow
                    used += bytearray(grow)
                    continue
                start = spot - codes[0] - 1
                if not any(used[start + c + 1] for c in codes):
                    break
                spot, tries = spot + 1, tries + 1
            if several and tries > 24:  # the slots before it are nearly full
                hint = spot
            base[state] = start
            for c in codes:
                to = start + c + 1
                used[to], check[to], value[to] = 1, state, number[children[node][c]]
                todo.append((children[node][c], to))
                self.order.append((to, state, c))
        last = len(used) - 1
        while not used[last]:
            last -= 1
        last += 258  # every base + byte stays inside
        pad = lambda x, fill: np.array((x + [fill] * 600)[: last + 1], np.int32)
        self.base, self.check, self.value = pad(base, 0), pad(check, -1), pad(value, -1)
        self.value[0] = -1

    def child(self, state: int, byte: int) -> int:
        to = self.base[state] + byte + 1
        return int(to) if self.check[to] == state else -1
