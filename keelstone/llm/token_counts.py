"""Greedy longest-match token counts in linear time, without building the tokens.

Each word, with the marker U+2581 before it, runs through the trie of the pieces. Where the trie has no next byte, the
state's failure link leads to the state in which the rest of the matched bytes stand after the longest pieces are cut
off; how many pieces that pops is stored with the link. Every step forward is taken once and every link shortens what is
held, so the time is linear in the word's bytes. All distinct words of a batch go through the automaton together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import pieces, ragged
from .sentence_pieces import MARK, Pieces
from .trie import DoubleArray

SCALAR_FROM = 256
KEPT_WORDS = 1_000_000
SCHEMA = "doc_id long, n_words long, n_tokens long, n_unknown long"


class Automaton:
    """fail[s]: the state after the link, -1 if there is none; pops[s]: the pieces that following it cuts off."""

    def __init__(self, keys: dict[bytes, int]):
        trie = DoubleArray(keys)
        self.base, self.check = trie.base.astype(np.int64), trie.check.astype(np.int64)
        fail, pops = [-1] * len(self.base), [0] * len(self.base)
        for state, parent, byte in trie.order[1:]:
            if trie.value[state] >= 0:
                fail[state], pops[state] = 0, 1
                continue
            at, n = fail[parent], pops[parent]
            while at >= 0 and (to := trie.child(at, byte)) < 0:
                at, n = fail[at], n + pops[at]
            if at >= 0:
                fail[state], pops[state] = to, n
        self.fail, self.pops = np.array(fail, np.int64), np.array(pops, np.int64)

    def count_one(self, word: bytes) -> int:
        """Pieces of the word, -1 if the greedy cut meets a byte it can't match."""
        state, n = 0, 0
        for b in word:
            while self.check[to := self.base[state] + b + 1] != state:
                if self.fail[state] < 0:
                    return -1
                state, n = self.fail[state], n + self.pops[state]
            state = to
        while state:
            if self.fail[state] < 0:
                return -1
            state, n = self.fail[state], n + self.pops[state]
        return int(n)

    def count(self, words: list[bytes]) -> np.ndarray:
        out = np.zeros(len(words), np.int64)
        sizes = np.array([len(w) for w in words], np.int64)
        for i in np.flatnonzero(sizes > SCALAR_FROM):
            out[i] = self.count_one(words[i])
        own = np.flatnonzero(sizes <= SCALAR_FROM)
        own = own[np.argsort(-sizes[own], kind="stable")]
        if not len(own):
            return out
        sizes = sizes[own]
        text = np.zeros((len(own), int(sizes[0]) + 1), np.int64)
        text[np.repeat(np.arange(len(own)), sizes), ragged(np.zeros(len(own), np.int64), sizes)] = np.frombuffer(b"".join(words[i] for i in own), np.uint8)
        state, n, lost = np.zeros(len(own), np.int64), np.zeros(len(own), np.int64), np.zeros(len(own), bool)
        for p in range(int(sizes[0])):
            rows = np.arange(np.searchsorted(-sizes, -p, "left"))
            rows = rows[~lost[rows]]
            while len(rows):
                to = self.base[state[rows]] + text[rows, p] + 1
                ok = self.check[to] == state[rows]
                state[rows[ok]] = to[ok]
                rows = rows[~ok]
                none = self.fail[state[rows]] < 0
                lost[rows[none]] = True
                rows = rows[~none]
                n[rows] += self.pops[state[rows]]
                state[rows] = self.fail[state[rows]]
        rows = np.flatnonzero(~lost & (state > 0))
        while len(rows):
            none = self.fail[state[rows]] < 0
            lost[rows[none]] = True
            rows = rows[~none]
            n[rows] += self.pops[state[rows]]
            state[rows] = self.fail[state[rows]]
            rows = rows[state[rows] > 0]
        out[own] = np.where(lost, -1, n)
        return out


def greedy(vocabulary: Pieces) -> Automaton:
    """The automaton of a vocabulary's ordinary pieces: those with the marker start a word, the others go on with it."""
    return Automaton({t: i for i, (t, k) in enumerate(zip(vocabulary.texts, vocabulary.kinds, strict=True)) if k == "n" and t})


_mine: list[tuple[Automaton, dict[bytes, int]]] = []  # the automaton is held, so another one is never taken for it


def count_tokens(docs: DataFrame, automaton: Automaton) -> DataFrame:
    """doc_id, n_words, n_tokens, n_unknown of every row.

    Words are runs [^\\x20\\x09-\\x0D]+ of the whole text. n_tokens: pieces of the greedy longest-match cut; a word that can't
    be cut into pieces is one unknown token. Null and empty texts have 0 of each. Rows may repeat, ids may be null;
    only doc_id and text are read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(automaton)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        if not _mine or _mine[0][0] is not own:
            _mine[:] = [(own, {})]
        known = _mine[0][1]
        for batch in batches:
            for part in pieces(batch, "text"):
                words: list[bytes] = []
                ends = [0]
                for t in part.column("text").cast(pa.binary()).to_pylist():
                    if t:
                        words += t.split()
                    ends.append(len(words))
                if len(known) > KEPT_WORDS:
                    known.clear()
                if new := list({w for w in words if w not in known}):
                    for a in range(0, len(new), 1 << 16):
                        few = new[a : a + (1 << 16)]
                        known.update(zip(few, own.count([MARK + w for w in few]).tolist(), strict=True))
                n = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
                sums = lambda x: np.diff(np.concatenate([[0], np.cumsum(x)])[ends])  # noqa: E731,B023
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(np.diff(ends), pa.int64()), pa.array(sums(np.abs(n)), pa.int64()), pa.array(sums(n < 0), pa.int64())], names=["doc_id", "n_words", "n_tokens", "n_unknown"])

    return docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text").mapInArrow(run, SCHEMA)
