"""Unigram encoding over a given piece vocabulary, and decoding.

A text is one space before it, every space written as the marker U+2581. Among all ways to cut it into pieces the one
with the highest sum of scores is taken (Viterbi over a double-array trie; at equal sums the longer last piece). A character
that no piece of one character matches costs the lowest piece score less 10 and is written as its bytes. When no piece
has a marker after another character, the best cut of a text is that of its runs marker... word put together, so each distinct
run is solved once for a batch of runs and remembered.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import pieces, ragged, released
from .trie import DoubleArray

MARK = "▁".encode()
UNKNOWN_PENALTY = 10.0
SCALAR_FROM = 192
KEPT_RUNS = 200_000
PIECE_BYTES = 1 << 20
LEARN_RUNS = 1 << 14
SCHEMA = "doc_id long, ids array<int>, n_tokens int, n_bytes int, score double, decoded string, ids_crc32 long, text_crc32 long, same boolean"
COLUMNS = ("doc_id", "ids", "n_tokens", "n_bytes", "score", "decoded", "same")


@dataclass
class Pieces:
    """A vocabulary: text of each id, score, kind ("n" ordinary, "b" byte, "c" control, "u" unknown)."""

    texts: list[bytes]
    scores: np.ndarray
    kinds: str
    trie: DoubleArray = field(init=False)

    def __post_init__(self):
        own = {t: i for i, (t, k) in enumerate(zip(self.texts, self.kinds, strict=True)) if k == "n" and t}
        self.trie = DoubleArray(own)
        self.unknown = float(min((self.scores[i] for i in own.values()), default=0.0)) - UNKNOWN_PENALTY
        self.byte_id = np.full(256, -1, np.int64)
        for i, (t, k) in enumerate(zip(self.texts, self.kinds, strict=True)):
            if k == "b":
                self.byte_id[int(t[3:5], 16)] = i
        if (self.byte_id < 0).any():
            raise ValueError("the vocabulary lacks byte pieces")
        out = [bytes([int(t[3:5], 16)]) if k == "b" else t if k == "n" else b" \xe2\x81\x87 " if k == "u" else b"" for t, k in zip(self.texts, self.kinds, strict=True)]
        self.out = np.frombuffer(b"".join(out), np.uint8)
        self.out_sizes = np.array([len(x) for x in out], np.int64)
        self.out_starts = np.cumsum(self.out_sizes) - self.out_sizes
        self.apart = not any(re.search(b"[^\x81]" + MARK + b"|[^\x96]\x81" + MARK + b"|[^\xe2]\x96\x81" + MARK, t) for t in own)


def load(path: str) -> Pieces:
    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_file=path)
    kind = lambda i: "u" if m.is_unknown(i) else "b" if m.is_byte(i) else "c" if m.is_control(i) or m.is_unused(i) else "n"
    n = range(m.get_piece_size())
    return Pieces([m.id_to_piece(i).encode() for i in n], np.array([m.get_score(i) for i in n], np.float64), "".join(map(kind, n)))


def solve_one(run: bytes, v: Pieces) -> tuple[list[int], float]:
    """The best cut of one run, step by step: time and memory are linear in its bytes."""
    base, check, value, scores = (memoryview(x) for x in (v.trie.base, v.trie.check, v.trie.value, v.scores))
    n = len(run)
    best, back, by = array("d", [float("-inf")]) * (n + 1), array("q", [0]) * (n + 1), array("q", [-1]) * (n + 1)
    best[0] = 0.0
    for p in range(n):
        if run[p] & 0xC0 == 0x80:
            continue
        width = 1 if run[p] < 0x80 else 2 if run[p] < 0xE0 else 3 if run[p] < 0xF0 else 4
        state, q, single = 0, p, False
        while q < n:
            to = base[state] + run[q] + 1
            if check[to] != state:
                break
            state, q = to, q + 1
            piece = value[to]
            if piece >= 0:
                single |= q - p == width
                if (s := best[p] + scores[piece]) > best[q]:
                    best[q], back[q], by[q] = s, p, piece
        if not single and (s := best[p] + v.unknown) > best[p + width]:
            best[p + width], back[p + width], by[p + width] = s, p, -1
    ids: list[int] = []
    q = n
    while q:
        p, piece = back[q], by[q]
        ids += [piece] if piece >= 0 else v.byte_id[list(run[p:q][::-1])].tolist()
        q = p
    return ids[::-1], best[n]


def solve(runs: list[bytes], v: Pieces) -> tuple[list[np.ndarray], np.ndarray]:
    """The best cuts of many runs, position by position for all of them."""
    out: list[np.ndarray] = [np.zeros(0, np.int32)] * len(runs)
    total = np.zeros(len(runs))
    sizes = np.array([len(r) for r in runs])
    for i in np.flatnonzero(sizes > SCALAR_FROM):
        ids, total[i] = solve_one(runs[i], v)
        out[i] = np.array(ids, np.int32)
    own = np.flatnonzero(sizes <= SCALAR_FROM)
    own = own[np.argsort(-sizes[own], kind="stable")]
    if not len(own):
        return out, total
    sizes = sizes[own]
    width = int(sizes[0]) + 1
    text = np.zeros((len(own), width + 4), np.uint8)
    flat = np.frombuffer(b"".join(runs[i] for i in own), np.uint8)
    text[np.repeat(np.arange(len(own)), sizes), ragged(np.zeros(len(own), np.int64), sizes)] = flat
    best = np.full((len(own), width + 4), -np.inf)
    best[:, 0] = 0
    came = np.zeros((len(own), width + 4), np.int16)
    piece_of = np.full((len(own), width + 4), -1, np.int32)
    base, check, value, scores = v.trie.base, v.trie.check, v.trie.value, v.scores
    for p in range(width - 1):
        alive = np.arange(np.searchsorted(-sizes, -p, "left"))  # those longer than p
        lead = text[alive, p]
        alive = alive[(lead & 0xC0) != 0x80]
        if not len(alive):
            continue
        lead = text[alive, p]
        char = 1 + (lead >= 0xC0) + (lead >= 0xE0) + (lead >= 0xF0).astype(np.int64)
        single = np.zeros(len(alive), bool)
        at, rows, state, q, from_p = np.arange(len(alive)), alive, np.zeros(len(alive), np.int64), p, best[alive, p]
        while len(rows):
            to = base[state] + text[rows, q].astype(np.int64) + 1
            ok = (check[to] == state) & (sizes[rows] > q)
            rows, state, at = rows[ok], to[ok], at[ok]
            q += 1
            found = value[state]
            hit = found >= 0
            if hit.any():
                r, f = rows[hit], found[hit]
                single[at[hit]] |= char[at[hit]] == q - p
                s = from_p[at[hit]] + scores[f]
                better = s > best[r, q]
                r = r[better]
                best[r, q], came[r, q], piece_of[r, q] = s[better], p, f[better]
        rows, to = alive[~single], (p + char)[~single]
        s = from_p[~single] + v.unknown
        better = s > best[rows, to]
        rows, to = rows[better], to[better]
        best[rows, to], came[rows, to], piece_of[rows, to] = s[better], p, -1
    total[own] = best[np.arange(len(own)), sizes]
    q, steps = sizes.copy(), []
    rows = np.flatnonzero(q > 0)
    while len(rows):
        p = came[rows, q[rows]].astype(np.int64)
        steps.append((rows, p, q[rows], piece_of[rows, q[rows]]))
        q[rows] = p
        rows = rows[p > 0]
    row, start, end, piece = (np.concatenate(x) for x in zip(*steps, strict=True))
    order = np.lexsort((start, row))
    row, start, end, piece = row[order], start[order], end[order], piece[order].astype(np.int64)
    wide = np.where(piece >= 0, 1, end - start)
    ids = np.repeat(piece, wide)
    raw = np.repeat(piece < 0, wide)
    if raw.any():
        ids[raw] = v.byte_id[text[np.repeat(row, wide)[raw], ragged(start, wide)[raw]]]
    cuts = np.searchsorted(np.repeat(row, wide), np.arange(1, len(own)))
    for i, x in zip(own, np.split(ids.astype(np.int32), cuts), strict=True):
        out[i] = x
    return out, total


class Encoder:
    """Encodes texts, remembering the cuts of up to KEPT_RUNS runs."""

    def __init__(self, v: Pieces):
        self.v = v
        self.forget()

    def forget(self):
        self.number: dict[bytes, int] = {}
        self.flat, self.used = np.zeros(1 << 16, np.int32), 0
        self.starts, self.sizes, self.totals = (np.zeros(1 << 12, t) for t in (np.int64, np.int64, np.float64))

    def learn(self, runs: list[bytes]):
        cuts, totals = solve(runs, self.v)
        n, sizes = len(self.number), np.array([len(c) for c in cuts], np.int64)
        m = n + len(runs)
        if m > len(self.starts):
            self.starts, self.sizes, self.totals = (np.concatenate([x, np.zeros(max(m, len(x)), x.dtype)]) for x in (self.starts, self.sizes, self.totals))
        end = self.used + int(sizes.sum())
        if end > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(max(end, len(self.flat)), np.int32)])
        self.flat[self.used : end] = np.concatenate(cuts)
        self.starts[n:m], self.sizes[n:m], self.totals[n:m] = self.used + np.cumsum(sizes) - sizes, sizes, totals
        self.used = end
        self.number.update(zip(runs, range(n, m), strict=True))

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All ids, the number of ids of each text, the score of each text."""
        if len(self.number) > KEPT_RUNS:
            self.forget()
        runs_of = re.compile(rb" +[^ ]*").findall
        runs: list[bytes] = []
        counts = np.zeros(len(texts), np.int64)
        for i, t in enumerate(texts):
            if t:
                own = runs_of(b" " + t.replace(MARK, b" ")) if self.v.apart else [b" " + t.replace(MARK, b" ")]
                runs += own
                counts[i] = len(own)
        number = self.number
        if new := list({r for r in runs if r not in number}):
            new.sort()
            marked = [r.replace(b" ", MARK) for r in new]
            for a in range(0, len(new), LEARN_RUNS):
                start = len(number)
                self.learn(marked[a : a + LEARN_RUNS])
                for i, (r, m) in enumerate(zip(new[a : a + LEARN_RUNS], marked[a : a + LEARN_RUNS], strict=True)):
                    del number[m]
                    number[r] = start + i
        at = np.fromiter(map(number.__getitem__, runs), np.int64, len(runs))
        sizes = self.sizes[at]
        ids = self.flat[ragged(self.starts[at], sizes)]
        ends = np.concatenate([[0], np.cumsum(counts)])
        sums = np.concatenate([[0], np.cumsum(sizes)])
        points = np.concatenate([[0.0], np.cumsum(self.totals[at])]) if len(texts) == 1 else None
        own = np.add.reduceat(np.append(self.totals[at], 0.0), np.minimum(ends[:-1], len(at))) if points is None else points[-1:]
        return ids, sums[ends[1:]] - sums[ends[:-1]], np.where(counts > 0, own, 0.0)


def decode(ids: np.ndarray, counts: np.ndarray, v: Pieces) -> list[bytes]:
    """Texts of the ids: markers as spaces, the first space gone, byte pieces as their bytes."""
    sizes = v.out_sizes[ids]
    data = v.out[ragged(v.out_starts[ids], sizes)].tobytes()
    at = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(counts)])].tolist()
    out = []
    for a, b in zip(at, at[1:], strict=False):
        t = data[a:b].replace(MARK, b" ")
        out.append(t[1:] if t[:1] == b" " else t)
    return out


def tokenize(docs: DataFrame, vocabulary: Pieces, columns: tuple[str, ...] = COLUMNS) -> DataFrame:
    """The columns of SCHEMA that are asked for, of every row: n_bytes counts ids of byte pieces, score is the sum of the pieces' scores, same tells
    whether decoded is the text, ids_crc32 is of the ids as little-endian int32, text_crc32 of the decoded text.

    Null and empty texts have no ids, score 0 and decode to "". A decoded text differs only where the text itself holds the marker
    U+2581, which decodes to a space. Very long texts cost time in proportion to their bytes, with or without spaces. Rows may repeat, ids may
    be null; only doc_id and text are read. An empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    kinds = dict(c.split(maxsplit=1) for c in SCHEMA.split(", "))
    schema = ", ".join(f"{c} {kinds[c]}" for c in columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Encoder(shared.value)
        v = own.v
        is_byte = np.array([k == "b" for k in v.kinds])
        for batch in batches:
            for part in pieces(batch, "text", PIECE_BYTES):
                texts = [t or b"" for t in part.column("text").cast(pa.binary()).to_pylist()]
                ids, counts, scores = own.encode(texts)
                back = decode(ids, counts, v)
                ends = np.concatenate([[0], np.cumsum(counts)])
                fallen = np.concatenate([[0], np.cumsum(is_byte[ids])])[ends]
                known = {"doc_id": part.column("doc_id"), "n_tokens": pa.array(counts, pa.int32()), "n_bytes": pa.array(np.diff(fallen), pa.int32()), "score": pa.array(scores)}
                known["same"] = pa.array([a == b for a, b in zip(texts, back, strict=True)])
                if "ids" in columns:
                    known["ids"] = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))
                if "decoded" in columns:
                    known["decoded"] = pa.array([b.decode("utf-8", "replace") for b in back])
                if "ids_crc32" in columns:
                    raw = ids.astype("<i4").tobytes()
                    known["ids_crc32"] = pa.array([zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(ends.tolist(), ends[1:].tolist(), strict=False)], pa.int64())
                if "text_crc32" in columns:
                    known["text_crc32"] = pa.array(map(zlib.crc32, back), pa.int64())
                yield pa.RecordBatch.from_arrays([known[c] for c in columns], names=list(columns))

    return docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text").mapInArrow(released(run), schema)
