"""Token ids in compressed, independently decodable blocks.

A block holds up to BLOCK ids. Each id is coded by an adaptive range coder with one chance, mixed of three predictions: the id that last
followed the two ids before it (order 2), the id that last followed the one before it (order 1), and the frequencies of the block so
far (order 0), in which there are also places for a new id and for one that has come up since the table was last made. The weights
of the three are learned: for each pair of hit runs of the two contexts they follow the outcomes so far. Tables and weights are made anew
whenever a block has grown by a quarter. Every block starts with fresh models. A block carries the CRC-32 of its ids; a reader checks it.

Executors cut texts into runs, number the runs, code and decode in Spark's JVM (IdFiles.java); Python has the tokenizers library encode the runs
that are new to a partition. `pack` and `unpack` are the same coder in numpy, blocks coded side by side, and give
the same bytes; sessions that have no JVM at hand (Spark Connect) run them.

Files are Parquet rows with binary payloads, so they can lie in any store that Spark writes to.
"""

from __future__ import annotations

import os
import re
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import jvm
from .common import flat, pieces, ragged, shared_dir

#: Ids in a block at most, values an id can have, slots of the order-0 table and its most entries, parts of the coder's interval, states of the mixer.
BLOCK, ID_BITS, SLOT_BITS, LISTED, TOTAL, STATES, END = 4096, 18, 12, 1500, 1 << 24, 32, 2
SLOTS, CONTEXTS = 1 << SLOT_BITS, 1 << 10
NEW, OLD, SPAN_BITS = 0, 1, 13
SPAN = (1 << SPAN_BITS) - 1
LOW, WORD = (1 << 31) - 1, 32
FILE_IDS, SORTED = 6_000_000, 1 << 20
KEPT_RUNS = 600_000
JOINED = 256
#: Characters of plain texts.
PLAIN = 0x250
SCHEMA = "part int, seq int, doc_ids array<long>, counts array<int>, before long, blocks array<binary>, sums array<long>"
CUT = "doc_id long, runs binary, fresh binary, sizes binary, anew boolean"


class Writer:
    """Range coders, one for each lane: low and range have 63 bits and give words of 32; carries are added to the words at the end."""

    def __init__(self, lanes: int, room: int):
        self.low, self.range = np.zeros(lanes, np.int64), np.full(lanes, (1 << 63) - 1, np.int64)
        self.room, self.n = room, np.arange(lanes) * room
        self.words = np.zeros(lanes * room, np.int64)

    def code(self, rows: slice | np.ndarray, r: np.ndarray, start: np.ndarray, size: np.ndarray | int):
        low, rng = self.low[rows] + start * r, size * r
        if (over := np.flatnonzero(low < 0)).size:
            self.words[self.n[rows][over] - 1] += 1
            low[over] &= (1 << 63) - 1
        if (small := np.flatnonzero(rng <= LOW)).size:
            at = np.arange(len(self.n))[rows][small]
            self.words[self.n[at]] = low[small] >> 31
            self.n[at] += 1
            low[small] = (low[small] & LOW) << WORD
            rng[small] <<= WORD
        self.low[rows], self.range[rows] = low, rng

    def finish(self) -> list[bytes]:
        for _ in range(2):
            self.words[self.n] = self.low >> 31
            self.low = (self.low & LOW) << WORD
            self.n += 1
        sizes = self.n - np.arange(len(self.n)) * self.room
        words = self.words.reshape(-1, self.room)[:, : int(sizes.max(initial=0))]
        over = np.zeros(len(words), np.int64)
        for i in range(words.shape[1] - 1, -1, -1):
            words[:, i] += over
            over = words[:, i] >> WORD
        raw = (words & ((1 << WORD) - 1)).astype("<u4")
        return [w[:n].tobytes() for w, n in zip(raw, sizes.tolist(), strict=True)]


class Reader:
    def __init__(self, blocks: list[bytes]):
        width = max(map(len, blocks)) // 4 + 3
        self.words = np.zeros((len(blocks), width), np.int64)
        for i, b in enumerate(blocks):
            own = np.frombuffer(b, "<u4")
            self.words[i, : len(own)] = own
        self.words, self.n = self.words.ravel(), np.arange(len(blocks)) * width
        self.last = self.n + width - 1
        self.value, self.range = self.words[self.n] << 31 | self.words[self.n + 1] >> 1, np.full(len(blocks), (1 << 63) - 1, np.int64)
        self.rest = self.words[self.n + 1] & 1  # words come 32 bits at a time, the first value has 63
        self.n += 2

    def code(self, rows: slice | np.ndarray, r: np.ndarray, start: np.ndarray, size: np.ndarray | int):
        value, rng = self.value[rows] - start * r, size * r
        if (small := np.flatnonzero(rng <= LOW)).size:
            at = np.arange(len(self.n))[rows][small]
            word = self.words[np.minimum(self.n[at], self.last[at])]
            value[small] = value[small] << WORD | self.rest[at] << 31 | word >> 1
            self.rest[at] = word & 1
            self.n[at] += 1
            rng[small] <<= WORD
        self.value[rows], self.range[rows] = value, rng


class Models:
    """What `lanes` blocks coded side by side have learned: followers of contexts, an order-0 table, weights of the three orders.

    Ids go by the order in which they first occur in their block. spans[lane, symbol]: place and size of NEW, OLD and every listed id among SLOTS;
    slots: the symbol at each place. Counts and outcomes of a run of steps come in with `refresh`.
    """

    def __init__(self, lanes: int, reading: bool):
        self.lanes, self.reading = lanes, reading
        self.after = [np.zeros(lanes * n, np.uint16) for n in (CONTEXTS, BLOCK)]
        self.spans = np.zeros((lanes, BLOCK + 2), np.int32)
        self.slots = np.zeros(lanes * SLOTS if reading else 0, np.uint16)
        self.counts = np.zeros((lanes, BLOCK), np.int32)
        self.kinds, self.listed, self.olds, self.kinds_before = (np.zeros(lanes, np.int64) for _ in range(4))
        state = np.arange(STATES)
        one = np.stack([3 * (1 + (state >> 2 & 3)), np.where(state < 16, 3 * (1 + (state & 3)), 0), np.full(STATES, 10)], 1)  # tenths
        self.outcomes = np.tile(one, (lanes, 1))
        self.weights = np.zeros(lanes * STATES, np.int64)  # of order 2 and, 24 bits lower, of order 1; order 0 has the rest

    def refresh(self, seen: np.ndarray, outcomes: np.ndarray):
        """Learns from the ids and outcomes [step, lane] since the last time."""
        steps, lanes = len(seen), self.lanes
        if steps:
            width, lane = int(self.kinds.max()), np.arange(lanes)
            self.counts[:, :width] += np.bincount((seen + lane * width).ravel(), minlength=lanes * width).reshape(lanes, width)
            self.outcomes += 10 * np.bincount((outcomes + lane * (3 * STATES)).ravel(), minlength=lanes * 3 * STATES).reshape(-1, 3)
            w2, w1 = (self.outcomes[:, i] * (TOTAL - (1 << 17)) // self.outcomes.sum(1) for i in range(2))
            self.weights = w2 << 24 | w1
        self.listed = np.minimum(self.kinds, LISTED)
        new = np.clip(SLOTS * (self.kinds - self.kinds_before) // max(steps, 1), 1, SLOTS // 4) if steps else np.full(lanes, SLOTS - 1)
        old = np.clip(SLOTS * self.olds // max(steps, 1), 1, SLOTS // 8)
        self.kinds_before, self.olds = self.kinds.copy(), np.zeros(lanes, np.int64)
        width = int(self.listed.max())
        sizes = np.zeros((lanes, width + 2), np.int64)
        sizes[:, 0], sizes[:, 1] = new, old
        if width:
            own = self.counts[:, :width]
            sums = np.cumsum(own, 1, dtype=np.int64)
            places = sums * (SLOTS - new - old - self.listed)[:, None] // sums[:, -1:]
            sizes[:, 2:] = (own > 0) * 1
            sizes[:, 2] += places[:, 0]
            sizes[:, 3:] += np.diff(places, axis=1)
        self.spans[:, : width + 2] = np.where(sizes > 0, (np.cumsum(sizes, 1) - sizes) << SPAN_BITS | sizes, 0)
        if self.reading:
            self.slots = np.repeat(np.tile(np.arange(width + 2, dtype=np.uint16), lanes), sizes.ravel())


def code(coder: Writer | Reader, sizes: np.ndarray, known: np.ndarray | None = None, names: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Codes the ids known [step, lane] with their names [lane, id], or reads both: the same models step by step. sizes: descending, one apart at most."""
    reading = known is None
    lanes, steps = len(sizes), int(sizes[0])
    ids = np.zeros((steps, lanes), np.uint16) if reading else known
    names = np.zeros(lanes * BLOCK, np.int64) if reading else names.ravel()
    m = Models(lanes, reading)
    outcomes = np.zeros((steps, lanes), np.uint8)
    lane = np.arange(lanes)
    at_block, at_span, at_slot, at_state, at_two = lane * BLOCK, lane * (BLOCK + 2), lane * SLOTS, lane * STATES, lane * CONTEXTS
    spans = m.spans.reshape(-1)
    before, last = np.zeros(lanes, np.int64), np.zeros(lanes, np.int64)
    mark, done, rows = 0, 0, slice(0, lanes)
    for t in range(steps):
        if t == mark:
            m.refresh(ids[done:t], outcomes[done:t])
            done, mark = t, t + max(1 if t == 0 else 8, t >> 2)
            after2, after1 = m.after
        if t == sizes[-1] and t:  # the last id of some lanes
            rows = slice(0, int((sizes > t).sum()))
            at_block, at_span, at_slot, at_state, at_two, before, last = (x[rows] for x in (at_block, at_span, at_slot, at_state, at_two, before, last))
        place2, place1 = ((before * 40_503 + last * 2_731 >> 3) & (CONTEXTS - 1)) + at_two, last + at_block
        then2, then1 = after2[place2], after1[place1]
        guess2, guess1 = then2 >> 2, then1 >> 2
        sure2, sure1 = then2 & 3, then1 & 3
        same = guess2 == guess1
        state = (sure2 << 2) + sure1 + (same.view(np.uint8) << 4)
        weights = m.weights[at_state + state]
        w2, w1 = weights >> 24, weights & (TOTAL - 1)
        unit = (TOTAL - w2 - w1) >> SLOT_BITS
        span2, span1 = spans[at_span + guess2 + 2], spans[at_span + guess1 + 2]
        own2, own1 = span2 & SPAN, (span1 & SPAN) * ~same
        end2 = w2 + unit * own2
        end1 = end2 + w1 + unit * own1
        swap = span1 < span2
        low_at, high_at = np.minimum(span1, span2) >> SPAN_BITS, np.maximum(span1, span2) >> SPAN_BITS
        low_own = own2 + swap * (own1 - own2)
        high_own = own1 + own2 - low_own
        r = coder.range[rows] >> 24
        if reading:
            spot = coder.value[rows] // r
            hit2, hit1 = spot < end2, spot < end1
            slot = np.maximum(spot - end1, 0) // unit
            slot += (slot >= low_at) * low_own
            slot += (slot >= high_at) * high_own
            symbol = m.slots[at_slot + np.minimum(slot, SLOTS - 1)]
        else:
            now = ids[t, rows].astype(np.int64)
            hit2, hit1 = (now == guess2) & (w2 > 0), ((now == guess1) | (now == guess2)) & (w2 > 0)
            symbol = np.where(now < m.listed[rows], now + 2, now != m.kinds[rows])  # else NEW or OLD
        span = spans[at_span + symbol]
        start, size = span >> SPAN_BITS, unit * (span & SPAN)
        start = end1 + unit * (start - (start > low_at) * low_own - (start > high_at) * high_own)
        np.copyto(start, end2, where=hit1)
        np.copyto(size, end1 - end2, where=hit1)
        np.copyto(start, 0, where=hit2)
        np.copyto(size, end2, where=hit2)
        coder.code(rows, r, start, size)
        if reading:
            now = symbol.astype(np.int64) - 2
            np.copyto(now, guess1, where=hit1)
            np.copyto(now, guess2, where=hit2)
        if (e := np.flatnonzero((symbol < 2) & ~hit1)).size:
            fresh = symbol[e] == NEW
            many = np.where(fresh, 1 << ID_BITS, np.maximum(m.kinds[e] - m.listed[e], 1))
            r = coder.range[e] // many
            if reading:
                first = np.minimum(coder.value[e] // r, many - 1)
                now[e] = np.where(fresh, m.kinds[e], m.listed[e] + first)
                names[at_block[e[fresh]] + m.kinds[e[fresh]]] = first[fresh]
            else:
                first = np.where(fresh, names[at_block[e] + now[e]], now[e] - m.listed[e])
            coder.code(e, r, first, 1)
            m.kinds[e[fresh]] += 1
            m.olds[e[~fresh]] += 1
        both = now << 2
        right2, right1 = now == guess2, now == guess1
        after2[place2] = both + right2 * np.minimum(sure2 + 1, 3)
        after1[place1] = both + right1 * np.minimum(sure1 + 1, 3)
        outcomes[t, rows] = state * 3 + np.where(right2, 0, 2 - right1)
        before, last = last, now
        if reading:
            ids[t, rows] = now
    return ids, names.reshape(lanes, BLOCK)


def block_sizes(total: int, blocks: int) -> np.ndarray:
    """Ids in each block: the first ones have one more where they differ."""
    return total // blocks + (np.arange(blocks) < total % blocks)


def by_first(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """ids [lane, step] as numbers in the order of first occurrence, [step, lane], and the id of each number, [lane, number]."""
    lanes, steps = ids.shape
    numbers, names = np.zeros((steps, lanes), np.uint16), np.zeros((lanes, BLOCK), np.int32)
    some = max(1, SORTED // steps)
    for a in range(0, lanes, some):
        own = ids[a : a + some]
        order = np.argsort(own.astype(np.uint16 if own.max(initial=0) < 1 << 16 else np.int32), axis=1, kind="stable")
        row = np.arange(len(own))[:, None] * steps
        order += row
        inorder = own.ravel()[order]
        first = np.ones(own.shape, bool)
        first[:, 1:] = inorder[:, 1:] != inorder[:, :-1]
        fresh = np.zeros(own.size, bool)
        fresh[order[first]] = True  # where each id occurs first
        number = np.cumsum(fresh.reshape(own.shape), 1, dtype=np.int16).ravel() - np.int16(1)
        out = np.zeros(own.size, np.uint16)
        out[order.ravel()] = number[order[first]][np.cumsum(first.ravel()) - 1]
        numbers[:, a : a + some] = out.reshape(own.shape).T
        at = np.flatnonzero(fresh)
        names[a + at // steps, number[at]] = own.ravel()[at]
    return numbers, names


def pack(ids: np.ndarray) -> tuple[list[bytes], list[int]]:
    """Blocks of the ids (below 2 ** ID_BITS) and their CRC-32."""
    if not len(ids):
        return [], []
    if ids.max() >> ID_BITS:
        raise ValueError(f"an id of {ids.max()} has more than {ID_BITS} bits")
    sizes = block_sizes(len(ids), -(-len(ids) // BLOCK))
    ends = np.cumsum(sizes)
    square = np.zeros((len(sizes), int(sizes[0])), np.int32)
    for i, (a, b) in enumerate(zip((ends - sizes).tolist(), ends.tolist(), strict=True)):
        square[i, : b - a] = ids[a:b]
    writer = Writer(len(sizes), int(sizes[0]) * 2 + 4)
    code(writer, sizes, *by_first(square))
    raw = ids.astype("<u4")
    return writer.finish(), [zlib.crc32(raw[a:b]) for a, b in zip((ends - sizes).tolist(), ends.tolist(), strict=True)]


def unpack(blocks: list[bytes], total: int, sums: list[int]) -> np.ndarray:
    """The ids of the blocks; ValueError where a checksum doesn't fit."""
    if not blocks:
        return np.zeros(0, np.int64)
    sizes = block_sizes(total, len(blocks))
    try:
        ids, names = code(Reader(blocks), sizes)
    except IndexError as e:
        raise ValueError("a block is damaged") from e
    square = np.take_along_axis(names, np.ascontiguousarray(ids.T).astype(np.int64), 1)
    out = square[np.arange(square.shape[1]) < sizes[:, None]]
    raw, ends = out.astype("<u4"), np.cumsum(sizes)
    for i, (s, a, b) in enumerate(zip(sums, (ends - sizes).tolist(), ends.tolist(), strict=True)):
        if zlib.crc32(raw[a:b]) != s:
            raise ValueError(f"block {i} is damaged")
    return out


class Numbers(dict):
    """Numbers of runs in the order in which they are first asked for; fresh: those since it was last emptied."""

    def __init__(self):
        self.fresh: list[str] = []

    def __missing__(self, run: str) -> int:
        self.fresh.append(run)
        self[run] = n = len(self)
        return n


class Tokens:
    """Ids of texts by the tokenizers library, run by run: texts are cut where the byte-level pre-tokenizer always starts a token, so runs are
    encoded once and remembered. Up to U+024F that is before and after each run of letters and digits, one space before it included, but for
    apostrophes, and before the last of several white characters that such a run follows; other texts, and those with added tokens, are cut before a space and a letter, digit or _."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.cut = Tokenizer.from_file(path), re.compile(r"(?= \w)")
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.plain = re.compile("|".join([f"[^\x00-{chr(PLAIN - 1)}]", *map(re.escape, self.added)]))
        word = "[^\\W_]+"
        white = "[\t-\r \x85\xa0]"
        self.runs = re.compile(f" ?{word}|[\\W_]*'{word}|[\\W_]+(?= {word})|[\\W_]*{white}(?={white}{word})|[\\W_]+").findall
        self.words = re.compile(f" {word}").fullmatch
        self.space = np.zeros(self.tokenizer.get_vocab_size(with_added_tokens=True), bool)
        for t, i in self.tokenizer.get_vocab(with_added_tokens=False).items():
            self.space[i] = t.startswith("\u0120")
        self.forget()

    def letters(self) -> bytes:
        """What IdFiles.java has to know of each character below 2 ** 16: 1 for letters and digits of plain texts, 2 for others of words, _ apart."""
        return bytes((1 + (i >= PLAIN)) * (re.fullmatch("[^\\W_]", chr(i)) is not None) for i in range(1 << 16))

    def forget(self):
        self.number = Numbers()
        self.flat, self.used = np.zeros(1 << 16, np.int32), 0
        self.starts, self.sizes = np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int64)

    def library(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, and how many each has."""
        got = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return np.fromiter(chain.from_iterable(got), np.int32), np.fromiter(map(len, got), np.int64, len(got))

    def learned(self, data: np.ndarray, sizes: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the runs of so many bytes each, and how many each has. word: which are a space and letters; they go to the library JOINED at a
        time: each starts at the next piece that has the space."""
        joined, ends = data[np.repeat(word, sizes)].tobytes(), np.cumsum(sizes[word])
        cuts = [0, *ends[JOINED - 1 : -1 : JOINED].tolist(), len(joined)]
        ids, _ = self.library([joined[a:b].decode() for a, b in zip(cuts, cuts[1:], strict=False)])
        first = np.flatnonzero(self.space[ids])
        if len(first) != len(ends):
            first, word, ids = first[:0], np.zeros(len(sizes), bool), ids[:0]
        raw, ends = data.tobytes(), np.cumsum(sizes)
        more, counts = self.library([raw[b - n : b].decode() for b, n in zip(ends[~word].tolist(), sizes[~word].tolist(), strict=True)])
        out, many = np.zeros(len(ids) + len(more), np.int32), np.zeros(len(sizes), np.int64)
        many[word], many[~word] = np.diff(np.append(first, len(ids))), counts
        of = np.repeat(word, many)
        out[of], out[~of] = ids, more
        return out, many

    def learn(self, runs: list[str]):
        """Of the last runs that got numbers."""
        raw = [r.encode() for r in runs]
        word = np.fromiter((self.words(r) is not None for r in runs), bool, len(runs))
        ids, sizes = self.learned(np.frombuffer(b"".join(raw), np.uint8), np.fromiter(map(len, raw), np.int64, len(raw)), word)
        m, end = len(self.number), self.used + len(ids)
        if m > len(self.starts):
            self.starts, self.sizes = (np.concatenate([x, np.zeros(max(m, len(x)), x.dtype)]) for x in (self.starts, self.sizes))
        if end > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(max(end, len(self.flat)), np.int32)])
        self.flat[self.used : end] = ids
        self.starts[m - len(runs) : m], self.sizes[m - len(runs) : m] = self.used + np.cumsum(sizes) - sizes, sizes
        self.used = end

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, END after each text, and how many each text has."""
        if len(self.number) > KEPT_RUNS:
            self.forget()
        runs: list[str] = []
        ends = []
        for t in texts:
            if t:
                runs += self.cut.split(t) if self.plain.search(t) else self.runs(t)
            ends.append(len(runs))
        at = np.fromiter(map(self.number.__getitem__, runs), np.int64, len(runs))
        if new := self.number.fresh:
            self.number.fresh = []
            self.learn(new)
        starts, sizes = self.starts[at], self.sizes[at]
        own = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], ends]).astype(np.int64)]
        counts = np.diff(own) + 1
        out = np.full(int(counts.sum()), END)
        body = np.ones(len(out), bool)
        body[np.cumsum(counts) - 1] = False
        out[body] = self.flat[ragged(starts, sizes)]
        return out, counts


_mine: dict[str, Tokens] = {}


def _tokens(path: str) -> Tokens:
    if path not in _mine:
        _mine[path] = Tokens(path)
    return _mine[path]


def _learned(own: Tokens, batch: pa.RecordBatch) -> pa.RecordBatch:
    """Rows of CUT, with ids in place of texts and numbers of ids in place of sizes of runs."""
    data, _, _ = flat(batch.column("fresh"))
    raw, sizes_at, _ = flat(batch.column("sizes"))
    sizes = raw.view("<i4")
    ids, many = own.learned(data, np.abs(sizes), sizes > 0)

    def binary(ends: np.ndarray, values: np.ndarray) -> pa.Array:
        return pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(values.astype("<i4"))])

    fresh, sizes = binary(4 * np.concatenate([[0], np.cumsum(many)])[sizes_at // 4], ids), binary(sizes_at, many)
    return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("runs"), fresh, sizes, batch.column("anew")], names=batch.schema.names)


def write(docs: DataFrame, tokenizer: str, path: str, parts: int | None = None, codec: bool = True) -> None:
    """Writes the ids of all texts, in ascending doc_id order, to path: part p holds a range of ids, seq numbers its rows.

    Null texts are empty (one id, the end). Rows without an id come first; rows that repeat an id stand by the hash of their text. No rows: no files but an empty table.
    """
    parts = parts or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _tokens(tokenizer)
        part, seq, before = TaskContext.get().partitionId(), 0, 0
        held: list[tuple] = []
        size = 0

        def file() -> pa.RecordBatch:
            ids, counts = np.concatenate([h[1] for h in held]), np.concatenate([h[2] for h in held])
            blocks, sums = pack(ids)
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([[i for h in held for i in h[0]]], pa.list_(pa.int64())), pa.array([counts.tolist()], pa.list_(pa.int32())), pa.array([before], pa.int64()), pa.array([blocks], pa.list_(pa.binary())), pa.array([sums], pa.list_(pa.int64()))], names=[c.split()[0] for c in SCHEMA.split(", ")])

        for batch in batches:
            for piece in pieces(batch, "text"):
                ids, counts = own.encode([t or "" for t in piece.column("text").to_pylist()])
                held.append((piece.column("doc_id").to_pylist(), ids, counts))
                size += len(ids)
                if size >= FILE_IDS:
                    yield file()
                    held, seq, before, size = [], seq + 1, before + size, 0
        if held:
            yield file()

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "fresh"):
                yield _learned(_tokens(tokenizer), piece)

    spark = docs.sparkSession
    inorder = docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text").withColumn("tie", F.xxhash64("text")).repartitionByRange(parts, "doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text").drop("tie")
    if jvm.reachable(spark):
        own = _tokens(tokenizer)
        cut = jvm.new(spark, "IdFiles", "Cut").by(own.letters(), [t.encode() for t in own.added], KEPT_RUNS)
        cuts = jvm.map_partitions(inorder.withColumn("text", F.col("text").cast("binary")), cut, CUT)
        rows = jvm.map_partitions(cuts.mapInArrow(learn, CUT), jvm.new(spark, "IdFiles", "Pack").by(FILE_IDS, END), SCHEMA)
    else:
        rows = inorder.mapInArrow(run, SCHEMA)
    rows.write.parquet(path)


def read(spark, path: str) -> DataFrame:
    """doc_id, start (ids of all texts before), n_tokens, ids of every text in the files at path."""
    return _read(spark, path, False)


def _read(spark, path: str, digest: bool) -> DataFrame:
    files = spark.read.parquet(path)
    sizes = files.select("part", F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x).alias("n")).groupBy("part").agg(F.sum("n").alias("n")).collect()
    offsets, total = {}, 0
    for r in sorted(sizes):
        offsets[r["part"]] = total
        total += r["n"]
    kinds = "doc_id long, start long, n_tokens long, " + ("ids_crc32 long" if digest else "ids array<int>")
    if jvm.reachable(spark):
        return jvm.map_partitions(files.select("part", "before", "doc_ids", "counts", "blocks", "sums"), jvm.new(spark, "IdFiles", "Unpack").by(offsets, digest), kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                counts = np.array(row["counts"], np.int64)
                ids = unpack(row["blocks"], int(counts.sum()), row["sums"])
                ends = np.concatenate([[0], np.cumsum(counts)])
                first = [pa.array(row["doc_ids"], pa.int64()), pa.array(offsets[row["part"]] + row["before"] + ends[:-1]), pa.array(counts)]
                if digest:
                    raw = ids.astype("<u4").tobytes()
                    last = pa.array([zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(ends.tolist(), ends[1:].tolist(), strict=False)], pa.int64())
                else:
                    last = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([*first, last], names=["doc_id", "start", "n_tokens", "ids_crc32" if digest else "ids"])

    return files.mapInArrow(run, kinds)


def stored(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every row, from files written to the shared folder and read back.

    A null or empty text is one id, the end. Rows without an id stand first; rows may repeat, each stands for itself. Texts may be of any
    length: a row of the files then holds more than FILE_IDS ids. An empty table gives no rows. Other columns are not read.
    """
    path = f"{shared_dir(docs.sparkSession)}/ids-{uuid.uuid4().hex}"
    write(docs, tokenizer, path)
    return _read(docs.sparkSession, path, True)
