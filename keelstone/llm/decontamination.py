"""Benchmark decontamination: BM25 retrieval of test items for every passage of every text, then a check of their overlap.

The index holds the test items. Impacts are divided by what an item scores for its own words, so a score is between 0 and 1, one
threshold fits all items, and a retrieval with a fixed threshold finds everything at or above it. Passages are two strides of
`stride` words, a stride being as long as the longest item: whatever an item's words are copied from lies whole in one passage.

Per passage block-max WAND: no item can reach the threshold where the terms' maxima together don't, and none of a block of items where the
maxima within the block don't. Both are worked out for all passages of a batch at once, from the postings of their terms alone: the
terms with the longest lists, whose maxima together are below SLACK, are not opened, as they alone bring no item up and count in full in every
bound. In the blocks left cursors over the posting lists skip by pivots and by the maxima of posting blocks. Retrieved items
count only if enough of the question's word n-grams and of the answer's are in the passage. Letters are compared in lower case by Unicode's rules.
A question or answer of fewer words than GRAM is one n-gram of all its words, looked for among the passage's runs of as many words.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, distinct, flat, mixed, pieces, ragged, released, word_hashes, word_spans

K1, B = 1.2, 0.75
THRESHOLD, OVERLAP, GRAM = 0.6, 0.5, 5
POSTING_BLOCK, ITEM_BLOCK, CELLS, SLACK = 32, 2, 4_000_000, 0.1
INDEX_BYTES = 32 << 20
PIECE_BYTES = 1 << 20
SCHEMA = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double, word long"
BETWEEN = np.array([not (chr(b).isalnum() or b >= 128) for b in range(256)])


def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words (letters, digits and bytes beyond ASCII; in lower case), and at each text the number of words before it."""
    data, at, _ = flat(texts)
    if (data >= 128).any():
        data, at, _ = flat(pc.utf8_lower(texts))
    starts, ends, before = word_spans(data, at, BETWEEN)
    return word_hashes(data, starts, ends), before


def grams(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the runs of n words; none where there are fewer."""
    out = np.zeros(len(h) - n + 1 if 0 < n <= len(h) else 0, U64)
    for j in range(n if len(out) else 0):
        out = mixed(out * U64(0x9E3779B97F4A7C15) + h[j : len(h) - n + 1 + j])
    return out


def gram_size(h: np.ndarray) -> int:
    """Words in the runs by which these words are compared: GRAM, or all of a part that is shorter."""
    return min(GRAM, len(h))


def question_and_answer(text: str) -> tuple[str, str]:
    """The last sentence is the answer, what stands before it the question; a single sentence is both."""
    cut = [m.end() for m in re.finditer(r"[.!?:]\s+|\n+", text.strip())]
    own = text.strip()
    return (own[: cut[-1]], own[cut[-1] :]) if cut and re.search(r"\w", own[: cut[-1]]) and re.search(r"\w", own[cut[-1] :]) else (own, own)


@dataclass
class Index:
    """Postings over item numbers: terms (sorted hashes), for each its items, impacts, greatest impact and block maxima.

    Of each item's question and answer: the words in a run, and the hashes of its runs.
    """

    ids: list
    terms: np.ndarray
    items: list
    impacts: list
    largest: np.ndarray
    block_largest: list
    stride: int
    question: list[tuple[int, np.ndarray]]
    answer: list[tuple[int, np.ndarray]]

    def __post_init__(self):
        """Maxima of each term within blocks of items."""
        self.blocks = -(-len(self.ids) // ITEM_BLOCK)
        number = np.repeat(np.arange(len(self.terms)), [len(x) for x in self.items])
        cell = number * self.blocks + np.concatenate(self.items) // ITEM_BLOCK
        first = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
        self.cell_largest = np.maximum.reduceat(np.concatenate(self.impacts), first)
        self.cell_block = cell[first] % self.blocks
        self.cell_start = np.searchsorted(cell[first] // self.blocks, np.arange(len(self.terms) + 1))
        self.longest = np.argsort(-np.diff(self.cell_start), kind="stable")
        self.by_length = np.argsort(self.longest)
        self.items, self.impacts, self.block_largest = ([x.tolist() for x in y] for y in (self.items, self.impacts, self.block_largest))

    def candidates(self, passage: np.ndarray, term: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
        """Passages and blocks in which an item can reach the threshold, given the terms of each passage (twice if they are in both halves)."""
        key = distinct(passage * len(self.terms) + self.by_length[term])
        passage, term = key // len(self.terms), self.longest[key % len(self.terms)]
        first = np.concatenate([[True], passage[1:] != passage[:-1]])
        sums = np.cumsum(self.largest[term])
        here = np.cumsum(first) - 1
        sums -= (sums - self.largest[term])[first][here]
        closed = sums <= min(SLACK, threshold / 2)
        slack = np.zeros(here[-1] + 1)
        np.maximum.at(slack, here[closed], sums[closed])
        here, of, term = here[~closed], passage[first], term[~closed]
        sizes = self.cell_start[term + 1] - self.cell_start[term]
        keys = []
        cuts = np.searchsorted(np.cumsum(sizes), np.arange(0, int(sizes.sum()), CELLS))
        for a, z in zip(cuts, [*cuts[1:], len(term)], strict=True):
            a, z = (np.searchsorted(here, here[x]) if x < len(here) else x for x in (a, z))  # whole passages
            at = ragged(self.cell_start[term[a:z]], sizes[a:z])
            if not len(at):
                continue
            key = np.repeat(here[a:z], sizes[a:z]) * self.blocks + self.cell_block[at]
            order = np.argsort(key, kind="stable")
            key, bound = key[order], self.cell_largest[at][order]
            start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            key, bound = key[start], np.add.reduceat(bound, start)
            keep = bound + slack[key // self.blocks] >= threshold - 1e-9
            keys.append(key[keep])
        key = np.concatenate(keys) if keys else np.zeros(0, np.int64)
        return of[key // self.blocks], key % self.blocks

    def retrieve(self, terms: np.ndarray, threshold: float, low: int = 0, high: int | None = None) -> list[tuple[int, float]]:
        """Items from low to before high whose score for these distinct terms is at the threshold or above: block-max WAND."""
        least, high, out = threshold - 1e-9, len(self.ids) if high is None else high, []
        at: dict[int, int] = {}
        now: dict[int, int] = {}

        def seek(t: int, to: int):
            own = self.items[t]
            i = bisect_left(own, to, at.get(t, 0))
            if i < len(own) and own[i] < high:
                at[t], now[t] = i, own[i]
            else:
                now.pop(t, None)

        for t in terms.tolist():
            seek(t, low)
        while now:
            order = sorted(now, key=now.__getitem__)
            total, pivot = 0.0, -1
            for i, t in enumerate(order):
                total += self.largest[t]
                if total >= least:
                    pivot = i
                    break
            if pivot < 0:
                break
            item = now[order[pivot]]
            while pivot + 1 < len(order) and now[order[pivot + 1]] == item:
                pivot += 1
            upper, ends = 0.0, []
            for t in order[: pivot + 1]:
                own = self.items[t]
                block = bisect_left(own, item, at[t]) // POSTING_BLOCK
                if block < len(self.block_largest[t]):
                    upper += self.block_largest[t][block]
                    ends.append(own[min((block + 1) * POSTING_BLOCK, len(own)) - 1])
            if upper >= least:
                score = 0.0
                for t in order[: pivot + 1]:
                    seek(t, item)
                    if now.get(t) == item:
                        score += self.impacts[t][at[t]]
                if score >= least:
                    out.append((item, score))
                to = item + 1
            else:  # nothing up to the nearest end of a block, or the next list's item, can reach it
                to = max(item + 1, min([*(e + 1 for e in ends), *([now[order[pivot + 1]]] if pivot + 1 < len(order) else [])]))
            for t in order[: pivot + 1]:
                seek(t, to)
        return out


def build(rows: list[tuple], n: int | None = None, average: float | None = None, frequency: dict[int, int] | None = None) -> Index | None:
    """The index of (id, text) rows. n, average words and document frequencies are those of all items where rows are a part."""
    rows = [(i, t) for i, t in rows if t and re.search(r"\w", t)]
    h, before = words_of(pa.array([t for _, t in rows], pa.string()))
    rows = [(*r, h[a:b]) for r, a, b in zip(rows, before, before[1:], strict=False) if b > a]
    if not rows:
        return None
    n = n or len(rows)
    average = average or sum(len(x) for *_, x in rows) / len(rows)
    own = [np.unique(x, return_counts=True) for *_, x in rows]
    term = np.concatenate([t for t, _ in own])
    item = np.repeat(np.arange(len(rows)), [len(t) for t, _ in own])
    tf = np.concatenate([c for _, c in own]).astype(float)
    terms, number, df = np.unique(term, return_inverse=True, return_counts=True)
    if frequency is not None:
        df = np.array([frequency[int(t)] for t in terms.astype(np.int64)])
    size = np.array([len(x) for *_, x in rows])[item]
    impact = np.log1p((n - df + 0.5) / (df + 0.5))[number] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * size / average))
    impact /= np.bincount(item, impact)[item]
    order = np.lexsort((item, number))
    cuts = np.searchsorted(number[order], np.arange(1, len(terms)))
    items, impacts = np.split(item[order], cuts), np.split(impact[order], cuts)
    blocks = [np.maximum.reduceat(x, np.arange(0, len(x), POSTING_BLOCK)) for x in impacts]
    parts = [question_and_answer(t) for _, t, _ in rows]
    part = lambda i: [(gram_size(h), distinct(grams(h, gram_size(h)))) for h in (words_of(pa.array([p[i]]))[0] for p in parts)]
    return Index([i for i, *_ in rows], terms, items, impacts, np.array([x.max() for x in impacts]), blocks, max(len(x) for *_, x in rows), part(0), part(1))


def indexes(items: DataFrame, bound: int = INDEX_BYTES) -> Iterator[Index]:
    """Indexes of all items, each of about `bound` bytes of text, with the statistics of all: as many as the items need."""
    items = items.selectExpr("cast(item_id as long) item_id", "cast(text as string) text").where("text is not null")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = -(-total // bound)
    if count <= 1:
        index = build([tuple(r) for r in items.orderBy("item_id", "text").collect()])
        yield from [index] if index else []
        return

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h, before = words_of(batch.column("text"))
            for a, b in zip(before, before[1:], strict=False):
                own = np.unique(h[a:b]).astype(np.int64)
                sizes = np.where(np.arange(len(own)) == 0, b - a, 0)
                yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(sizes, pa.int64())], names=["term", "words"])

    terms = items.mapInArrow(run, "term long, words long")
    n, words = terms.agg(F.count(F.when(F.col("words") > 0, 1)), F.sum("words")).first()
    frequencies = terms.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    for b in range(count):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == b)
        own = {r["term"]: r["df"] for r in frequencies.join(part.mapInArrow(run, "term long, words long").select("term").distinct(), "term").collect()}
        index = build([tuple(r) for r in part.orderBy("item_id", "text").collect()], n, words / n, own) if own else None
        yield from [index] if index else []


def _share(n: int, own: np.ndarray, passage: np.ndarray, here: dict[int, np.ndarray]) -> float:
    """The share of the runs of n words that the passage holds, all where a part has no word; here: the passage's runs by their words."""
    if not n:
        return 1.0
    if n not in here:
        here[n] = grams(passage, n)
    return float(np.isin(own, here[n]).mean())


def search(part: pa.RecordBatch, index: Index, threshold: float, overlap: float) -> dict[tuple[int, int], tuple[float, float, float, int]]:
    """For (row, item number) of the part that is contaminated its best passage: score, overlaps, first word."""
    h, before = words_of(part.column("text"))
    if not len(h):
        return {}
    spot = np.searchsorted(index.terms, h)
    spot[spot == len(index.terms)] = 0
    hits = np.flatnonzero(index.terms[spot] == h)
    term = spot[hits]
    row = np.searchsorted(before, hits, "right") - 1
    strides = -(-np.diff(before) // index.stride)
    first = np.concatenate([[0], np.cumsum(strides)])
    stride = first[row] + (hits - before[row]) // index.stride
    pairs = distinct(stride * len(index.terms) + term)
    stride, term = pairs // len(index.terms), pairs % len(index.terms)
    upper = np.bincount(stride, index.largest[term], minlength=first[-1] + 1)
    joined = np.zeros(first[-1] + 1, bool)  # whether the next stride is of the same text
    joined[: first[-1]] = True
    joined[first[1:] - 1] = False
    both = upper[:-1] + np.where(joined[:-1], upper[1:], 0.0)
    cuts = np.searchsorted(stride, np.arange(first[-1] + 2))
    out: dict[tuple[int, int], tuple[float, float, float, int]] = {}
    own_row = np.repeat(np.arange(len(strides)), strides)
    able = both >= threshold - 1e-9
    second = np.flatnonzero(stride > 0)
    second = second[joined[stride[second] - 1] & able[stride[second] - 1]]
    own = np.flatnonzero(able[stride])
    passage, held = np.concatenate([stride[own], stride[second] - 1]), np.concatenate([term[own], term[second]])
    if not len(passage):
        return out
    likely = zip(*(x.tolist() for x in index.candidates(passage, held, threshold)), strict=True)
    for s, block in likely:
        terms = distinct(term[cuts[s] : cuts[s + 1 + joined[s]]])
        if not (found := index.retrieve(terms, threshold, block * ITEM_BLOCK, (block + 1) * ITEM_BLOCK)):
            continue
        r = int(own_row[s])
        start = int(before[r]) + (s - int(first[r])) * index.stride
        passage = h[start : min(start + 2 * index.stride, int(before[r + 1]))]
        here: dict[int, np.ndarray] = {}
        for item, score in found:
            q, a = (_share(*g[item], passage, here) for g in (index.question, index.answer))
            if q >= overlap and a >= overlap and (min(q, a), score) > (lambda x: (min(x[1], x[2]), x[0]))(out.get((r, item), (0.0, -1.0, -1.0, 0))):
                out[r, item] = (score, q, a, start - int(before[r]))
    return out


def contaminated(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, overlap: float = OVERLAP, bound: int = INDEX_BYTES) -> DataFrame:
    """doc_id, item_id, score, question_overlap, answer_overlap and word (where the passage starts) of every text and every item it holds.

    An item is held if a passage scores threshold or more (1: all words of the item) and holds the share `overlap` or more of the n-grams of
    its question and of its answer. Texts and items that are null or have no word hold and are held by nothing; rows and items that repeat
    give rows each. Ids may be null. Only doc_id, text and item_id, text are read. No items or no texts: no rows.
    """
    docs = docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text")
    out = docs.sparkSession.createDataFrame([], SCHEMA)
    for index in indexes(items, bound):
        out = out.union(docs.mapInArrow(_finder(docs.sparkSession.sparkContext.broadcast(index), threshold, overlap), SCHEMA))
    return out


def _finder(shared, threshold: float, overlap: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text", PIECE_BYTES):
                found = search(part, shared.value, threshold, overlap)
                ids = part.column("doc_id")
                rows = [(ids[r].as_py(), shared.value.ids[i], *x) for (r, i), x in sorted(found.items())]
                columns = [c.split() for c in SCHEMA.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array([row[j] for row in rows], pa.int64() if kind == "long" else pa.float64()) for j, (_, kind) in enumerate(columns)], names=[c for c, _ in columns])

    return released(run)


def clean(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, overlap: float = OVERLAP, bound: int = INDEX_BYTES) -> DataFrame:
    """The rows of docs, with all their columns, that hold no item."""
    for index in indexes(items, bound):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in pieces(batch, "text", PIECE_BYTES):
                    keep = np.ones(part.num_rows, bool)
                    keep[[r for r, _ in search(part, shared.value, threshold, overlap)]] = False
                    yield part.filter(pa.array(keep))

        docs = docs.mapInArrow(released(run), docs.schema)
    return docs
