"""Language identification by cross-parsing.

For every language a suffix automaton of labelled text is built. A text is cut greedily into the longest phrases that
occur in a language's text; the language in which it needs the fewest phrases, each weighed by the bits that name a place in
that language's text, wins. Texts are read as runs of lower-case letters with one space between. They are parsed in windows of
WINDOW characters, all windows of a batch step by step together, so each character costs a few array steps; windows are then
joined, so the phrases are those of the whole text.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pieces, released

WINDOW = 512
PIECE_BYTES = 2 << 20
TRAIN_ROWS, TRAIN_CHARS, CELLS = 200, 60_000, 8_000_000
NO_LANGUAGE, UNSEEN, LEEWAY = 7.0, 10, 1.3
SCHEMA = "doc_id long, lang_pred string, score double, phrase_rate double"
UNKNOWN = 1  # code of a letter that no language has; 0 pads


def suffix_automaton(text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Transitions (states, symbols, next states) of the automaton of all substrings; state 1 is the start, 0 means there is none."""
    edges: list[dict[int, int]] = [{}, {}]
    link, size, last = [0, 0], [0, 0], 1
    for c in text.tolist():
        new = len(edges)
        edges.append({})
        size.append(size[last] + 1)
        link.append(1)
        p = last
        while p and c not in edges[p]:
            edges[p][c] = new
            p = link[p]
        if p:
            q = edges[p][c]
            if size[p] + 1 == size[q]:
                link[new] = q
            else:
                twin = len(edges)
                edges.append(dict(edges[q]))
                size.append(size[p] + 1)
                link.append(link[q])
                while p and edges[p].get(c) == q:
                    edges[p][c] = twin
                    p = link[p]
                link[q] = link[new] = twin
        last = new
    rows = np.repeat(np.arange(len(edges)), [len(e) for e in edges])
    return rows, np.fromiter((c for e in edges for c in e), np.int64, len(rows)), np.fromiter((t for e in edges for t in e.values()), np.int64, len(rows))


class Automaton:
    """Transitions looked up for many states at once: in a table of all cells where it has CELLS of them at most, else among the sorted ones that exist."""

    def __init__(self, text: np.ndarray, symbols: int):
        rows, columns, to = suffix_automaton(text)
        self.symbols, self.states = symbols, int(max(rows.max(initial=1), to.max(initial=1))) + 1
        keys = rows * symbols + columns
        order = np.argsort(keys)
        self.keys, self.to = keys[order], to[order].astype(np.int32)
        self.first = np.zeros(symbols, np.int64)
        self.first[columns[rows == 1]] = to[rows == 1]
        self._table: np.ndarray | None = None

    def __getstate__(self):
        return self.__dict__ | {"_table": None}

    def step(self, state: np.ndarray, c: np.ndarray) -> np.ndarray:
        """The next states, 0 where there is none."""
        key = state * self.symbols + c
        if self.states * self.symbols <= CELLS:
            if self._table is None:
                self._table = np.zeros(self.states * self.symbols, np.int32)
                self._table[self.keys] = self.to
            return self._table[key]
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == key, self.to[at], 0) if len(self.keys) else np.zeros(len(key), np.int32)


class Model:
    """Suffix automata of the languages, over one alphabet: 1 unknown letter, 2 space, then the letters of the training texts."""

    def __init__(self, texts: dict[str, str]):
        self.languages = sorted(texts)
        joined = {k: " " + " ".join("".join(c if c.isalpha() else " " for c in v.lower()).split()) + " " for k, v in texts.items()}
        self.alphabet = sorted(set("".join(joined.values())) - {" "})
        code = {" ": 2} | {c: i for i, c in enumerate(self.alphabet, 3)}
        self.symbols = len(code) + 2
        coded = {k: np.array([code[c] for c in joined[k]], np.int64) for k in self.languages}
        self.automata = [Automaton(coded[k], self.symbols) for k in self.languages]
        self.bits = np.array([math.log2(len(coded[k]) + 1) for k in self.languages])
        self.limits: dict[str, float] = {}
        self._table: np.ndarray | None = None

    def __getstate__(self):
        return self.__dict__ | {"_table": None}

    def codes(self, text: str) -> np.ndarray:
        """The text as codes: a space first and last, and single spaces between runs of letters."""
        if self._table is None:
            own = {c: i for i, c in enumerate(self.alphabet, 3)}
            self._table = np.array([own.get(c, UNKNOWN) if c.isalpha() else 2 for c in map(chr, range(0x110000))], np.uint16)
        points = np.frombuffer((" " + text.lower() + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
        out = self._table[points]
        space = out == 2
        return out[np.concatenate([[True], ~(space[1:] & space[:-1])])]

    def phrases(self, windows: np.ndarray, goes_on: np.ndarray | None = None) -> np.ndarray:
        """Phrases [language, window] that start in the rows of codes, whose tails are 0. goes_on: the row continues the one before it.

        All rows are parsed side by side, each as if a text began there. A row that goes on is then parsed again from the state in which the row before
        it ended, until both parses stand in the same state and agree from there on: mostly some characters.
        """
        sizes = (windows > 0).sum(1)
        order = np.argsort(-sizes, kind="stable")
        columns = np.ascontiguousarray(windows[order].T)
        alive = np.searchsorted(-sizes[order], -np.arange(len(columns)), "left")  # windows longer than each position
        out = np.zeros((len(self.automata), len(windows)), np.int64)
        for k, automaton in enumerate(self.automata):
            state, n = np.zeros(len(windows), np.int64), np.zeros(len(windows), np.int64)
            for p, m in enumerate(alive.tolist()):
                c = columns[p, :m]
                to = automaton.step(state[:m], c)
                stuck = to == 0
                n[:m] += stuck
                state[:m] = np.where(stuck, automaton.first[c], to)
            n[order], end = n.copy(), np.zeros(len(windows), np.int64)
            end[order] = state
            begin = np.zeros(len(windows), np.int64)
            todo = np.flatnonzero(goes_on) if goes_on is not None else np.zeros(0, np.int64)
            while len(todo := todo[end[todo - 1] != begin[todo]]):
                own, was, rows, p, changed = end[todo - 1], begin[todo], todo, 0, []
                begin[todo] = own
                while len(rows):
                    done = sizes[rows] == p
                    if done.any():
                        end[rows[done]] = own[done]
                        changed.append(rows[done] + 1)
                        rows, own, was = rows[~done], own[~done], was[~done]
                        continue
                    c = windows[rows, p]
                    to, other = automaton.step(own, c), automaton.step(was, c)
                    n[rows] += (to == 0).astype(np.int64) - (other == 0)
                    own, was = (np.where(x == 0, automaton.first[c], x) for x in (to, other))
                    apart = own != was
                    rows, own, was, p = rows[apart], own[apart], was[apart], p + 1
                todo = np.unique(np.concatenate([np.zeros(0, np.int64), *changed]))
                todo = todo[todo < len(windows)]
                todo = todo[goes_on[todo]]
            out[k] = n
        return out

    def rates(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Bits per character [text, language] and whether a text has a letter."""
        sizes, rows, parts = np.zeros(len(texts), np.int64), [], []
        for i, t in enumerate(texts):
            c = self.codes(t or "")
            sizes[i] = len(c)
            if len(c) > 1:  # more than a space
                windows = -(-len(c) // WINDOW)
                parts.append(np.concatenate([c, np.zeros(windows * WINDOW - len(c), c.dtype)]).reshape(windows, WINDOW))
                rows += [i] * windows
        known = sizes > 1
        out = np.full((len(texts), len(self.languages)), np.inf)
        if rows:
            n = np.zeros((len(texts), len(self.languages)))
            rows = np.array(rows)
            goes_on = np.concatenate([[False], rows[1:] == rows[:-1]])
            np.add.at(n, rows, self.phrases(np.concatenate(parts), goes_on).T)
            out[known] = n[known] * self.bits / sizes[known, None]
        return out, known


def sample(docs: DataFrame, rows: int = TRAIN_ROWS, chars: int = TRAIN_CHARS) -> dict[str, list[str]]:
    """Labelled texts of every language: of about `rows` rows with the lowest hashes a run of up to chars / rows characters each, anywhere in the text."""
    some = docs.where("lang is not null and text is not null and length(text) > 0")
    counts = {r["lang"]: r["n"] for r in some.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return {}
    most = max(1, chars // rows)
    chance = F.create_map(*(x for k, n in counts.items() for x in (F.lit(k), F.lit(min(1.0, rows / n)))))[F.col("lang")]
    drawn = F.pmod(F.xxhash64(F.lit("sample"), F.col("doc_id"), F.col("text")), F.lit(1 << 40)) / float(1 << 40)
    start = F.pmod(F.xxhash64(F.lit("start"), F.col("doc_id"), F.col("text")), F.greatest(F.length("text") - most + 1, F.lit(1)).cast("long"))
    own = some.where((drawn <= chance)).select("lang", drawn.alias("d"), F.substr("text", (start + 1).cast("int"), F.lit(most)).alias("t"))
    out: dict[str, list[str]] = {}
    for r in sorted(own.collect(), key=lambda r: (r["lang"], r["d"], r["t"])):
        out.setdefault(r["lang"], []).append(r["t"])
    return {k: v for k, v in out.items() if any(c.isalpha() for t in v for c in t)}


def identify(docs: DataFrame, model: Model | None, schema: str = SCHEMA, keep=None) -> DataFrame:
    """doc_id, lang_pred, score, phrase_rate (bits per character in that language) of every row.

    Null texts and those without a letter are "und" with score 0 and no rate; so is everything where nothing could be learned. score: the
    share of the winner among the languages' inverse rates to the power 8, 1 where there is one language. Ties go to the
    first language by name. Whole texts count; rows may repeat and ids may be null. With keep, a function (predictions, scores, rates)
    -> flags, the rows of docs that it flags are returned instead, with all their columns.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            for part in pieces(batch, "text", PIECE_BYTES):
                n = part.num_rows
                names, scores, best = np.full(n, "und", object), np.zeros(n), np.full(n, np.nan)
                if own is not None:
                    rates, known = own.rates(part.column("text").to_pylist())
                    if known.any():
                        r = np.maximum(rates[known], 1e-9)
                        at = r.argmin(1)
                        names[known] = np.array(own.languages, object)[at]
                        best[known] = r.min(1)
                        scores[known] = 1 / ((best[known, None] / r) ** 8).sum(1)
                if keep is not None:
                    yield part.filter(pa.array(keep(names, scores, best).astype(bool)))
                else:
                    yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(names, pa.string()), pa.array(scores), pa.array(best, mask=np.isnan(best))], names=["doc_id", "lang_pred", "score", "phrase_rate"])

    if keep is not None:
        return docs.mapInArrow(released(run), docs.schema)
    return docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text").mapInArrow(released(run), schema)


def train(docs: DataFrame, rows: int = TRAIN_ROWS, chars: int = TRAIN_CHARS) -> Model | None:
    """The model of about `rows` rows and `chars` characters a language, None where there is no labelled text. One row in UNSEEN sets the limits alone."""
    texts = sample(docs, rows, chars)
    if not texts:
        return None
    enough = {k: len(v) >= 2 * UNSEEN for k, v in texts.items()}
    model = Model({k: "\n".join(t for i, t in enumerate(v) if i % UNSEEN or not enough[k]) for k, v in texts.items()})
    for i, k in enumerate(model.languages):
        rates = model.rates(texts[k][::UNSEEN])[0][:, i] if enough[k] else np.zeros(0)
        rates = rates[np.isfinite(rates)]
        model.limits[k] = max(NO_LANGUAGE, LEEWAY * float(np.median(rates))) if len(rates) else NO_LANGUAGE
    return model


def in_a_language(docs: DataFrame, model: Model | None) -> DataFrame:
    """The rows of docs whose text has a letter and needs no more bits a character than its language's limit.

    The limit is NO_LANGUAGE, phrases of two letters or so; where a language's own texts that training didn't see need that much, as those of a
    large alphabet do, it is LEEWAY times their median. With nothing to learn from, rows with a letter.
    """
    if model is None:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    limits = model.limits
    return identify(docs, model, keep=lambda names, _, rates: np.array([k != "und" and not r > limits[k] for k, r in zip(names, rates, strict=True)], bool))
