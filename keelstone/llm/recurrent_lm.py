"""A gated recurrent language model over words, trained and run in numpy, and the smoothed unigram base beside it.

The SHORTLIST most frequent training words have ids, in classes of equal size by rank; all others share one id. A word's probability is
that of its class times that within the class (class-factored softmax), and for a word outside the list times its smoothed share
among such words, so the probabilities of all words sum to one. A gated recurrent layer is trained by backpropagation through
windows of WINDOW steps, its state carried from window to window; scoring carries the state through the whole text.

Every training token is learned: the texts' ids are cut into runs of RUN, which are dealt to up to WORKERS networks on the executors and to
ROUNDS rounds. In a round each network learns its runs, SIDE of them side by side; after it the networks' mean, weighted by the ids
learned, goes on. The first of them starts from what the driver learned from a small part, so that they don't drift apart.

Counts are of all training tokens: tasks add up their own and words meet by hash. Scoring looks up the most frequent ones in a broadcast
table of bounded size. Where that doesn't hold them all, the texts' other words are sent to where their counts are, added up
for each text, so the texts are read once and the driver holds no more, whatever the number of words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import U64, drop, flat, packed, pieces, staged, word_hashes, word_spans

CLASSES, PER_CLASS = 32, 64
SHORTLIST = CLASSES * PER_CLASS
END, OTHER = 0, 1
END_HASH = U64(0x00000000E0D0E0D0)
WIDTH, HIDDEN, WINDOW, LANES = 24, 32, 16, 32
TRAIN_ROWS, TRAIN_TOKENS, TRAIN_PART, EPOCHS, RATE = 600, 200_000, 100, 2, 0.004
#: Rows and tokens that the driver starts from at most, where no more are asked for.
START_ROWS, START_TOKENS = 1_200, 400_000
#: Where all rows are learned: ids of a run and runs side by side, times the networks meet, ids for each further network, networks at most, parts of their mean.
RUN, SIDE, ROUNDS, WORKER, WORKERS, CHUNKS = 1024, 512, 4, 4_000_000, 64, 8
BUCKET_BITS, HELD = 12, 4_000_000
TABLE_BYTES = 64 << 20
SCORED, SCORED_AT_ONCE = 2_000_000, 1 << 13
SCHEMA = "doc_id long, held_out boolean, n_tokens long, n_known long, base double, model double, rid long"
SENT = ", bucket int, hashes binary, rids binary, times binary"


def exponentials(logits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Those of each row and their sums. Rows' maxima, which cost more than all the rest, are taken off (of logits too) where they have to be."""
    ones = np.ones(logits.shape[1], logits.dtype)
    if logits.size and logits.max() < 60:
        out = np.exp(logits)
        sums = out @ ones
        if sums.min() > 1e-20:
            return out, sums
    logits -= logits.max(1, keepdims=True)
    out = np.exp(logits)
    return out, out @ ones


def by_gate(x: np.ndarray) -> np.ndarray:
    """[gate, row, HIDDEN] of [row, 3 * HIDDEN]: each gate lies in one piece."""
    return np.ascontiguousarray(x.reshape(-1, 3, HIDDEN).transpose(1, 0, 2))


def cell(gates: np.ndarray, h: np.ndarray, u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The next state, and the state's share of n. gates: input's share of z, r, n [gate, lane, HIDDEN], becomes their values."""
    s, zr, n = np.matmul(h, u), gates[:2], gates[2]
    zr += s[:2]
    zr *= 0.5
    np.tanh(zr, out=zr)  # the logistic function by tanh
    zr += 1
    zr *= 0.5
    n += zr[1] * s[2]
    np.tanh(n, out=n)
    new = h - n
    new *= zr[0]
    new += n
    return new, s[2]


class Network:
    """Embedding e, gates (z, r, n) from input w and state u with bias b, class layer c, word layer o of each class."""

    def __init__(self, counts: np.ndarray, seed: int = 1):
        rng = np.random.default_rng(seed)
        some = lambda *shape: (rng.standard_normal(shape) * 0.08).astype(np.float32)
        self.p = {"e": some(SHORTLIST, WIDTH), "w": some(WIDTH, 3 * HIDDEN), "u": some(HIDDEN, 3 * HIDDEN), "b": np.zeros(3 * HIDDEN, np.float32), "c": some(HIDDEN, CLASSES), "o": some(CLASSES, HIDDEN, PER_CLASS)}
        share = counts.reshape(CLASSES, PER_CLASS).astype(np.float64)
        with np.errstate(divide="ignore"):
            self.p["cb"] = np.maximum(np.log(share.sum(1) / max(share.sum(), 1e-9)), -1e9).astype(np.float32)
            self.p["ob"] = np.maximum(np.log(share / np.maximum(share.sum(1, keepdims=True), 1e-9)), -1e9).astype(np.float32)

    def step(self, x: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, ...]:
        """The next state and the gates; x: input's share of the gates' sums."""
        gates = by_gate(x)
        new, s = cell(gates, h, by_gate(self.p["u"]))
        return new, *gates, s

    def inputs(self) -> np.ndarray:
        return self.p["e"] @ self.p["w"] + self.p["b"]

    def log10(self, h: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """log10 probabilities of the ids after the states h."""
        order = np.argsort((ids // PER_CLASS).astype(np.int16), kind="stable")
        ids, h = ids[order], h[order]
        of, word, rows, sorted_out = ids // PER_CLASS, ids % PER_CLASS, np.arange(len(ids)), np.zeros(len(ids))

        def add(logits: np.ndarray, at: np.ndarray, out: np.ndarray):
            sums = exponentials(logits)[1]
            out += logits[rows[: len(at)], at]
            out -= np.log(sums)

        add(h @ self.p["c"] + self.p["cb"], of, sorted_out)
        cuts = np.searchsorted(of, np.arange(CLASSES + 1)).tolist()
        for c in range(CLASSES):
            a, b = cuts[c : c + 2]
            if a < b:
                logits = h[a:b] @ self.p["o"][c]
                logits += self.p["ob"][c]
                add(logits, word[a:b], sorted_out[a:b])
        out = np.empty(len(ids))
        out[order] = sorted_out / np.log(10)
        return out

    def gradients(self, x: np.ndarray, y: np.ndarray, h: np.ndarray, live: np.ndarray | None = None) -> tuple[dict[str, np.ndarray], np.ndarray, float]:
        """Of the mean loss over a window x, y [steps, lanes] from the state h; the last state; the loss in nats. Only the targets that are live count."""
        p, steps, lanes = self.p, *x.shape
        kind, u, w = p["u"].dtype, by_gate(p["u"]), by_gate(p["w"])
        u_back = np.ascontiguousarray(u.transpose(0, 2, 1))
        gates = by_gate(self.inputs()).take(x, 1)  # [gate, step, lane, HIDDEN]: inputs' share, then z, r, n
        trace, states = np.empty((steps, lanes, HIDDEN), kind), np.empty((steps + 1, lanes, HIDDEN), kind)
        states[0] = h
        for t in range(steps):
            states[t + 1], trace[t] = cell(gates[:, t], states[t], u)
        own = slice(None) if live is None else np.flatnonzero(live.ravel())
        ids, after = y.ravel()[own].astype(np.int64), states[1:].reshape(-1, HIDDEN)[own]
        g = {k: np.zeros_like(v) for k, v in p.items()}
        order = np.argsort((ids // PER_CLASS).astype(np.int16), kind="stable")
        ids, after = ids[order], after[order]
        of, word, rows, scale = ids // PER_CLASS, ids % PER_CLASS, np.arange(len(ids)), kind.type(1 / max(1, len(ids)))
        cuts = np.searchsorted(of, np.arange(CLASSES + 1)).tolist()

        def lost(logits: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, float]:
            """The loss and its gradients by the logits."""
            chance, sums = exponentials(logits)
            some = rows[: len(at)]
            loss = float((np.log(sums) - logits[some, at]).sum())
            chance *= (scale / sums)[:, None]
            chance[some, at] -= scale
            return chance, loss

        chance, loss = lost(after @ p["c"] + p["cb"], of)
        g["c"], g["cb"] = after.T @ chance, chance.sum(0)
        sorted_back = chance @ p["c"].T
        for c in range(CLASSES):
            a, b = cuts[c : c + 2]
            if a < b:
                chance, more = lost(after[a:b] @ p["o"][c] + p["ob"][c], word[a:b])
                loss += more
                g["o"][c], g["ob"][c] = after[a:b].T @ chance, chance.sum(0)
                sorted_back[a:b] += chance @ p["o"][c].T
        back = np.zeros((steps * lanes, HIDDEN), kind)
        back[order if live is None else own[order]] = sorted_back
        back = back.reshape(steps, lanes, HIDDEN)
        later, gates_back, from_state = np.zeros((lanes, HIDDEN), kind), np.empty((3, steps, lanes, HIDDEN), kind), np.empty((steps, lanes, HIDDEN), kind)
        for t in reversed(range(steps)):
            (z, r, n), (dz, dr, dn), d, dnr = gates[:, t], gates_back[:, t], back[t], from_state[t]
            d += later
            later = d * z
            np.subtract(d, later, out=dn)
            np.multiply(n, n, out=d)
            np.subtract(1, d, out=d)
            dn *= d
            np.subtract(states[t], n, out=dz)
            dz *= later
            np.subtract(1, z, out=d)
            dz *= d
            np.multiply(dn, r, out=dnr)
            np.multiply(dnr, trace[t], out=dr)
            np.subtract(1, r, out=d)
            dr *= d
            later += dz @ u_back[0]
            later += dr @ u_back[1]
            later += dnr @ u_back[2]
        flat_back, flat_x = gates_back.reshape(3, -1, HIDDEN), x.ravel().astype(np.int16)
        joined = lambda parts: np.concatenate(list(parts), -1)
        before, embedded = states[:-1].reshape(-1, HIDDEN).T, p["e"][flat_x].T
        g["u"] = joined(before @ f for f in (*flat_back[:2], from_state.reshape(-1, HIDDEN)))
        g["b"], g["w"] = joined(np.matmul(np.ones(len(flat_x), kind), flat_back)), joined(np.matmul(embedded, flat_back))
        order = np.argsort(flat_x, kind="stable")
        first = np.flatnonzero(np.diff(flat_x[order], prepend=-1))
        g["e"][flat_x[order[first]]] = np.add.reduceat(sum(f @ own.T for f, own in zip(flat_back, w, strict=True))[order], first, axis=0)
        return g, states[-1].copy(), loss / max(1, len(ids))

    def learn(self, g: dict[str, np.ndarray], moments: tuple[dict, dict], n: int, rate: float) -> None:
        """Step n (from 1) down the gradients, cut to a length of 1, with their running moments."""
        size = float(np.sqrt(sum(np.vdot(v, v) for v in g.values())))
        now = np.float32(rate * (1 - 0.999**n) ** 0.5 / (1 - 0.9**n))
        for k, v in g.items():
            v *= np.float32(min(1.0, 1.0 / max(size, 1e-9)))
            first, second = moments[0][k], moments[1][k]
            first += np.float32(0.1) * (v - first)
            v *= v
            v -= second
            v *= np.float32(0.001)
            second += v
            np.sqrt(second, out=v)
            v += np.float32(1e-8)
            np.divide(first, v, out=v)
            v *= now
            self.p[k] -= v

    def train(self, ids: np.ndarray, epochs: int = EPOCHS, rate: float = RATE) -> list[float]:
        """Truncated backpropagation over a stream of ids, cut into LANES; the mean loss of each epoch."""
        length = (len(ids) - 1) // LANES
        if length < WINDOW:
            return []
        x, y = (ids[i : i + LANES * length].reshape(LANES, length).T for i in (0, 1))
        moments = self.moments()
        losses, n = [], 0
        total = epochs * (length // WINDOW)
        for _ in range(epochs):
            h, own = np.zeros((LANES, HIDDEN), np.float32), []
            for a in range(0, length - WINDOW + 1, WINDOW):
                g, h, loss = self.gradients(x[a : a + WINDOW], y[a : a + WINDOW], h)
                own.append(loss)
                n += 1
                self.learn(g, moments, n, rate * (1 - n / (total + 1)))
            losses.append(float(np.mean(own)))
        return losses

    def moments(self) -> tuple[dict, dict]:
        return tuple({k: np.zeros_like(v) for k, v in self.p.items()} for _ in range(2))

    def train_runs(self, runs: list[np.ndarray], moments: tuple[dict, dict], n: int, rates: tuple[float, float]) -> int:
        """Backpropagation over runs side by side: every id but a run's first is learned, at the rates from one to the other. n: steps before. The steps in all."""
        runs = sorted(runs, key=len, reverse=True)
        sizes = np.array([len(r) - 1 for r in runs])
        square = np.zeros((-(-int(sizes[0]) // WINDOW) * WINDOW + 1, len(runs)), np.int16)
        for i, r in enumerate(runs):
            square[: len(r), i] = r
        h = np.zeros((len(runs), HIDDEN), np.float32)
        for a in range(0, len(square) - 1, WINDOW):
            m = int((sizes > a).sum())
            live = np.arange(a, a + WINDOW)[:, None] < sizes[:m] if sizes[m - 1] < a + WINDOW else None
            g, h, _ = self.gradients(square[a : a + WINDOW, :m], square[a + 1 : a + WINDOW + 1, :m], h[:m], live)
            n += 1
            self.learn(g, moments, n, rates[0] + (rates[1] - rates[0]) * a / len(square))
        return n

    def score(self, texts: list[np.ndarray]) -> np.ndarray:
        """log10 probability of each sequence of ids (its end is not in it and counted), whole sequences side by side."""
        sizes = np.array([len(t) + 1 for t in texts], np.int64)
        order = np.argsort(-sizes, kind="stable")
        sizes, flat_ids = sizes[order], np.concatenate([np.append(texts[i], END) for i in order])
        starts = np.cumsum(sizes) - sizes
        out, inputs, u = np.zeros(len(texts)), by_gate(self.inputs()), by_gate(self.p["u"])
        h, last = np.zeros((len(texts), HIDDEN), np.float32), np.full(len(texts), END)
        every = np.arange(len(texts))
        t, ends = 0, -sizes
        while len(texts) and t < sizes[0]:
            held, wanted, lane, size = [], [], [], 0
            while t < sizes[0] and size < SCORED_AT_ONCE:
                m = int(np.searchsorted(ends, -t, "left"))
                h[:m] = cell(inputs.take(last[:m], 1), h[:m], u)[0]
                now = flat_ids[starts[:m] + t]
                held.append(h[:m].copy())
                wanted.append(now)
                lane.append(every[:m])
                last[:m] = now
                t += 1
                size += m
            out += np.bincount(np.concatenate(lane), self.log10(np.concatenate(held), np.concatenate(wanted)), minlength=len(texts))
        result = np.zeros(len(texts))
        result[order] = out
        return result


def hashed(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, at, _ = flat(column)
    starts, ends, before = word_spans(data, at)
    return word_hashes(data, starts, ends), before


def counted(docs: DataFrame, parts: int) -> DataFrame:
    """Rows (bucket, types, tokens, hashes, counts): every token of the texts, the end of each text among them."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0
        for batch in batches:
            for part in pieces(batch, "text"):
                h = hashed(part.column("text"))[0]
                held.append(np.unique(np.concatenate([h, np.full(part.num_rows, END_HASH)]), return_counts=True))
                size += len(held[-1][0])
                if size >= HELD:
                    held = [merged(held)]
                    size = len(held[0][0])
                    if size >= HELD // 2:
                        yield by_bucket(*held[0])
                        held, size = [], 0
        if held:
            yield by_bucket(*merged(held))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(np.frombuffer(h.as_buffer(), U64), np.frombuffer(c.as_buffer(), np.int64)) for batch in batches for h, c in zip(batch.column("hashes"), batch.column("counts"), strict=True)]
        if held:
            yield by_bucket(*merged(held))

    def merged(held: list) -> tuple[np.ndarray, np.ndarray]:
        h, c = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.argsort(h, kind="stable")
        h, c = h[order], c[order]
        first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        return h[first], np.add.reduceat(c.astype(np.int64), first)

    def by_bucket(h: np.ndarray, c: np.ndarray) -> pa.RecordBatch:
        cuts = np.searchsorted((h >> U64(64 - BUCKET_BITS)).astype(np.int64), np.arange((1 << BUCKET_BITS) + 1))
        own = np.flatnonzero(np.diff(cuts))
        part = lambda x: packed([x[cuts[i] : cuts[i + 1]].tobytes() for i in own])
        return pa.RecordBatch.from_arrays([pa.array(own, pa.int32()), pa.array(np.diff(cuts)[own]), pa.array([int(c[cuts[i] : cuts[i + 1]].sum()) for i in own], pa.int64()), part(h), part(c)], names=["bucket", "types", "tokens", "hashes", "counts"])

    schema = "bucket int, types long, tokens long, hashes binary, counts binary"
    return docs.mapInArrow(send, schema).repartition(parts, "bucket").mapInArrow(meet, schema)


def frequent(counts: DataFrame, n: int) -> list[tuple[int, int]]:
    """The n most frequent (hash, count) but the end of a text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for h, c in zip(batch.column("hashes"), batch.column("counts"), strict=True):
                h, c = np.frombuffer(h.as_buffer(), np.int64), np.frombuffer(c.as_buffer(), np.int64)
                at = np.lexsort((h, -c))[: n + 1]
                yield pa.RecordBatch.from_arrays([pa.array(h[at]), pa.array(c[at])], names=["h", "c"])

    top = counts.select("hashes", "counts").mapInArrow(run, "h long, c long").where(F.col("h") != int(END_HASH)).orderBy(F.desc("c"), "h").limit(n)
    return [(r["h"], r["c"]) for r in top.collect()]


def score(docs: DataFrame, held_out: Column, train_rows: int = TRAIN_ROWS, train_tokens: int = TRAIN_TOKENS, table_bytes: int = TABLE_BYTES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10), learned_tokens of every row; learned from rows not held out.

    Tokens are words [^\\x20\\x09-\\x0D]+ with A-Z as a-z, then one end; null is read as "". Counts and the network are of all tokens of all rows
    that aren't held out: learned_tokens says how many the network has learned, and is train_tokens. It starts from what the driver learned from one row and
    one token in TRAIN_PART (START_ROWS and START_TOKENS at most), or about train_rows rows and train_tokens tokens if those are more: a run of each of
    the rows with the lowest hashes, none longer than twice their mean share. Rows and ids may repeat or be null;
    other columns are not read. With nothing to learn from, N and V are 0. An empty table gives no rows.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    learned = docs.where("not held_out")
    counts = staged(counted(learned.select("text"), parts), "lm-counts")
    types, tokens = (x or 0 for x in counts.agg(F.sum("types"), F.sum("tokens")).first())
    top = frequent(counts, SHORTLIST - 2)
    texts = tokens and next(iter(counts.where(F.col("bucket") == int(END_HASH >> U64(64 - BUCKET_BITS))).select("hashes", "counts").toLocalIterator()), None)
    ends = 0
    if texts:
        h = np.frombuffer(texts[0], U64)
        ends = int(np.frombuffer(texts[1], np.int64)[np.searchsorted(h, END_HASH)])
    own = np.zeros(SHORTLIST)
    own[END] = max(ends, 0.5)
    own[2 : 2 + len(top)] = [c for _, c in top]
    other_tokens, other_types = tokens - ends - sum(c for _, c in top), types - len(top) - bool(ends)
    own[OTHER] = max(other_tokens, 0.5)
    listed = np.array([h for h, _ in top], np.int64).view(U64)
    order = np.argsort(listed)
    listed, number = listed[order], order + 2
    network, learned_tokens = Network(own), 0
    if tokens:
        drawn = F.pmod(F.xxhash64(F.lit("lm"), "doc_id", "text"), F.lit(1 << 40)) / float(1 << 40)
        rows, budget = min(max(1, ends), max(train_rows, min(ends // TRAIN_PART, START_ROWS))), max(train_tokens, min(tokens // TRAIN_PART, START_TOKENS))
        place = F.pmod(F.xxhash64(F.lit("lm-window"), "doc_id", "text"), F.lit(1 << 40))
        chosen = learned.select(drawn.alias("d"), place.alias("place"), "text").where(F.col("d") <= min(1.0, rows / max(1, ends)))
        windows = chosen.mapInArrow(_windows(listed, number, max(2, 2 * budget // rows)), "d double, ids binary")
        stream, size = [], 0
        for _, ids in sorted(map(tuple, windows.collect())):
            if size >= budget:
                break
            stream.append(np.frombuffer(ids, np.int16)[: budget - size])
            size += len(stream[-1])
        network.train(np.concatenate(stream) if stream else np.zeros(0, np.int64))
        learned_tokens = train_all(learned.select("text"), network, listed, number, int(tokens))
    shared = spark.sparkContext.broadcast((network, listed, number))
    least = least_count(counts, table_bytes // 16) if 16 * types > table_bytes else 0
    got = counts.mapInArrow(_frequent(least, listed), "hashes binary, counts binary").toArrow()
    join = lambda c, kind: np.frombuffer(b"".join(x.as_py() for x in got.column(c)), kind)
    hashes, times = join("hashes", U64), join("counts", np.int64)
    order = np.argsort(hashes)
    table = spark.sparkContext.broadcast((hashes[order], times[order], not least))
    rows = docs.withColumn("rid", F.monotonically_increasing_id())
    out = rows.mapInArrow(_scorer(shared, table, tokens, types, other_tokens, other_types), SCHEMA + SENT)
    if least:
        out = staged(out, "lm-scored")
        sent = out.where("bucket is not null").selectExpr("bucket", "1 kind", "hashes", "rids", "times")
        own = counts.selectExpr("bucket", "0 kind", "hashes", "cast(null as binary) rids", "counts times")
        met = own.union(sent).repartition(max(parts, -(-int(types) // HELD)), "bucket").sortWithinPartitions("bucket", "kind")
        more = met.mapInArrow(_meet(tokens, types, other_tokens, other_types), "rid long, n_known long, base double, model double").groupBy("rid").agg(*(F.sum(c).alias(f"more_{c}") for c in ("n_known", "base", "model")))
        out = out.where("bucket is null").join(more, "rid", "left").select("doc_id", "held_out", "n_tokens", *((F.col(c) + F.coalesce(F.col(f"more_{c}"), F.lit(0))).alias(c) for c in ("n_known", "base", "model")))
    return out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(int(tokens)).cast("long").alias("train_tokens"), F.col("base").alias("base_score"), F.col("model").alias("score"), F.lit(learned_tokens).cast("long").alias("learned_tokens"))


def ids_of(h: np.ndarray, listed: np.ndarray, number: np.ndarray) -> np.ndarray:
    if not len(listed):
        return np.full(len(h), OTHER)
    at = np.searchsorted(listed, h)
    at[at == len(listed)] = 0
    return np.where(listed[at] == h, number[at], OTHER)


def _windows(listed: np.ndarray, number: np.ndarray, most: int):
    """d and the ids of a run of up to `most` tokens of each text, which starts where place says."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                h, before = hashed(part.column("text"))
                ids, out = ids_of(h, listed, number).astype(np.int16), []
                for place, a, b in zip(part.column("place").to_pylist(), before, before[1:], strict=False):
                    own = np.append(ids[a:b], np.int16(END))
                    start = place % (len(own) - most + 1) if len(own) > most else 0
                    out.append(own[start : start + most].tobytes())
                yield pa.RecordBatch.from_arrays([part.column("d"), packed(out)], names=["d", "ids"])

    return run


def train_all(learned: DataFrame, network: Network, listed: np.ndarray, number: np.ndarray, tokens: int) -> int:
    """The network learns every token of the texts, on executors; how many it learned."""
    workers = min(max(1, tokens // WORKER), WORKERS)
    runs = learned.mapInArrow(_runs(listed, number, workers), "worker int, round int, part int, at long, ids binary")
    runs = staged(runs.repartitionById(workers, F.col("worker")).sortWithinPartitions("round", "worker", "part", "at"), "lm-runs")
    shapes = [(k, v.shape, v.size) for k, v in network.p.items()] * 3
    state = np.concatenate([v.ravel() for d in (network.p, *network.moments()) for v in d.values()])
    share, learned_tokens = tokens / (workers * ROUNDS), 0
    for r in range(ROUNDS):
        shared = learned.sparkSession.sparkContext.broadcast(state)
        own = runs.where(F.col("round") == r).mapInArrow(_learner(shared, share, r), "worker int, part int, at long, chunk int, n long, state binary")
        mean = own.repartition(CHUNKS, "chunk").sortWithinPartitions("chunk", "worker", "part", "at").mapInArrow(_mean, "chunk int, n long, state binary")
        got = sorted(map(tuple, mean.collect()))
        shared.unpersist()
        if got:
            learned_tokens += got[0][1]
            state = np.concatenate([np.frombuffer(x, np.float32) for _, _, x in got])
    drop(runs)
    a = 0
    for k, shape, size in shapes[: len(network.p)]:
        network.p[k] = state[a : a + size].reshape(shape).copy()
        a += size
    return learned_tokens


def _runs(listed: np.ndarray, number: np.ndarray, workers: int):
    """The texts' ids, an end after each, as one sequence cut into runs of RUN, each after the id before it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n, left = TaskContext.get().partitionId(), 0, np.full(1, END, np.int16)

        def rows(cuts: list[np.ndarray]) -> pa.RecordBatch:
            at = np.arange(n, n + len(cuts))
            return pa.RecordBatch.from_arrays([pa.array(((part + at) % workers).astype(np.int32)), pa.array(((part + at) // workers % ROUNDS).astype(np.int32)), pa.array(np.full(len(at), part, np.int32)), pa.array(at), packed([c.tobytes() for c in cuts])], names=["worker", "round", "part", "at", "ids"])

        for batch in batches:
            for piece in pieces(batch, "text"):
                h, before = hashed(piece.column("text"))
                left = np.concatenate([left, np.insert(ids_of(h, listed, number).astype(np.int16), before[1:], np.int16(END))])
                whole = (len(left) - 1) // RUN
                yield rows([left[i * RUN : (i + 1) * RUN + 1] for i in range(whole)])
                n, left = n + whole, left[whole * RUN :]
        if len(left) > 1:
            yield rows([left])

    return run


def _learner(shared, share: float, r: int):
    """What each network has become by its runs of round r, in CHUNKS, and how many ids it learned. share: ids of a network in a round, about."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        whose, network, moments, n, learned = None, None, None, 0, 0

        def learn():
            nonlocal n, held, learned
            more = learned + sum(map(len, held)) - len(held)
            n = network.train_runs(held, moments, n, tuple(RATE * (1 - (r + min(1, x / share)) / ROUNDS) for x in (learned, more)))
            held, learned = [], more

        def end() -> pa.RecordBatch:
            parts = np.array_split(np.concatenate([v.ravel() for d in (network.p, *moments) for v in d.values()]), CHUNKS)
            return pa.RecordBatch.from_arrays([*(pa.array([x] * CHUNKS, kind) for x, kind in zip(whose, (pa.int32(), pa.int32(), pa.int64()), strict=True)), pa.array(range(CHUNKS), pa.int32()), pa.array([learned] * CHUNKS, pa.int64()), packed([x.tobytes() for x in parts])], names=["worker", "part", "at", "chunk", "n", "state"])

        for batch in batches:
            for worker, part, at, ids in zip(*(batch.column(c) for c in ("worker", "part", "at", "ids")), strict=True):
                if whose is None or worker.as_py() != whose[0]:
                    if held:
                        learn()
                    if whose:
                        yield end()
                    whose, n, learned = (worker.as_py(), part.as_py(), at.as_py()), int(share * r / SIDE / WINDOW), 0
                    network = Network(np.ones(SHORTLIST))
                    moments, a = network.moments(), 0
                    for d in (network.p, *moments):
                        for k, v in d.items():
                            d[k] = shared.value[a : a + v.size].reshape(v.shape).copy()
                            a += v.size
                held.append(np.frombuffer(ids.as_buffer(), np.int16))
                if len(held) == SIDE:
                    learn()
        if held:
            learn()
        if whose:
            yield end()

    return run


def _mean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The networks' mean, weighted by the ids they learned, chunk by chunk, and how many those are."""
    sums: dict[int, tuple[int, np.ndarray]] = {}
    for batch in batches:
        for chunk, n, state in zip(*(batch.column(c) for c in ("chunk", "n", "state")), strict=True):
            had, total = sums.get(chunk.as_py(), (0, 0.0))
            sums[chunk.as_py()] = had + n.as_py(), total + n.as_py() * np.frombuffer(state.as_buffer(), np.float32).astype(np.float64)
    for chunk, (n, total) in sums.items():
        yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int32()), pa.array([n], pa.int64()), packed([(total / n).astype(np.float32).tobytes()])], names=["chunk", "n", "state"])


def least_count(counts: DataFrame, most: int) -> int:
    """The least power of two such that no more than `most` words occur as often."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(64, np.int64)
        for batch in batches:
            for c in batch.column(0):
                own += np.bincount(np.log2(np.frombuffer(c.as_buffer(), np.int64)).astype(np.int64), minlength=64)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(64)), pa.array(own)], names=["power", "n"])

    n = {r["power"]: r["n"] for r in counts.select("counts").mapInArrow(run, "power long, n long").groupBy("power").agg(F.sum("n").alias("n")).collect()}
    power = 63
    while power and sum(n.get(p, 0) for p in range(power - 1, 64)) <= most:
        power -= 1
    return 1 << power


def _frequent(least: int, listed: np.ndarray):
    """Hashes and counts of the words that occur `least` times or are listed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h, c = (np.frombuffer(b"".join(x.as_py() for x in batch.column(i)), kind) for i, kind in (("hashes", U64), ("counts", np.int64)))
            keep = (c >= least) | np.isin(h, listed) | (h == END_HASH)
            yield pa.RecordBatch.from_arrays([packed([h[keep].tobytes()]), packed([c[keep].tobytes()])], names=["hashes", "counts"])

    return run


def _meet(tokens: int, types: int, other_tokens: int, other_types: int):
    """What the words sent to their counts' bucket add to their texts. In each bucket the counts come first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole, others = np.log10(tokens + 0.5 * (types + 1)), np.log10(other_tokens + 0.5 * (other_types + 1))
        at, hashes, counts = None, np.zeros(0, U64), np.zeros(0, np.int64)
        for batch in batches:
            for r in batch.to_pylist():
                h, times = np.frombuffer(r["hashes"], U64), np.frombuffer(r["times"], np.int64)
                if r["bucket"] != at:
                    at, hashes, counts = r["bucket"], np.zeros(0, U64), np.zeros(0, np.int64)
                if not r["kind"]:
                    hashes, counts = h, times
                    continue
                c = np.zeros(len(h), np.int64)
                if len(hashes):
                    spot = np.searchsorted(hashes, h)
                    spot[spot == len(hashes)] = 0
                    c = np.where(hashes[spot] == h, counts[spot], 0)
                rid, row = np.unique(np.frombuffer(r["rids"], np.int64), return_inverse=True)
                sums = lambda x: np.bincount(row, x * times, minlength=len(rid))  # noqa: E731,B023
                yield pa.RecordBatch.from_arrays([pa.array(rid), pa.array(sums(c > 0).astype(np.int64)), pa.array(sums(np.log10(c + 0.5) - whole)), pa.array(sums(np.log10(c + 0.5) - others))], names=["rid", "n_known", "base", "model"])

    return run


def _scorer(shared, table, tokens: int, types: int, other_tokens: int, other_types: int):
    """Rows of SCHEMA: what the network says and what the words in the table add; and rows of buckets of the other words, their texts and how often."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network, listed, number = shared.value
        hashes, counts, complete = table.value
        whole, others = np.log10(tokens + 0.5 * (types + 1)), np.log10(other_tokens + 0.5 * (other_types + 1))
        names = [c.split()[0] for c in (SCHEMA + SENT).split(", ")]
        held: list[list] = []
        waiting: list[np.ndarray] = []
        sent: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            model = network.score(waiting)
            for part, n, known, base, extra in held:
                own, model = extra + model[: len(n)], model[len(n) :]
                none = pa.nulls(len(n))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("held_out"), pa.array(n), pa.array(known), pa.array(base), pa.array(own), part.column("rid"), none.cast(pa.int32()), *[none.cast(pa.binary())] * 3], names=names)
            if sent:
                h, rid, times = (np.concatenate(x) for x in zip(*sent, strict=True))
                order = np.argsort(h, kind="stable")
                cuts = np.searchsorted((h[order] >> U64(64 - BUCKET_BITS)).astype(np.int64), np.arange((1 << BUCKET_BITS) + 1))
                own = np.flatnonzero(np.diff(cuts))
                none = pa.nulls(len(own))
                parts = [packed([x[order[cuts[i] : cuts[i + 1]]].tobytes() for i in own]) for x in (h, rid, times)]
                yield pa.RecordBatch.from_arrays([none.cast(pa.int64()), none.cast(pa.bool_()), *[none.cast(pa.int64())] * 2, *[none.cast(pa.float64())] * 2, none.cast(pa.int64()), pa.array(own, pa.int32()), *parts], names=names)

        for batch in batches:
            for part in pieces(batch, "text"):
                h, before = hashed(part.column("text"))
                n = np.diff(before) + 1
                row = np.repeat(np.arange(len(n)), n)
                every = np.full(len(row), END_HASH)
                at = np.cumsum(n) - 1
                word = np.ones(len(row), bool)
                word[at] = False
                every[word] = h
                kinds, back = np.unique(every, return_inverse=True)
                mine = np.full(len(kinds), complete)
                c = np.zeros(len(kinds), np.int64)
                if len(hashes):
                    spot = np.searchsorted(hashes, kinds)
                    spot[spot == len(hashes)] = 0
                    found = hashes[spot] == kinds
                    c, mine = np.where(found, counts[spot], 0), found | complete
                if not mine.all():
                    cold = ~mine[back]
                    pair, times = np.unique(back[cold] * len(n) + row[cold], return_counts=True)
                    sent.append((kinds[pair // len(n)], np.asarray(part.column("rid"), dtype=np.int64)[pair % len(n)], times))
                worth = np.where(mine, np.log10(c + 0.5) - whole, 0.0)
                outside = np.where(mine & (ids_of(kinds, listed, number) == OTHER) & (kinds != END_HASH), np.log10(c + 0.5) - others, 0.0)
                sums = lambda x: np.bincount(row, x[back], minlength=len(n))  # noqa: E731,B023
                held.append([part.select(["doc_id", "held_out", "rid"]), n, sums((c > 0).astype(float)).astype(np.int64), sums(worth), sums(outside)])
                ids = ids_of(kinds, listed, number)[back]
                waiting += np.split(ids[word].astype(np.int32), np.cumsum(n - 1)[:-1]) if len(n) else []
                size += len(row)
                if size >= SCORED:
                    yield from flush()
                    held, waiting, sent, size = [], [], [], 0
        if held:
            yield from flush()

    return run
