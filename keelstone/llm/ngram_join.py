"""Exact Jaccard join of word n-gram sets, and the groups its links form.

1. Every text becomes the set of its distinct shingles, as 64-bit hashes; equal sets are one class from here on. The same pass
   counts in how many sets each of 2**SKETCH_BITS hash buckets occurs: a table of fixed size that orders shingles from rare to
   frequent, hash values breaking ties.
2. A set's prefix in that order holds a member of every set similar enough (prefix filter). A list is all sets with a shingle in
   their prefix, with the shingle's position. Positions skip: what two sets can share after the shingle bounds their overlap. Lists are in
   order of position and indexed by blocks; a block in which no pair can meet the bound, or that is of one group, is skipped.
3. Answers are derived from those of a similar set: in a frequent list the set with the fewest rarer shingles stands for the others;
   all are compared with it first. Sets in one group then need no comparison with each other, so a list whose sets are in one group
   is skipped whole. Of the lists that still hold several groups, pairs across groups that pass the bounds are compared. A list of
   more than TILE entries is dealt into tiles, and each two of them meet in a task of their own: no task holds a long list whole.

Lists are summed up where they are made: a task sends for each shingle the least and greatest group only. Sets are compared where
the member is, next to a copy of the other set for each SALT members. Texts are read anew for this, only those that some pair names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import U64, distinct, drop, flat, mixed, packed, pieces, ragged, released, staged, word_hashes, word_spans
from .components import components

WORDS, NUMERATOR, DENOMINATOR = 5, 80, 100
SKETCH_BITS, SEGMENT_BITS = 20, 14
FREQUENT = 64
LIST_BITS, LIST_ENTRIES = 11, 1 << 19
MARK_BITS, MARK_SEGMENT, MARKED = 28, 15, 1 << 24
HELD = 2_000_000
SALT = 32
SHORT = 16
BLOCK = 64
TILE, TILED_BITS = 1 << 16, 20
PIECE_BYTES = 1 << 20
FACTORS = [U64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63)]


def shingle_sets(column: pa.Array) -> list[np.ndarray]:
    """The sorted distinct shingles of each row's words; of fewer words, the whole sequence as one."""
    data, at, _ = flat(column)
    starts, ends, words = word_spans(data, at)
    h = word_hashes(data, starts, ends)
    grams = np.zeros(0, U64)
    if len(h) >= WORDS:
        grams = h[: len(h) - WORDS + 1] * FACTORS[0]
        for j in range(1, WORDS):
            grams += h[j : len(h) - WORDS + 1 + j] * FACTORS[j]
        grams = mixed(grams)
    out = []
    for a, b in zip(words.tolist(), words[1:].tolist(), strict=False):
        if b - a >= WORDS:
            out.append(distinct(grams[a : b - WORDS + 1]))
        elif b > a:
            few = U64(b - a)
            for x in h[a:b]:
                few = mixed(np.array([few]) * FACTORS[0] + x)[0]
            out.append(np.array([few ^ U64(0x5DEECE66D)]))
        else:
            out.append(np.zeros(0, U64))
    return out


def fingerprint(s: np.ndarray) -> tuple[int, int]:
    """128 bits that tell sets apart."""
    with np.errstate(over="ignore"):
        a, b = mixed(s * FACTORS[1] + U64(1)).sum(dtype=U64), (mixed(s ^ FACTORS[2]) * FACTORS[3]).sum(dtype=U64)
    return int(a.astype(np.int64)), int((b ^ U64(len(s))).astype(np.int64))


def sketched(docs: DataFrame) -> DataFrame:
    """For each row doc_id, row_key, n, k1, k2; and rows (segment, counts) of the frequency table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << SKETCH_BITS, np.uint32)
        names = ["doc_id", "row_key", "n", "k1", "k2", "segment", "counts"]
        for batch in batches:
            for part in pieces(batch, "text", PIECE_BYTES):
                sets = shingle_sets(part.column("text"))
                if sets:
                    counts += np.bincount((np.concatenate(sets) >> U64(64 - SKETCH_BITS)).astype(np.int64), minlength=len(counts)).astype(np.uint32)
                keys = [fingerprint(s) for s in sets]
                none = pa.nulls(len(sets))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("row_key"), pa.array([len(s) for s in sets], pa.int64()), pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int64()), none.cast(pa.int32()), none.cast(pa.binary())], names=names)
        if counts.any():
            own = counts.reshape(-1, 1 << SEGMENT_BITS)
            at = np.flatnonzero(own.any(1))
            none = pa.nulls(len(at), pa.int64())
            yield pa.RecordBatch.from_arrays([none, none, none, none, none, pa.array(at, pa.int32()), packed([own[i].tobytes() for i in at])], names=names)

    return docs.withColumn("row_key", F.xxhash64("text")).mapInArrow(released(run), "doc_id long, row_key long, n long, k1 long, k2 long, segment int, counts binary")


def fetched(segments: DataFrame) -> Iterator[tuple[int, pa.Buffer]]:
    """The rows (segment, bytes) of a table of bounded size, by one job: toLocalIterator runs one for each partition, which the driver keeps on record."""
    for batch in segments.toArrow().to_batches():
        yield from zip(batch.column(0).to_pylist(), (x.as_buffer() for x in batch.column(1)), strict=True)


def summed(rows: DataFrame) -> np.ndarray:
    """The frequency table: as many numbers whatever the input."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: dict[int, np.ndarray] = {}
        for batch in batches:
            for s, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                x = np.frombuffer(raw.as_buffer(), np.uint32)
                own[s] = own.get(s, 0) + x.astype(np.uint64)
        yield pa.RecordBatch.from_arrays([pa.array(list(own), pa.int32()), packed([np.minimum(x, 2**32 - 1).astype(np.uint32).tobytes() for x in own.values()])], names=["segment", "counts"])

    out = np.zeros(1 << SKETCH_BITS, np.uint32).reshape(-1, 1 << SEGMENT_BITS)
    found = rows.where("segment is not null").select("segment", "counts").repartition(len(out), "segment").mapInArrow(released(run), "segment int, counts binary")
    for s, raw in fetched(found):
        out[s] = np.frombuffer(raw, np.uint32)
    return out.ravel()


def prefix(s: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The rarest shingles, rarest first: enough to meet every set that is similar enough."""
    n = len(s)
    size = n - -(-NUMERATOR * n // DENOMINATOR) + 1
    rank = table[(s >> U64(64 - SKETCH_BITS)).astype(np.int64)]
    return s[np.lexsort((s, rank))[:size]]


def prefixes(docs: DataFrame, shared) -> DataFrame:
    """k1, k2, n and the prefix of every set; copies within a part of a batch once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            for part in pieces(batch, "text", PIECE_BYTES):
                own = {fingerprint(s): s for s in shingle_sets(part.column("text")) if len(s)}
                yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in own], pa.int64()), pa.array([k[1] for k in own], pa.int64()), pa.array([len(s) for s in own.values()], pa.int32()), packed([prefix(s, table).tobytes() for s in own.values()])], names=["k1", "k2", "n", "tokens"])

    return docs.mapInArrow(released(run), "k1 long, k2 long, n int, tokens binary")


def entries(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all prefixes of a batch the shingles, whose row they are and their positions."""
    data, at, _ = flat(batch.column("tokens"))
    sizes = np.diff(at) // 8
    return np.frombuffer(data.tobytes(), U64), np.repeat(np.arange(len(sizes)), sizes), ragged(np.zeros(len(sizes), np.int64), sizes)


def overlaps(xn: np.ndarray, xpos: np.ndarray, yn: np.ndarray, ypos: np.ndarray) -> np.ndarray:
    """Whether sets of these sizes can be similar enough if they first meet at these positions."""
    need = (NUMERATOR * (xn + yn) + NUMERATOR + DENOMINATOR - 1) // (NUMERATOR + DENOMINATOR)
    sizes = DENOMINATOR * np.minimum(xn, yn) >= NUMERATOR * np.maximum(xn, yn)
    return sizes & (np.minimum(xn - xpos, yn - ypos) >= need)


def starred(sets: DataFrame, shared) -> DataFrame:
    """Pairs (a, b) of set keys to compare first: in frequent lists every set with the one that has the fewest rarer shingles, within a
    batch and then across batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        often = float(table.mean()) + max(FREQUENT, 8 * float(table.mean()) ** 0.5)
        for batch in batches:
            token, row, pos = entries(batch)
            hot = table[(token >> U64(64 - SKETCH_BITS)).astype(np.int64)] >= often
            token, row, pos = token[hot], row[hot], pos[hot]
            keys, n = (np.asarray(batch.column(c), dtype=np.int64) for c in ("k1", "n"))
            order = np.lexsort((keys[row], pos, token))
            token, row, pos = token[order], row[order], pos[order]
            first = np.concatenate([[True], token[1:] != token[:-1]]) if len(token) else np.zeros(0, bool)
            hub = np.flatnonzero(first)[np.cumsum(first) - 1]
            keep = first | ((keys[row] != keys[row[hub]]) & overlaps(n[row], pos, n[row[hub]], pos[hub]))
            token, row, pos, hr = token[keep], row[keep], pos[keep], row[hub][keep]
            yield pa.RecordBatch.from_arrays([pa.array(token.astype(np.int64)), pa.array(keys[row]), pa.array(n[row]), pa.array(pos), pa.array(keys[hr])], names=["token", "x", "n", "pos", "hub"])

    found = staged(sets.select("k1", "n", "tokens").mapInArrow(released(run), "token long, x long, n long, pos long, hub long"), "join-stars")
    own = found.where("x = hub").select("token", "x", "n", "pos")
    best = own.groupBy("token").agg(F.min(F.struct("pos", "x", "n")).alias("h"), F.count(F.lit(1)).alias("lists")).where("lists > 1")
    need = f"({NUMERATOR} * (n + h.n) + {NUMERATOR + DENOMINATOR - 1}) div {NUMERATOR + DENOMINATOR}"
    across = own.join(best, "token").where(f"x <> h.x and {DENOMINATOR} * least(n, h.n) >= {NUMERATOR} * greatest(n, h.n) and least(n - pos, h.n - h.pos) >= {need}").selectExpr("h.x a", "x b")
    return found.where("x <> hub").selectExpr("hub a", "x b").union(across).distinct()


def place_of(values: np.ndarray, bits: int) -> np.ndarray:
    return (mixed(values.astype(np.int64).view(U64)) >> U64(64 - bits)).astype(np.int64)


def marks(values: DataFrame) -> tuple[int, np.ndarray] | None:
    """A bit for the hash of each value of the one long column, 16 bits or more for each of them; None where that passes 2 ** MARK_BITS bits."""
    count = values.count()
    if count > MARKED:
        return None
    bits = max(MARK_SEGMENT + 1, count.bit_length() + 4)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(1 << (bits - 3), np.uint8)
        for batch in batches:
            at = place_of(np.asarray(batch.column(0), dtype=np.int64), bits)
            np.bitwise_or.at(own, at >> 3, (1 << (at & 7)).astype(np.uint8))
        yield rows({int(i): x for i, x in enumerate(own.reshape(-1, 1 << (MARK_SEGMENT - 3))) if x.any()})

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: dict[int, np.ndarray] = {}
        for batch in batches:
            for s, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own[s] = own.get(s, 0) | np.frombuffer(raw.as_buffer(), np.uint8)
        yield rows(own)

    def rows(own: dict[int, np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(own), pa.int32()), packed([x.tobytes() for x in own.values()])], names=["segment", "bits"])

    schema, out = "segment int, bits binary", np.zeros(1 << (bits - 3), np.uint8).reshape(-1, 1 << (MARK_SEGMENT - 3))
    for s, raw in fetched(values.mapInArrow(released(send), schema).repartition(64, "segment").mapInArrow(released(meet), schema)):
        out[s] = np.frombuffer(raw, np.uint8)
    return bits, out.ravel()


def is_marked(values: np.ndarray, table: tuple[int, np.ndarray]) -> np.ndarray:
    bits, own = table
    at = place_of(values, bits)
    return (own[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0


def compared(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """Those pairs (a, ak, b, bk) of ids and set keys whose sets are similar enough, as links of classes (r: id, k: set key)."""
    spark = docs.sparkSession
    ends = pairs.selectExpr("a doc_id").union(pairs.selectExpr("b doc_id"))
    table = marks(ends)
    shared = spark.sparkContext.broadcast(table)

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(is_marked(np.asarray(batch.column("doc_id"), dtype=np.int64), shared.value)))

    texts = docs.where("doc_id is not null and text is not null")
    texts = (texts.join(ends, "doc_id", "left_semi") if table is None else texts.mapInArrow(released(named), "doc_id long, text string")).hint("merge")
    copies = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("c")).select("a", F.ceil(F.col("c") / SALT).cast("int").alias("salts"))
    members = pairs.join(copies, "a").withColumn("salt", F.pmod(F.xxhash64("b", "bk"), F.col("salts")).cast("int")).join(texts.withColumnRenamed("doc_id", "b"), "b").select("a", "ak", "salt", F.lit(1).alias("kind"), "b", "bk", "text")
    leaders = pairs.select("a", "ak").distinct().join(copies, "a").join(texts.withColumnRenamed("doc_id", "a"), "a").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).select("a", "ak", "salt", F.lit(0).alias("kind"), F.col("a").alias("b"), F.col("ak").alias("bk"), "text")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    both = leaders.unionByName(members).repartition(parts, "a", "ak", "salt").sortWithinPartitions("a", "ak", "salt", "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, leader = None, None
        for batch in batches:
            for part in pieces(batch, "text", PIECE_BYTES):
                sets = shingle_sets(part.column("text"))
                found: list[tuple[int, int, int, int]] = []
                rows = zip(*(part.column(c).to_pylist() for c in ("a", "ak", "salt", "kind", "b", "bk")), sets, strict=True)
                for pa_, pk, salt, kind, pb, bk, s in rows:
                    if fingerprint(s)[0] != bk:
                        continue  # another text under the same id
                    if kind == 0:
                        at, leader = (pa_, pk, salt), s
                    elif at == (pa_, pk, salt):
                        x, y = (s, leader) if len(s) < len(leader) else (leader, s)
                        spot = np.searchsorted(y, x)
                        spot[spot == len(y)] = 0
                        common = int((y[spot] == x).sum())
                        if DENOMINATOR * common >= NUMERATOR * (len(x) + len(y) - common):
                            found.append((pa_, pk, pb, bk))
                yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.int64()) for i in range(4)], names=["a", "ak", "b", "bk"])

    return both.mapInArrow(released(run), "a long, ak long, b long, bk long").distinct().selectExpr("struct(a r, ak k) a", "struct(b r, bk k) b")


def live_lists(sets: DataFrame, parts: int, bits: int) -> DataFrame:
    """The first bits + 32 bits (live) of the shingles whose lists hold more than one group, and the size of their lists. Lists meet in 2 ** bits buckets."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens: list[np.ndarray] = []
        groups: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            token, group = np.concatenate(tokens) >> U64(32 - bits), np.concatenate(groups)
            order = np.argsort(token, kind="stable")
            token, group = token[order], group[order]
            first = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
            low, high = np.minimum.reduceat(group, first), np.maximum.reduceat(group, first)
            size = np.diff(np.append(first, len(token))).astype(np.uint32)
            token = token[first]
            several = low != high
            token, group, size = np.concatenate([token, token[several]]), np.concatenate([low, high[several]]), np.append(size, np.zeros(several.sum(), np.uint32))
            order = np.argsort(token, kind="stable")
            token, group, size = token[order], group[order], size[order]
            cuts = np.searchsorted(token >> U64(32), np.arange((1 << bits) + 1).astype(U64))
            own = np.flatnonzero(np.diff(cuts))
            small = token.astype(np.uint32)
            return pa.RecordBatch.from_arrays([pa.array(own, pa.int32()), packed([small[cuts[i] : cuts[i + 1]].tobytes() for i in own]), packed([group[cuts[i] : cuts[i + 1]].tobytes() for i in own]), packed([size[cuts[i] : cuts[i + 1]].tobytes() for i in own])], names=["bucket", "tokens", "groups", "sizes"])

        held = 0
        for batch in batches:
            token, row, _ = entries(batch)
            if len(token):
                tokens.append(token)
                groups.append(np.asarray(batch.column("label"), dtype=np.int64)[row])
                held += len(token)
            if held >= HELD:
                yield flush()
                tokens, groups, held = [], [], 0
        if held:
            yield flush()

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, groups, sizes = [], [], []
        for batch in batches:
            for bucket, t, g, n in zip(batch.column("bucket").to_pylist(), batch.column("tokens"), batch.column("groups"), batch.column("sizes"), strict=True):
                tokens.append(np.frombuffer(t.as_buffer(), np.uint32).astype(U64) | U64(bucket << 32))
                groups.append(np.frombuffer(g.as_buffer(), np.int64))
                sizes.append(np.frombuffer(n.as_buffer(), np.uint32))
        if tokens:
            token, group, size = np.concatenate(tokens), np.concatenate(groups), np.concatenate(sizes)
            order = np.argsort(token, kind="stable")
            token, group, size = token[order], group[order], size[order]
            first = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
            live = np.minimum.reduceat(group, first) != np.maximum.reduceat(group, first)
            yield pa.RecordBatch.from_arrays([pa.array(token[first][live].astype(np.int64)), pa.array(np.add.reduceat(size, first, dtype=np.int64)[live])], names=["live", "size"])

    return sets.select("tokens", "label").mapInArrow(released(send), "bucket int, tokens binary, groups binary, sizes binary").repartition(parts, "bucket").mapInArrow(released(meet), "live long, size long")


def list_pairs(n: np.ndarray, pos: np.ndarray, group: np.ndarray, side: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of a list's places whose groups, and sides if given, differ and that can be similar enough; some at a time.

    The list, in order of position, group and size, is indexed by blocks of BLOCK places: what its sets have left after their positions
    at most, their least and greatest sizes, and their group if they have one in common. A block is read next to another only where
    these leave a pair possible; the others are skipped unread.
    """
    reach = DENOMINATOR * n - (NUMERATOR + DENOMINATOR) * pos  # NUMERATOR times the other's size at most
    order = np.lexsort((n, group, pos))
    order = order[reach[order] >= NUMERATOR * n.min()]
    if len(order) < 2:
        return
    sn, sp, sg = n[order], pos[order], group[order]
    cuts = np.arange(0, len(order), BLOCK)
    sizes = np.diff(np.append(cuts, len(order)))
    low, high = np.minimum.reduceat(sn, cuts), np.maximum.reduceat(sn, cuts)
    left_over = np.maximum.reduceat(sn - sp, cuts)
    one, alike = sg[cuts], np.minimum.reduceat(sg, cuts) == np.maximum.reduceat(sg, cuts)
    part = None if side is None else side[order]
    for b, a in enumerate(cuts):
        need = (NUMERATOR * (low[b] + low[b:]) + NUMERATOR + DENOMINATOR - 1) // (NUMERATOR + DENOMINATOR)
        fits = (np.minimum(left_over[b], left_over[b:]) >= need) & (DENOMINATOR * np.minimum(high[b], high[b:]) >= NUMERATOR * np.maximum(low[b], low[b:]))
        read = b + np.flatnonzero(fits & ~(alike[b] & alike[b:] & (one[b] == one[b:])))
        for c in range(0, len(read), 1024):
            x, y = np.arange(a, a + sizes[b])[:, None], ragged(cuts[read[c : c + 1024]], sizes[read[c : c + 1024]])[None, :]
            fit = (x < y) & (sg[x] != sg[y]) & overlaps(sn[x], sp[x], sn[y], sp[y])
            if part is not None:
                fit &= part[x] != part[y]
            i, j = np.nonzero(fit)
            if len(i):
                yield order[a + i], order[y[0, j]]


def pairs_of(own: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Pairs (a, ak, b, bk) of whole lists or tiles, given as rows token, id, key, size, group, position, tile and side in order of token and tile."""
    token, x, k, n, label, pos, tile, side = own
    if not len(token):
        return
    cuts = np.flatnonzero(np.concatenate([[True], (token[1:] != token[:-1]) | (tile[1:] != tile[:-1]), [True]]))
    length = np.diff(cuts)
    place = np.arange(len(token)) - np.repeat(cuts[:-1], length)
    few = np.repeat(np.where(length <= SHORT, length, 0), length)

    def named(i: np.ndarray, j: np.ndarray) -> pa.RecordBatch:
        i, j = np.where(x[i] < x[j], i, j), np.where(x[i] < x[j], j, i)
        return pa.RecordBatch.from_arrays([pa.array(c) for c in (x[i], k[i], x[j], k[j])], names=["a", "ak", "b", "bk"])

    for d in range(1, SHORT):  # all short lists at once: each place with the one d further on
        i = np.flatnonzero(place + d < few)
        i = i[(label[i] != label[i + d]) & ((side[i] < 0) | (side[i] != side[i + d]))]
        i = i[overlaps(n[i], pos[i], n[i + d], pos[i + d])]
        yield named(i, i + d)
    long = np.flatnonzero(length > SHORT)
    for a, b in zip(cuts[long], cuts[long + 1], strict=True):
        if (label[a:b] != label[a]).any():
            for i, j in list_pairs(n[a:b], pos[a:b], label[a:b], None if side[a] < 0 else side[a:b]):
                yield named(a + i, a + j)


def tiled(live: DataFrame, total: int) -> tuple[np.ndarray, np.ndarray]:
    """The live lists that are dealt into tiles, in order, and how many tiles each has. All lists together have total entries, so these are 2 ** TILED_BITS at most."""
    most = max(TILE, -(-total >> TILED_BITS))
    own = live.where(F.col("size") > most).select("live", F.ceil(F.col("size") / most).alias("tiles")).orderBy("live").toArrow()
    return tuple(np.asarray(own.column(c).combine_chunks(), dtype=np.int64) for c in ("live", "tiles"))


def across_groups(sets: DataFrame, live: DataFrame, parts: int, bits: int, total: int) -> DataFrame:
    """Pairs (a, ak, b, bk) of sets in different groups that the live lists leave to compare. total: entries of all lists."""
    table = marks(live.select("live"))
    shared, dealt = (sets.sparkSession.sparkContext.broadcast(x) for x in (table, tiled(live, total)))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            token, row, pos = entries(batch)
            if table is not None:
                keep = is_marked((token >> U64(32 - bits)).astype(np.int64), shared.value)
                token, row, pos = token[keep], row[keep], pos[keep]
            long, tiles = dealt.value
            many = np.ones(len(token), np.int64)
            if len(long):
                name = (token >> U64(32 - bits)).astype(np.int64)
                at = np.minimum(np.searchsorted(long, name), len(long) - 1)
                many = np.where(long[at] == name, tiles[at], 1)
            x, k, n, label = (np.asarray(batch.column(c), dtype=np.int64) for c in ("rep", "k1", "n", "label"))
            mine = (mixed(k.view(U64))[row] % many.astype(U64)).astype(np.int64)
            for other in range(int(many.max(initial=1))):
                at = np.flatnonzero(many > other)
                low, high = np.minimum(mine[at], other), np.maximum(mine[at], other)
                side = np.where(low == high, -1, mine[at] == high)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (token[at].astype(np.int64), x[row[at]], k[row[at]], n[row[at]], label[row[at]], pos[at], low * many[at] + high, side)], names=["token", "x", "k", "n", "label", "pos", "tile", "side"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = np.zeros((8, 0), np.int64)
        for batch in batches:
            rest = np.concatenate([rest, np.stack([np.asarray(c, dtype=np.int64) for c in batch.columns])], axis=1)
            done = np.flatnonzero((rest[0] != rest[0, -1:]) | (rest[6] != rest[6, -1:]))
            cut = int(done[-1]) + 1 if len(done) else 0
            yield from pairs_of(rest[:, :cut])
            rest = rest[:, cut:]
        yield from pairs_of(rest)

    rows = sets.select("rep", "k1", "n", "label", "tokens").mapInArrow(released(send), "token long, x long, k long, n long, label long, pos long, tile long, side long")
    if table is None:
        rows = rows.withColumn("live", F.shiftrightunsigned("token", 32 - bits)).join(live, "live", "left_semi").drop("live")
    return rows.repartition(parts, "token", "tile").sortWithinPartitions("token", "tile").mapInArrow(released(meet), "a long, ak long, b long, bk long").distinct()


def clustered(docs: DataFrame) -> DataFrame:
    """doc_id, row_key (hash of the text), n and root of every row: root (r: least id, k: set key) names the group, null where a row has no id or no shingle."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text")
    first = staged(sketched(docs), "join-sets")
    rows = first.where("segment is null").drop("segment", "counts")
    shared = spark.sparkContext.broadcast(summed(first))
    classes = staged(rows.where("doc_id is not null and n > 0").groupBy("k1", "k2").agg(F.min("doc_id").alias("rep")).selectExpr("k1", "k2", "rep", "struct(rep r, k1 k) id"), "join-classes")
    sets = staged(prefixes(docs.where("doc_id is not null"), shared), "join-prefixes")
    keys = classes.select("k1", "rep")
    stars = staged(starred(sets, shared).join(keys.selectExpr("k1 a", "rep ra"), "a").join(keys.selectExpr("k1 b", "rep rb"), "b").selectExpr("ra a", "a ak", "rb b", "b bk"), "join-pairs")
    known = components(compared(docs, stars))
    single = sets.groupBy("k1", "k2").agg(F.first("n").alias("n"), F.first("tokens").alias("tokens"))
    labelled = staged(single.join(classes.join(known, "id", "left").selectExpr("k1", "k2", "rep", "coalesce(root, id).k label").hint("merge"), ["k1", "k2"]), "join-labelled")
    drop(sets, stars)
    total = int(labelled.agg(F.sum(F.length("tokens") / 8)).first()[0] or 0)
    parts, bits = max(parts, -(-total // 2_000_000)), min(24, max(LIST_BITS, (total // LIST_ENTRIES).bit_length()))
    live = staged(live_lists(labelled, parts, bits), "join-live")
    more = staged(across_groups(labelled, live, parts, bits, total), "join-more")
    drop(live, labelled)
    found = staged(compared(docs, more), "join-links")
    if not found.isEmpty():
        before, known = known, components(known.selectExpr("id a", "root b").union(found))
        drop(before)
    drop(more, found)
    ends = classes.join(known, "id", "left").selectExpr("k1", "k2", "coalesce(root, id) root")
    alone = rows.where("doc_id is null or n = 0").selectExpr("doc_id", "row_key", "n", "cast(null as struct<r: long, k: long>) root")
    return rows.where("doc_id is not null and n > 0").join(ends, ["k1", "k2"]).select("doc_id", "row_key", "n", "root").union(alone)


def groups(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of docs (doc_id, text; other columns are not read).

    Words are runs [^\x20\x09-\x0D]+ with A-Z as a-z; shingles are WORDS of them. Texts are linked if the Jaccard
    similarity of their sets is NUMERATOR / DENOMINATOR or more; component_id is the least doc_id reachable. Null texts and texts
    without words have no shingles and stand alone. Rows that repeat an id are linked each by its own text: the id alone links nothing.
    Rows without an id are linked with nothing and have no component_id. An empty table gives no rows.
    """
    return clustered(docs).selectExpr("doc_id", "n n_shingles", "coalesce(root.r, doc_id) component_id")


def one_of_each(docs: DataFrame) -> DataFrame:
    """Of each group of linked texts one row of docs, with all its columns: that with the least id, then the least row_key, then the least other columns.

    Rows without an id and rows without words stay all. Rows that repeat an id with texts that aren't linked stay each.
    """
    rows = staged(clustered(docs), "join-rows")
    chosen = rows.where("root is not null").groupBy("root").agg(F.min(F.struct("doc_id", "row_key")).alias("own"))
    same = rows.where("root is not null").groupBy("doc_id", "row_key").agg(F.count(F.lit(1)).alias("same"))
    kept = staged(chosen.select("own.*").join(same, ["doc_id", "row_key"]).union(rows.where("root is null and doc_id is not null").selectExpr("doc_id", "row_key", "0L same").distinct()), "join-kept")
    keyed = docs.withColumn("row_key", F.xxhash64(F.col("text").cast("string")))
    own = [docs["doc_id"].cast("long") == kept["doc_id"], keyed["row_key"] == kept["row_key"]]
    single = keyed.join(kept.where("same < 2").drop("same"), own, "left_semi").select(*docs.columns)
    several = keyed.join(kept.where("same > 1").drop("same"), own, "left_semi")
    order = Window.partitionBy("doc_id", "row_key").orderBy(*docs.columns)
    several = several.withColumn("rank", F.row_number().over(order)).where("rank = 1").select(*docs.columns)
    return single.union(several).union(docs.where("doc_id is null"))
