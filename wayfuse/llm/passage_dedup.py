"""Repeated passages, found by prefix-free parsing.

A text is read as UTF-8 bytes. A rolling hash runs over its k-grams; the lowest
of those in each window of WIDTH bytes is a trigger, so every window holds one,
and windows with equal bytes have theirs at the same place. Triggers cut the
corpus into phrases: all bytes of the windows of one trigger. The distinct
phrases are the dictionary, their occurrences in corpus order the parse.

No window crosses the end of a phrase, so of the suffix array of the parse only
the order by first phrase is needed, and within it corpus order: the occurrences
sorted by (trigger, phrase, document, place). A phrase that occurs before is
covered whole; first occurrences make up the dictionary.

Two windows of WIDTH bytes with one trigger share NEAR bytes on one side of it.
Phrases that share these bytes with no other phrase of their trigger hold no
repeated window. The others are brought together by trigger and side, whole
groups at a time, and the suffix array of this part of the dictionary is built
by prefix doubling up to WIDTH bytes. Suffixes that agree in so many are
neighbours in it; of each run the one that is first in corpus order, as the parse
has it, stays, and the windows of all others are covered. Bytes are compared, not
hashes of them.

Phrases are collapsed within each batch before the shuffle, so a passage with
many copies sends one row a batch. Sorted partitions are read as streams; where
very many different phrases share trigger and side, their windows are dealt out
by content, of which a 128-bit hash then stands for the bytes, so no group has to
fit memory and no task gets such a group. Long texts are parsed in pieces; a
phrase that is cut by that is compared by its windows like any other.

Defined results: a null or empty text has no bytes and nothing removed; texts
shorter than WIDTH lose nothing; a null id comes after all others; rows that
repeat an id, or have none, come in the order of their text's hash; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, text_or_empty

WIDTH = 100
GRAM = 16
#: Bytes beside the trigger, on the side where the window has more.
NEAR = (WIDTH - GRAM) // 2
#: Windows of a text that are parsed at once.
PIECE = 1 << 20
_ODD = np.uint64(0x9E3779B97F4A7C15)


def gram_hashes(data: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """A polynomial hash modulo 2^64 of every run of gram bytes, by doubling; gram is a power of two."""
    h, step = data.astype(np.uint64) + np.uint64(1), 1
    factor = 0x100000001B3
    with np.errstate(over="ignore"):
        while step < gram:
            h = h[:-step] * np.uint64(factor) + h[step:]
            factor = factor * factor % (1 << 64)
            step *= 2
        h ^= h >> np.uint64(32)
        h *= _ODD
        h ^= h >> np.uint64(29)
    return h


def mixed(*hashes: np.ndarray) -> np.ndarray:
    """32 bits of several hashes."""
    out = np.zeros(len(hashes[0]), np.uint64)
    with np.errstate(over="ignore"):
        for h in hashes:
            out = (out ^ h) * _ODD
            out ^= out >> np.uint64(31)
    return (out >> np.uint64(32)).astype(np.uint32).view(np.int32)


def phrases(data: np.ndarray, width: int = WIDTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(trigger hash, place of the trigger, first window, last window, hash of what is right of the trigger, and left) of every phrase; window p is data[p : p + width].

    A side's hash means nothing where no window has NEAR bytes on it.
    """
    if len(data) < width:
        return (np.array([], np.uint64), *(np.array([], np.int64) for _ in range(3)), *(np.array([], np.int32) for _ in range(2)))
    h = gram_hashes(data, gram)
    low = (h & ~np.uint64(0xFFFFFFFF)) | np.arange(len(h), dtype=np.uint64)  # the leftmost of equal ones is the lowest
    span, have = width - gram + 1, 1
    while 2 * have <= span:
        low = np.minimum(low[:-have], low[have:])
        have *= 2
    if have < span:
        low = np.minimum(low[: len(low) - (span - have)], low[span - have :])
    at = (low & np.uint64(0xFFFFFFFF)).astype(np.int64)
    cuts = np.flatnonzero(at[1:] != at[:-1])
    first, last = np.concatenate(([0], cuts + 1)), np.concatenate((cuts, [len(at) - 1]))
    t, end = at[first], len(h) - 1
    right = mixed(*(h[np.minimum(t + x, end)] for x in (gram, 2 * gram, NEAR)))
    left = mixed(*(h[np.maximum(t - x, 0)] for x in (gram, 2 * gram, NEAR)))
    return h[t], t, first, last, right, left


class Rows:
    """Occurrences (group, content, doc, first, last, sides) as columns."""

    NAMES = ("g", "c", "doc", "a", "b", "t", "r", "l")

    def __init__(self, columns: list[list[np.ndarray]]):
        self.columns = [np.concatenate(c) for c in columns]

    def batch(self) -> pa.RecordBatch:
        """First occurrences in this batch as they are; others without content, which marks them as covered, dealt out by document."""
        g, c, doc, a, *rest = self.columns
        order = np.lexsort((a, doc, c, g))
        g, c, doc, a, *rest = (x[order] for x in (g, c, doc, a, *rest))
        again = np.zeros(len(g), bool)
        again[1:] = (g[1:] == g[:-1]) & (c[1:] == c[:-1])
        with np.errstate(over="ignore"):
            g = np.where(again, (doc.view(np.uint64) * _ODD + a.view(np.uint64)).view(np.int64), g)
        return pa.RecordBatch.from_arrays([pa.array(g), pa.array(c, mask=again), pa.array(doc), *(pa.array(x.astype(np.int32)) for x in (a, *rest))], names=list(self.NAMES))


ROWS = "g long, c long, doc long, a int, b int, t int, r int, l int"
SPANS = "doc long, a int, b int, g long, t int, r int, l int, covered boolean"
#: Phrases that are collapsed and sent at once, phrases that share trigger and side from which on windows are dealt out by content, and bytes of phrases that are ordered at once.
SENT, CROWD, ORDERED = 500_000, 500, 1 << 20
#: Parts that the phrases of a crowded key are dealt to where they meet the list of such keys.
SALTS = 64


def _parse(size: int):
    """Occurrences of phrases of texts; so many windows of a text are parsed at once."""

    def run(batches):
        cols: list[list[np.ndarray]] = [[] for _ in Rows.NAMES]
        held = 0
        for batch in batches:
            for doc, text in zip(batch.column("doc").to_pylist(), batch.column("text").cast(pa.large_binary()).to_pylist(), strict=True):
                for start in range(0, len(text) - WIDTH + 1 if text else 0, size):
                    piece = memoryview(text)[start : start + size + WIDTH - 1]
                    g, t, a, b, r, left = phrases(np.frombuffer(piece, np.uint8))
                    digest = xxhash.xxh3_64_intdigest
                    c = np.fromiter((digest(piece[x : y + WIDTH]) for x, y in zip(a.tolist(), b.tolist(), strict=True)), np.uint64, len(a))
                    for own, x in zip(cols, (g.view(np.int64), c.view(np.int64), np.full(len(a), doc), a + start, b + start, t + start, r, left), strict=True):
                        own.append(x)
                    held += len(a)
                    if held >= SENT:
                        yield Rows(cols).batch()
                        cols, held = [[] for _ in Rows.NAMES], 0
        if held:
            yield Rows(cols).batch()

    return run


def _pack(batches):
    """Texts compressed, for the shuffles to carry."""
    for batch in batches:
        press = zstandard.ZstdCompressor(level=1).compress
        packed = [press(t) for t in batch.column("text").cast(pa.large_binary()).to_pylist()]
        at = batch.schema.get_field_index("text")
        columns = [c for i, c in enumerate(batch.columns) if i != at]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(packed, pa.binary())], names=[*(n for n in batch.schema.names if n != "text"), "packed"])


CONTEXTS = f"{ROWS}, bytes binary"


def _contexts(batches):
    """The bytes of the phrases in spans (array of a, b, key, crowded); of those that are crowded the windows, as occurrences with content."""
    for batch in batches:
        out: list[list] = [[], [], [], []]
        windows: list[list[np.ndarray]] = [[] for _ in Rows.NAMES]
        for doc, packed, spans in zip(batch.column("doc").to_pylist(), batch.column("packed").to_pylist(), batch.column("spans").to_pylist(), strict=True):
            text = memoryview(zstandard.ZstdDecompressor().decompress(packed))
            for s in spans:
                a, b = s["a"], s["b"]
                if s["crowded"]:
                    raw = np.frombuffer(b"".join(xxhash.xxh3_128_digest(text[p : p + WIDTH]) for p in range(a, b + 1)), np.int64)
                    at, none = np.arange(a, b + 1), np.zeros(b + 1 - a, np.int32)
                    for own, x in zip(windows, (raw[0::2], raw[1::2], np.full(len(at), doc), at, at, none, none, none), strict=True):
                        own.append(x)
                else:
                    for own, x in zip(out, (s["key"], doc, a, bytes(text[a : b + WIDTH])), strict=True):
                        own.append(x)
        if out[0]:
            n = len(out[0])
            key, doc, a, data = (pa.array(x, k) for x, k in zip(out, (pa.int64(), pa.int64(), pa.int32(), pa.binary()), strict=True))
            yield pa.RecordBatch.from_arrays([key, pa.nulls(n, pa.int64()), doc, a, a, *(pa.nulls(n, pa.int32()) for _ in range(3)), data], names=[*Rows.NAMES, "bytes"])
        if windows[0]:
            found = Rows(windows).batch()
            yield pa.RecordBatch.from_arrays([*found.columns, pa.nulls(found.num_rows, pa.binary())], names=[*Rows.NAMES, "bytes"])


def suffix_array(data: np.ndarray, at: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """(those of the places at whose width bytes occur again, in order of these bytes, and the number of each run of equal ones).

    Prefix doubling: ranks of 8 bytes give those of 16 and so on; two ranks that
    overlap give those of width. A place whose bytes are unique is unique at every
    length and is not looked at again.
    """
    n = len(data)
    word = np.zeros(n + 8, np.uint64)
    word[:n] = data
    for step in (1, 2, 4):
        word = (word << np.uint64(8 * step)) | np.r_[word[step:], np.zeros(step, np.uint64)]
    rank, size = np.full(n + width, -1, np.int64), 8
    where, ranks = _ranked(np.arange(n), word[:n])
    rank[where] = ranks
    while True:
        other = min(size, width - size)
        if size + other == width:
            where = at
        where = where[(rank[where] >= 0) & (rank[where + other] >= 0)]
        where, ranks = _ranked(where, (rank[where].astype(np.uint64) << np.uint64(32)) | rank[where + other].astype(np.uint64))
        size += other
        if size == width:
            return where, ranks
        rank[:] = -1
        rank[where] = ranks


def _ranked(where: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places whose key another has too, in order of keys, and the rank of each key."""
    order = np.argsort(key, kind="stable")
    where, key = where[order], key[order]
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    alone = new & np.r_[new[1:], np.ones(min(1, len(new)), bool)]
    rank = np.cumsum(new)
    return where[~alone], rank[~alone]


def covered_windows(pieces: list[tuple[int, int, bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc, first, last) of runs of windows of pieces (doc, place, bytes) that are in the pieces before as well."""
    size = np.array([len(x) for *_, x in pieces])
    doc, place = (np.array([x[i] for x in pieces], np.int64) for i in (0, 1))
    many = size - WIDTH + 1
    piece = np.repeat(np.arange(len(pieces)), many)
    offset = np.arange(len(piece)) - np.repeat(np.cumsum(many) - many, many)
    at = (np.cumsum(size) - size)[piece] + offset
    back = np.zeros(int(size.sum()), np.int64)
    back[at] = np.arange(len(at))
    where, run = suffix_array(np.frombuffer(b"".join(x for *_, x in pieces), np.uint8), at)
    own = back[where]
    d, p = doc[piece[own]], place[piece[own]] + offset[own]
    order = np.lexsort((p, d, run))
    d, p, run = d[order], p[order], run[order]
    later = np.zeros(len(run), bool)
    later[1:] = run[1:] == run[:-1]
    d, p = d[later], p[later]
    order = np.lexsort((p, d))
    d, p = d[order], p[order]
    starts = np.flatnonzero(np.r_[True, (d[1:] != d[:-1]) | (p[1:] > p[:-1] + 1)][: len(d)])
    ends = np.append(starts[1:], len(d))[: len(starts)] - 1
    return d[starts], p[starts], p[ends]


def _dictionary(batches):
    """Spans of windows that come before, of phrases sorted by (g, doc, a): whole groups at a time."""
    held: list[tuple[int, int, bytes]] = []
    now, size = None, 0

    def emit():
        doc, a, b = covered_windows(held)
        return pa.record_batch({"doc": pa.array(doc), "a": pa.array(a.astype(np.int32)), "b": pa.array(b.astype(np.int32))})

    for batch in batches:
        for g, doc, a, data in zip(*(batch.column(n).to_pylist() for n in ("g", "doc", "a", "bytes")), strict=True):
            if g != now and size > ORDERED:
                yield emit()
                held, size = [], 0
            now = g
            held.append((doc, a, data))
            size += len(data)
    if held:
        yield emit()


def _fates(doubtful: bool):
    """Over rows sorted by (g, c, doc, a): spans that are covered and, if doubtful is set, first occurrences that share trigger and side with other content.

    r and l of a doubtful span are null where no other phrase of its group shares
    that side; a group that goes on in another batch is taken to share all.
    """

    def emit(doc, a, b, g=None, t=None, r=None, left=None):
        n, covered = len(doc), g is None
        none = pa.nulls(n, pa.int32())
        more = [pa.nulls(n, pa.int64()), none, none, none] if covered else [pa.array(g, pa.int64()), pa.array(t, pa.int32()), r, left]
        return pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(a, pa.int32()), pa.array(b, pa.int32()), *more, pa.array([covered] * n, pa.bool_())], names=["doc", "a", "b", "g", "t", "r", "l", "covered"])

    def shared(group: np.ndarray, side: np.ndarray, has: np.ndarray, whole: np.ndarray) -> np.ndarray:
        """Whether another of the rows has the same side; for rows whose group is not whole, whether they have the side."""
        _, back, n = np.unique((group << 32) | side.view(np.uint32), return_inverse=True, return_counts=True) if has.all() else (None, None, None)
        if back is None:
            out = np.zeros(len(group), bool)
            out[has] = shared(group[has], side[has], np.ones(int(has.sum()), bool), whole[has])
            return out
        return (n[back] > 1) | ~whole

    def run(batches):
        last = None  # group and content before
        head = None  # the first row of the open group, until other content follows
        for batch in batches:
            g, doc, a, b, t, r, left = (batch.column(n).to_numpy() for n in ("g", "doc", "a", "b", "t", "r", "l"))
            known = np.asarray(batch.column("c").is_null())
            if known.any():
                yield emit(doc[known], a[known], b[known])
            c = batch.column("c").fill_null(0).to_numpy()
            g, c, doc, a, b, t, r, left = (x[~known] for x in (g, c, doc, a, b, t, r, left))
            if not len(g):
                continue
            new_g, new_c = np.ones(len(g), bool), np.ones(len(g), bool)
            new_g[1:] = g[1:] != g[:-1]
            new_c[1:] = new_g[1:] | (c[1:] != c[:-1])
            if last is not None:
                new_g[0] = g[0] != last[0]
                new_c[0] = new_g[0] or c[0] != last[1]
            last = int(g[-1]), int(c[-1])
            yield emit(doc[~new_c], a[~new_c], b[~new_c])
            if not doubtful:
                continue
            group = np.cumsum(new_g)  # 0: goes on from the batch before
            other = new_c & ~new_g
            mixed = np.bincount(group[other], minlength=group[-1] + 1) > 0
            if head is not None and mixed[0]:
                yield emit([head[0]], [head[1]], [head[2]], [head[3]], [head[4]], pa.array([head[5]], pa.int32()), pa.array([head[6]], pa.int32()))
                head = None
            if head is not None and group[-1] > 0:
                head = None
            pick = np.flatnonzero(other | (new_g & mixed[group]))
            if len(pick):
                own, whole = group[pick], (group[pick] > 0) & (group[pick] < group[-1])
                on_right = shared(own, r[pick], b[pick] >= t[pick] - NEAR, whole)
                on_left = shared(own, left[pick], a[pick] < t[pick] - NEAR, whole)
                some = on_right | on_left
                p = pick[some]
                yield emit(doc[p], a[p], b[p], g[p], t[p], pa.array(r[p], mask=~on_right[some]), pa.array(left[p], mask=~on_left[some]))
            if group[-1] > 0:
                at = int(np.flatnonzero(new_g)[-1])
                if mixed[-1]:
                    head = None
                else:
                    head = tuple(int(x[at]) for x in (doc, a, b, g, t)) + (int(r[at]) if b[at] >= t[at] - NEAR else None, int(left[at]) if a[at] < t[at] - NEAR else None)

    return run


def _ordered(rows: DataFrame) -> DataFrame:
    return rows.repartition("g").sortWithinPartitions("g", "c", "doc", "a")


def numbered(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, doc_id, text): doc numbers the rows in the order of doc_id.

    Where integer ids tell all rows apart they are the numbers and nothing is
    written; else rows are put in order and written.
    """
    own = docs.select(F.col(doc_id).alias("doc_id"), text_or_empty(text).alias("text"))
    if own.schema["doc_id"].dataType.simpleString() in ("bigint", "int", "smallint", "tinyint"):
        worst = own.groupBy("doc_id").count().agg(F.max("count"), F.count_if(F.col("doc_id").isNull())).first()
        if worst[0] in (None, 1) and not worst[1]:
            return own.select(F.col("doc_id").cast("bigint").alias("doc"), "doc_id", "text")
    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text")]
    return materialize(own.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("doc", F.monotonically_increasing_id()), "passage-docs").select("doc", "doc_id", "text")


def repeated_spans(docs: DataFrame, *, crowd: int = CROWD, piece: int = PIECE) -> DataFrame:
    """(doc, a, b): windows a to b of each numbered document that start earlier in the corpus as well."""
    texts = docs.where(F.octet_length("text") >= WIDTH).select("doc", "text")
    found = materialize(_ordered(texts.mapInArrow(_parse(piece), ROWS)).mapInArrow(_fates(True), SPANS), "passage-phrases")
    side = lambda key, a, b: F.struct(F.xxhash64("g", key, F.lit(key)).alias("key"), a.alias("a"), b.alias("b"))
    turn = F.col("t") - NEAR  # from here on windows have NEAR bytes to the right of the trigger
    sides = F.array(F.when(F.col("r").isNotNull(), side("r", F.greatest("a", turn), F.col("b"))), F.when(F.col("l").isNotNull(), side("l", F.col("a"), F.least("b", turn - 1))))
    unsure = materialize(found.where("not covered").select("doc", F.explode(F.array_compact(sides)).alias("x")).select("doc", "x.*"), "passage-unsure")
    many = materialize(unsure.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "passage-keys")
    crowds = many.where(F.col("n") > crowd).select("key", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"), F.lit(True).alias("crowded"))
    salted = unsure.withColumn("salt", F.pmod(F.xxhash64("doc", "a"), F.lit(SALTS)).cast("int")).join(crowds, ["key", "salt"], "left").drop("salt")
    salted = materialize(salted.withColumn("crowded", F.coalesce("crowded", F.lit(False))), "passage-salted")
    some = salted.where("not crowded").join(many.where(F.col("n") <= crowd).select("key"), "key", "left_semi")
    unsure = some.unionByName(salted.where("crowded")).groupBy("doc").agg(F.collect_list(F.struct("a", "b", "key", "crowded")).alias("spans"))
    contexts = materialize(texts.mapInArrow(_pack, "doc long, packed binary").join(unsure, "doc").mapInArrow(_contexts, CONTEXTS), "passage-contexts")
    ordered = contexts.where("bytes is not null").select("g", "doc", "a", "bytes").repartition("g").sortWithinPartitions("g", "doc", "a")
    crowded = _ordered(contexts.where("bytes is null").drop("bytes")).mapInArrow(_fates(False), SPANS)
    spans = ("doc", "a", "b")
    return found.where("covered").select(*spans).unionByName(ordered.mapInArrow(_dictionary, "doc long, a int, b int")).unionByName(crowded.select(*spans))


def cut(text: bytes, spans: list, width: int = WIDTH) -> tuple[bytes, int]:
    """(bytes that are left, number of runs removed)."""
    out, at, runs = [], 0, 0
    for a, b in sorted((s["a"], s["b"] + width) for s in spans):
        if a > at or runs == 0:
            runs += 1
            out.append(text[at:a])
        at = max(at, b)
    out.append(text[at:])
    return b"".join(out), runs


def remove_repeats(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", crowd: int = CROWD, piece: int = PIECE) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (binary, since a cut may part a character) of every row."""
    rows = numbered(docs, doc_id=doc_id, text=text)
    kind = rows.schema["doc_id"].dataType.simpleString()
    spans = repeated_spans(rows, crowd=crowd, piece=piece).groupBy("doc").agg(F.collect_list(F.struct("a", "b")).alias("spans"))

    def run(batches):
        for batch in batches:
            texts = [zstandard.ZstdDecompressor().decompress(z) for z in batch.column("packed").to_pylist()]
            own = batch.column("spans").to_pylist()
            done = [cut(t, s) if s else (t, 0) for t, s in zip(texts, own, strict=True)]
            n = [len(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array([x - len(k) for x, (k, _) in zip(n, done, strict=True)], pa.int64()), pa.array([r for _, r in done], pa.int64()), pa.array([k for k, _ in done], pa.binary())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
            )

    packed = rows.mapInArrow(_pack, f"doc long, doc_id {kind}, packed binary")
    joined = packed.join(spans, "doc", "left").select("doc_id", "packed", "spans")
    return joined.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept binary")
