"""A class-based bigram language model.

Words are counted over all training texts and every word has a class by exchange:
it goes where the class bigrams are likeliest. The most frequent words are
clustered first, one by one, on the driver. Then all words of the look-up table
move at once, each by its counts of neighbouring classes, which are gathered and
compared in Spark; then so do all words outside it. The number of classes grows
with the cube root of the vocabulary. P(text) is the product of the probabilities
of class after class and of word in class, both smoothed.

Each text is read twice: to count words, and to be written as the places of its
words in the look-up table, END after each text. All that follows works on these
numbers, batch by batch.

Sizes: the words clustered first and the look-up table are the most frequent
words up to two parameters, so what reaches the driver and what is broadcast is
bounded but for the class bigrams, which have the square of the number of classes.
A word outside the look-up table is a hole in its text, filled by a join on its
hash, exactly; every such word is rarer than those looked up, so no key is hot.

Defined results: a null or empty text is its end token alone; unseen words count
0 and have a class of their own; a word that has no neighbour with a class has
one by its number; without training texts all counts are 0 and scores stay
finite; repeated rows are scored alike; extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_batches, materialize, texts_of

#: A word that no text holds, as it is white space: the end of each text, and what stands before its first word.
END = b" "
SMOOTH = 0.1
#: Words clustered one by one before all others follow.
CLUSTERED = 1024
#: Classes at least; there are as many as the cube root of the vocabulary.
CLASSES = 32
#: How often all words of the look-up table move.
SWEEPS = 2
LOOKED_UP = 400_000
#: Longer words are told by a hash, which bounds the bytes of the look-up table.
LONGEST = 64
#: Counts up to this have their gains ready, and keys that are counted at once.
FEW, HELD = 8, 2_000_000
#: Words of texts that are worked on at once, if one text has no more.
PART = 500_000
#: How counts of neighbours travel: a row for each word holds its contexts.
ENTRY = np.dtype([("context", "<u2"), ("n", "<u4")])


def tokens(text: bytes | None) -> list[bytes]:
    return [*text.lower().split(), END] if text else [END]


def key_of(word: bytes) -> bytes:
    """The word, or for a long one END and its hash, which no word equals."""
    return word if len(word) <= LONGEST else END + xxhash.xxh3_128_digest(word)


def word_counts(docs: DataFrame, *, text: str = "text") -> DataFrame:
    """(word, c) over all rows, the end token included; counted by batch before the shuffle."""

    def run(table: pa.Table) -> pa.Table:
        seen: Counter = Counter()
        for t in texts_of(table):
            seen.update(tokens(t))
        return pa.table({"word": pa.array(list(map(key_of, seen)), pa.binary()), "c": pa.array(list(seen.values()), pa.int64())})

    parts = map_batches(docs.select(F.col(text).cast("string").alias("text")), run, "word binary, c long")
    return parts.groupBy("word").agg(F.sum("c").alias("c"))


def frequent(words: DataFrame, most: int) -> float:
    """The least eighth of a power of two such that at most so many words occur more often; found by a histogram of a few hundred rows."""
    step = F.floor(F.log2(F.col("c")) * 8)
    bins = sorted(words.groupBy(step.alias("b")).count().collect(), key=lambda r: -r["b"])
    total, least = 0, bins[0]["b"] + 1 if bins else 0
    for r in bins:
        total += r["count"]
        if total > most:
            break
        least = r["b"]
    return float(least)


def exchange(pairs: np.ndarray, fixed: np.ndarray, classes: int, *, sweeps: int = 6) -> np.ndarray:
    """Classes 0 to classes-1 of the first symbols of a table of bigram counts; fixed holds the classes of the symbols after them.

    Each word in turn goes to the class that makes the likelihood of the class
    bigrams largest, until a sweep moves none.
    """
    n, m = len(pairs) - len(fixed), classes + (int(fixed.max()) + 1 - classes if len(fixed) else 0)
    own = np.concatenate([np.arange(n) % classes, fixed]).astype(np.int64)
    if n == 0 or classes < 2:
        return own[:n]
    one = np.zeros((len(pairs), m))
    one[np.arange(len(pairs)), own] = 1
    table, right, left = one.T @ pairs @ one, pairs @ one, (one.T @ pairs).T
    order = np.argsort(-(pairs.sum(axis=1)[:n] + pairs.sum(axis=0)[:n]), kind="stable")
    for _ in range(sweeps):
        moved = 0
        for w in order.tolist():
            home, both = own[w], pairs[w, w]
            r, lf = right[w].copy(), left[w].copy()
            r[home] -= both
            lf[home] -= both
            table[home, :] -= r
            table[:, home] -= lf
            table[home, home] -= both
            rows, cols, diagonal = table[:classes], table[:, :classes].T, np.arange(classes)
            gain = (xlogx(rows + r) - xlogx(rows)).sum(axis=1) + (xlogx(cols + lf) - xlogx(cols)).sum(axis=1)
            d = table[diagonal, diagonal]
            gain += xlogx(d + r[:classes] + lf[:classes] + both) - xlogx(d + r[:classes]) - xlogx(d + lf[:classes]) + xlogx(d)
            size_out, size_in = table.sum(axis=1)[:classes], table.sum(axis=0)[:classes]
            gain -= xlogx(size_out + r.sum() + both) - xlogx(size_out) + xlogx(size_in + lf.sum() + both) - xlogx(size_in)
            best = int(gain.argmax())
            best = home if gain[best] <= gain[home] + 1e-9 else best
            table[best, :] += r
            table[:, best] += lf
            table[best, best] += both
            if best != home:
                moved += 1
                own[w] = best
                right[:, home] -= pairs[:, w]
                right[:, best] += pairs[:, w]
                left[:, home] -= pairs[w, :]
                left[:, best] += pairs[w, :]
        if not moved:
            break
    return own[:n]


class Model:
    """What scoring needs; arrays run over the look-up table's words, END first."""

    def __init__(self, words: list[bytes], counts: np.ndarray, size: int, distinct: int):
        self.index = {w: i for i, w in enumerate(words)}
        self.counts, self.size, self.distinct = counts, size, distinct


def xlogx(x: np.ndarray) -> np.ndarray:
    return np.where(x > 0, x * np.log(np.maximum(x, 1e-300)), 0.0)


def pack(key: np.ndarray, n: np.ndarray, width: int) -> pa.RecordBatch:
    """(node, data) of sorted keys node * width + context and their counts: a row for each node."""
    node, data = key // width, np.empty(len(key), ENTRY)
    data["context"], data["n"] = key % width, n
    starts = np.flatnonzero(np.r_[True, node[1:] != node[:-1]][: len(node)])
    offsets = (np.append(starts, len(key)) * ENTRY.itemsize).astype(np.int32)
    packed = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data.tobytes())])
    return pa.record_batch({"node": pa.array(node[starts], pa.int64()), "data": packed})


PACKED = "node long, data binary"


def flat(column: pa.Array, kind: np.dtype | type) -> tuple[np.ndarray, np.ndarray]:
    """(all items of a column of packed arrays, how many each row has)."""
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw.view(kind), np.diff(at) // np.dtype(kind).itemsize


def unpack(batch: pa.RecordBatch, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(node, context, n), the counts of a node summed, in order."""
    data, many = flat(batch.column("data"), ENTRY)
    key = np.repeat(batch.column("node").to_numpy(), many) * width + data["context"]
    key, back = np.unique(key, return_inverse=True)
    return key // width, key % width, np.bincount(back, weights=data["n"], minlength=len(key))


def by_node(packed: DataFrame, fn: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """fn over the rows of whole nodes, a few thousand rows at a time."""

    def run(batches):
        held = None
        for batch in batches:
            rows = pa.Table.from_batches([batch] if held is None else [held, batch]).combine_chunks().to_batches()
            if not rows:
                continue
            held = rows[0]
            node = held.column("node").to_numpy()
            cut = np.flatnonzero(node[1:] != node[:-1])
            if len(cut):  # the last node may go on in the next batch
                yield from fn(held.slice(0, int(cut[-1]) + 1))
                held = held.slice(int(cut[-1]) + 1)
        if held is not None:
            yield from fn(held)

    return packed.repartition("node").sortWithinPartitions("node").mapInArrow(run, schema)


def sequences(batches) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(some texts, their words one after the other with END before the first and after each, how many each has)."""
    for batch in batches:
        start = 0
        ends = np.cumsum(flat(batch.column("ids"), np.int32)[1], dtype=np.int64)
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + PART, "right")))
            part = batch.slice(start, stop - start)
            ids, many = flat(part.column("ids"), np.int32)
            yield part, np.concatenate([np.zeros(1, np.int32), ids]), many
            start = stop


def class_pairs(coded: DataFrame, class_of: np.ndarray, total: int) -> np.ndarray:
    """How often class follows class, as a table; class_of[-1] is the class of a hole."""
    shared = coded.sparkSession.sparkContext.broadcast(class_of)

    def run(batches):
        seen = np.zeros(total * total, np.int64)
        for _, at, _ in sequences(batches):
            c = shared.value[at]
            seen += np.bincount(c[:-1] * total + c[1:], minlength=total * total)
        while seen.any():  # an entry holds 32 bits
            key = np.flatnonzero(seen)
            yield pack(key, np.minimum(seen[key], (1 << 32) - 1), total)
            seen[key] -= np.minimum(seen[key], (1 << 32) - 1)

    def add(rows: pa.RecordBatch):
        node, context, n = unpack(rows, total)
        yield pa.record_batch({"pair": pa.array(node * total + context), "n": pa.array(n.astype(np.int64))})

    found = by_node(coded.select("ids").mapInArrow(run, PACKED), add, "pair long, n long").toArrow()
    out = np.zeros(total * total)
    out[found.column("pair").to_numpy()] = found.column("n").to_numpy()
    return out.reshape(total, total)


class Mover:
    """Gains of words from the classes that they could have, given a table of class bigrams."""

    def __init__(self, table: np.ndarray, classes: int):
        self.classes, self.total = classes, len(table)
        #: Rows are contexts: the class after a word, or len(table) plus the class before it.
        self.near = np.concatenate([table[:classes].T, table[:, :classes]])
        self.sizes = np.stack([table.sum(axis=1)[:classes], table.sum(axis=0)[:classes]])
        self.ready = np.stack([xlogx(self.near + n) - xlogx(self.near) for n in range(1, FEW + 1)]).astype(np.float32)

    def best(self, node: np.ndarray, context: np.ndarray, n: np.ndarray, home: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(words, the class of each that makes the class bigrams likeliest), all others staying.

        Rows are a word's counts n by context, sorted by word. home is its
        present class, whose counts it is taken out of first; classes or more if
        it has none.
        """
        starts = np.flatnonzero(np.r_[True, node[1:] != node[:-1]])
        group = np.cumsum(np.r_[False, node[1:] != node[:-1]])
        lived = home[starts]
        gain = np.empty((len(starts), self.classes))
        ends, at = np.append(starts[1:], len(node)), 0
        while at < len(starts):  # so many rows at a time, whole words
            to = max(at + 1, int(np.searchsorted(ends, starts[at] + 20_000, "right")))
            rows = slice(int(starts[at]), int(ends[to - 1]))
            k, ctx = n[rows], context[rows]
            step = self.ready[np.minimum(k, FEW).astype(np.int64) - 1, ctx]
            much = np.flatnonzero(k > FEW)
            step[much] = xlogx(self.near[ctx[much]] + k[much, None]) - xlogx(self.near[ctx[much]])
            own = np.flatnonzero(home[rows] < self.classes)
            there = home[rows][own]
            less = np.maximum(self.near[ctx[own], there] - k[own], 0)
            step[own, there] = xlogx(less + k[own]) - xlogx(less)
            gain[at:to] = np.add.reduceat(step, starts[at:to] - starts[at], axis=0, dtype=np.float64)
            at = to
        housed = np.flatnonzero(lived < self.classes)
        for side, sizes in zip((context < self.total, context >= self.total), self.sizes, strict=True):
            mine = np.bincount(group[side], weights=n[side], minlength=len(starts))
            size = np.tile(sizes, (len(starts), 1))
            size[housed, lived[housed]] = np.maximum(size[housed, lived[housed]] - mine[housed], 0)
            gain -= xlogx(size + mine[:, None]) - xlogx(size)
        best = gain.argmax(axis=1)
        stay = housed[gain[housed, best[housed]] <= gain[housed, lived[housed]] + 1e-6]
        best[stay] = lived[stay]
        return node[starts], best


def sweep(coded: DataFrame, model: Model, class_of: np.ndarray, first: int) -> np.ndarray:
    """The classes after all words from the first on have moved at once."""
    classes, total = model.classes, model.classes + 2
    shared = coded.sparkSession.sparkContext.broadcast((class_of, class_pairs(coded, class_of, total)))

    def around(batches):
        held, n = [], 0
        for _, at, _ in sequences(batches):
            at = at.astype(np.int64)
            c = shared.value[0][at]
            after = (at[:-1] >= first) & (c[1:] != classes)
            before = (at[1:] >= first) & (c[:-1] != classes)
            held += [at[:-1][after] * 2 * total + c[1:][after], at[1:][before] * 2 * total + total + c[:-1][before]]
            n += len(held[-1]) + len(held[-2])
            if n >= HELD:
                yield pack(*np.unique(np.concatenate(held), return_counts=True), 2 * total)
                held, n = [], 0
        if n:
            yield pack(*np.unique(np.concatenate(held), return_counts=True), 2 * total)

    mover: list[Mover] = []

    def move(rows: pa.RecordBatch):
        homes, table = shared.value
        if not mover:
            mover.append(Mover(table, classes))
        for at in range(0, rows.num_rows, 1 << 20):
            node, context, n = unpack(rows.slice(at, 1 << 20), 2 * total)
            word, best = mover[0].best(node, context, n, homes[node])
            yield pa.record_batch({"node": pa.array(word), "class": pa.array(best.astype(np.int32))})

    moved = by_node(coded.select("ids").mapInArrow(around, PACKED), move, "node long, class int").toArrow()
    out = class_of.copy()
    out[moved.column("node").to_numpy()] = moved.column("class").to_numpy()
    return out


CODED = "row_id long, doc_id {}, trained boolean, ids binary, rare binary"


def vocabulary(docs: DataFrame, *, text: str = "text", looked_up: int = LOOKED_UP) -> Model:
    """The counts of the words of docs, and the look-up table."""
    words = materialize(word_counts(docs, text=text), "lm-words")
    size, distinct = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    often = F.floor(F.log2(F.col("c")) * 8) >= frequent(words, looked_up)
    found = words.where(often | (F.col("word") == F.lit(bytearray(END)))).toArrow()
    word, c = found.column("word").to_pylist(), found.column("c").to_numpy()
    order = sorted(range(len(word)), key=lambda i: (word[i] != END, -c[i], word[i]))
    return Model([word[i] for i in order] or [END], c[order].astype(float) if order else np.zeros(1), int(size), int(distinct))


def encode(docs: DataFrame, model: Model, trained: Column, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row as places in the look-up table, -1 for the words that it lacks, and the hashes of these."""
    if not hasattr(model, "shared"):
        model.shared = docs.sparkSession.sparkContext.broadcast(model.index)
    lookup = model.shared

    def run(table: pa.Table) -> pa.Table:
        get, hash64 = lookup.value.get, xxhash.xxh64_intdigest
        ids, rare = [], []
        for t in texts_of(table):
            own = tokens(t)
            at = np.fromiter(map(get, own, repeat(-1)), np.int32, len(own))
            missed = []
            for i in np.flatnonzero(at < 0).tolist():
                word = own[i]
                if len(word) > LONGEST and (found := get(key_of(word))) is not None:
                    at[i] = found
                else:
                    missed.append(hash64(word, 42))
            ids.append(at.tobytes())
            rare.append(np.array(missed, np.uint64).tobytes())
        kept = table.drop_columns(["text"])
        return kept.append_column("ids", pa.array(ids, pa.binary())).append_column("rare", pa.array(rare, pa.binary()))

    own = docs.select(F.monotonically_increasing_id().alias("row_id"), F.col(doc_id).alias("doc_id"), F.coalesce(trained, F.lit(False)).alias("trained"), F.col(text).cast("string").alias("text"))
    return materialize(map_batches(own, run, CODED.format(docs.schema[doc_id].dataType.simpleString())), "lm-coded")


def holes(coded: DataFrame, model: Model) -> DataFrame:
    """(row_id, trained, pos, hash, left, right) of the words that the look-up table lacks: the classes around, that of a hole for a hole."""
    shared = coded.sparkSession.sparkContext.broadcast(model.class_of)

    def run(batches):
        for part, at, many in sequences(batches):
            pos = np.flatnonzero(at < 0)
            row = np.repeat(np.arange(len(many)), many)[pos - 1]
            c = (pos.astype(np.int32), flat(part.column("rare"), np.int64)[0], shared.value[at[pos - 1]].astype(np.int32), shared.value[at[pos + 1]].astype(np.int32))
            own = part.select(["row_id", "trained"]).take(pa.array(row))
            yield pa.RecordBatch.from_arrays([*own.columns, *map(pa.array, c)], names=["row_id", "trained", "pos", "hash", "left", "right"])

    rare = coded.where(F.octet_length("rare") > 0).select("row_id", "trained", "ids", "rare")
    return materialize(rare.mapInArrow(run, "row_id long, trained boolean, pos int, hash long, left int, right int"), "lm-holes")


def place(found: DataFrame, model: Model, between: np.ndarray) -> DataFrame:
    """(hash, class, c) of the words that fill the holes of trained texts, by their neighbours that have a class."""
    classes, total = model.classes, model.classes + 2
    shared = found.sparkSession.sparkContext.broadcast(between)
    mover: list[Mover] = []

    def run(rows: pa.RecordBatch):
        if not mover:
            mover.append(Mover(shared.value, classes))
        node, left, right = (rows.column(x).to_numpy() for x in ("node", "left", "right"))
        word, count = np.unique(node, return_counts=True)
        best = (word % classes).astype(np.int32)
        k = np.searchsorted(word, node)  # keys of hashes would not fit 64 bits
        key = np.concatenate([(k * 2 * total + right)[right != classes], (k * 2 * total + total + left)[left != classes]])
        if len(key):
            key, n = np.unique(key, return_counts=True)
            moved, to = mover[0].best(key // (2 * total), key % (2 * total), n.astype(float), np.full(len(key), classes))
            best[moved] = to
        yield pa.record_batch({"hash": pa.array(word), "class": pa.array(best), "c": pa.array(count.astype(np.int64))})

    trained = found.where("trained").select(F.col("hash").alias("node"), "left", "right")
    return materialize(by_node(trained, run, "hash long, class int, c long"), "lm-others")


def fill(found: DataFrame, others: DataFrame, model: Model) -> DataFrame:
    """(row_id, trained, left, own, right, c) of holes with the classes of their words; left is filled, right is that of a hole for a hole."""
    far = model.classes

    def run(batches):
        last = (-1, -1, far)
        for batch in batches:
            if not batch.num_rows:
                continue
            row, pos, left, own = (batch.column(x).to_numpy() for x in ("row_id", "pos", "left", "own"))
            before = np.r_[last[2], own[:-1]]
            follows = (np.r_[last[0], row[:-1]] == row) & (np.r_[last[1], pos[:-1]] == pos - 1)
            left = np.where((left == far) & follows, before, left).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("row_id"), batch.column("trained"), pa.array(left), *(batch.column(x) for x in ("own", "right", "c"))], names=["row_id", "trained", "left", "own", "right", "c"])
            last = int(row[-1]), int(pos[-1]), int(own[-1])

    told = found.join(others, "hash", "left").select("row_id", "trained", "pos", "left", F.coalesce("class", F.lit(far)).alias("own"), "right", F.coalesce("c", F.lit(0)).cast("long").alias("c"))
    told = told.repartition("row_id").sortWithinPartitions("row_id", "pos")
    return materialize(told.mapInArrow(run, "row_id long, trained boolean, left int, own int, right int, c long"), "lm-filled")


def learn(coded: DataFrame, model: Model, *, clustered: int = CLUSTERED, classes: int | None = None, sweeps: int = SWEEPS) -> tuple[DataFrame, DataFrame]:
    """Classes and probabilities into the model, from the trained rows of coded; returns (others, filled holes of all rows)."""
    texts, words = coded.where("trained"), len(model.counts)
    model.classes = classes = classes or max(CLASSES, round(model.distinct ** (1 / 3)))
    far, total, n = classes, classes + 2, min(clustered, words)
    # Classes of words, then that of unseen words, which also stands for holes, then the end's.
    class_of = np.full(words + 1, far, np.int64)
    class_of[0] = far + 1
    if n > 1:
        symbol = np.append(np.minimum(np.arange(words), n), n)  # all but the first words are one symbol
        counts = class_pairs(texts, symbol, n + 1)
        turned = np.r_[1:n, n, 0]
        class_of[1:n] = exchange(counts[np.ix_(turned, turned)], np.array([far, far + 1]), classes)
    for number in range(sweeps if words > n else 0):
        class_of = sweep(texts, model, class_of, 1 if number else n)
        lost = np.flatnonzero(class_of[:-1] == far)
        class_of[lost] = lost % classes
    model.class_of = class_of
    between = class_pairs(texts, class_of, total)
    found = holes(coded, model)
    others = place(found, model, between)
    filled = fill(found, others, model)
    between[far], between[:, far] = 0, 0
    mine = filled.where("trained")
    for pair in (mine.select("left", F.col("own").alias("right")), mine.where(F.col("right") != far).select(F.col("own").alias("left"), "right")):
        for r in pair.groupBy("left", "right").count().collect():
            between[r["left"], r["right"]] += r["count"]
    model.next = np.log10((between + SMOOTH) / (between.sum(axis=1, keepdims=True) + SMOOTH * total))
    # Tokens and distinct words of each class.
    heads = np.bincount(class_of[:-1], weights=model.counts, minlength=total)
    kinds = np.bincount(class_of[:-1], minlength=total).astype(float)
    for r in others.groupBy("class").agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("n")).collect():
        heads[r["class"]] += r["c"]
        kinds[r["class"]] += r["n"]
    model.mass = heads + SMOOTH * (kinds + 1)
    model.base_mass = model.size + SMOOTH * (model.distinct + 1)
    return others, filled


def train(
    docs: DataFrame, *, text: str = "text", clustered: int = CLUSTERED, classes: int | None = None, looked_up: int = LOOKED_UP, sweeps: int = SWEEPS
) -> tuple[Model, DataFrame]:
    """The model of the rows of docs, and the table (hash, class, c) of their words that the look-up table lacks."""
    model = vocabulary(docs, text=text, looked_up=looked_up)
    coded = encode(docs, model, F.lit(True), doc_id=text, text=text)
    return model, learn(coded, model, clustered=clustered, classes=classes, sweeps=sweeps)[0]


def score(docs: DataFrame, model: Model, others: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, n_known, base_score and score of every row, whole texts."""
    coded = encode(docs, model, F.lit(False), doc_id=doc_id, text=text)
    return score_coded(coded, model, fill(holes(coded, model), others, model))


def train_and_score(docs: DataFrame, held_out: Column, *, doc_id: str = "doc_id", text: str = "text") -> tuple[Model, DataFrame]:
    """The model of the rows of docs that are not held out, and the scores of all rows; each text is encoded once."""
    model = vocabulary(docs.where(~held_out), text=text)
    coded = encode(docs, model, ~held_out, doc_id=doc_id, text=text)
    return model, score_coded(coded, model, learn(coded, model)[1])


def score_coded(coded: DataFrame, model: Model, filled: DataFrame) -> DataFrame:
    """doc_id, n_tokens, n_known, base_score and score of every row of coded."""
    far = model.classes
    counts = np.r_[model.counts, 0]
    emit, base = np.log10((counts + SMOOTH) / model.mass[model.class_of]), np.log10((counts + SMOOTH) / model.base_mass)
    emit[-1] = base[-1] = 0  # a hole adds nothing until it is filled
    following = model.next.copy()
    following[far], following[:, far] = 0, 0
    shared = coded.sparkSession.sparkContext.broadcast((model.class_of, emit, base, following))
    small = coded.sparkSession.sparkContext.broadcast((model.next, model.mass, model.base_mass))

    def run(batches):
        class_of, emit, base, following = shared.value
        for batch, at, many in sequences(batches):
            starts = np.cumsum(many) - many
            c = class_of[at]
            own = at[1:]
            sums = (np.add.reduceat(x, starts) for x in ((own >= 0).astype(np.int64), base[own], following[c[:-1], c[1:]] + emit[own]))
            known, b, s = map(pa.array, sums)
            yield pa.RecordBatch.from_arrays([batch.column("row_id"), batch.column("doc_id"), pa.array(many.astype(np.int64)), known, b, s], names=["row_id", "doc_id", "n_tokens", "n_known", "b", "s"])

    def late(batches):
        following, mass, base_mass = small.value
        for batch in batches:
            left, own, right, c = (batch.column(x).to_numpy() for x in ("left", "own", "right", "c"))
            s = following[left, own] + np.where(right == far, 0, following[own, right]) + np.log10((c + SMOOTH) / mass[own])
            b = np.log10((c + SMOOTH) / base_mass)
            yield pa.RecordBatch.from_arrays([batch.column("row_id"), pa.array((c > 0).astype(np.int64)), pa.array(b), pa.array(s)], names=["row_id", "known", "b2", "s2"])

    kind = coded.schema["doc_id"].dataType.simpleString()
    whole = coded.select("row_id", "doc_id", "ids").mapInArrow(run, f"row_id long, doc_id {kind}, n_tokens long, n_known long, b double, s double")
    sums = filled.select("row_id", "left", "own", "right", "c").mapInArrow(late, "row_id long, known long, b2 double, s2 double")
    sums = sums.groupBy("row_id").agg(*[F.sum(x).alias(x) for x in ("known", "b2", "s2")])
    add = lambda a, b, to: (F.col(a) + F.coalesce(b, F.lit(0))).alias(to)
    return whole.join(sums, "row_id", "left").select("doc_id", "n_tokens", add("n_known", "known", "n_known"), add("b", "b2", "base_score"), add("s", "s2", "score"))
