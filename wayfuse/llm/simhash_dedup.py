"""SimHash near-duplicates by anchor points of a covering code.

Fingerprints have 64 bits and link at up to 3 differing bits. Of two linked
fingerprints, one 32-bit half differs in at most one bit, so each half is
covered on its own: its anchors are the words of the (31, 26) Hamming code with
one free bit, a code of covering radius 1. A half lies within 1 of exactly one
anchor, its home, and every half within 1 of it lies within 1 + 1 = 2 of that
home. Each fingerprint is therefore sent to every anchor within 2 of either
half, 2 to 17 of each, and compared at the anchors with fingerprints at home
there. Equal fingerprints are one node, so copies are never paired.

The same anchors serve texts that share most of their longer shingles
(similar_groups). Fingerprints of their shingles differ in too many bits for any
covering that stays selective, so several fingerprints of the set of words, of
which an edit changes fewer, bring them to an anchor: one half of one of them has
to be within one bit. There they are compared by that fingerprint and by 256 bits
of the set of shingles, whose differing bits estimate the similarity.

An anchor with many fingerprints is cut into blocks that are compared block by
block, so no task holds more than two blocks; from a block pair come only the
links of a spanning forest, which keep every component and grow with the
block's rows, not with their pairs.

Defined results: a null text has no words; without words the fingerprint is
zero and is linked like any other; with one or two words the one shingle is the
whole sequence; a null id is a node of its own fingerprint and smallest in no
component that has an id; repeated rows are returned as often as they occur.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import MET, map_batches, materialize, meeting, row_keyed, words_of

SEED = 42
SHINGLE = 3
THRESHOLD = 3
#: Fingerprints of an anchor that are compared at once.
BLOCK = 2048
#: For texts of a similarity of 0.8 or more on shingles of five words: fingerprints of the words and as many of the shingles, bits that one
#: of the words may differ in, and bits that those of the shingles may differ in together, of which 39 are expected at 0.8 and 33 at 0.85.
SIMILAR_SHINGLE, PRINTS, WIDE, APART = 5, 4, 12, 48


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """Majority of the bits of the XXH64 of each shingle; 0 without words."""
    words = words_of(text.lower()) if text else []
    return majority(shingle_hashes(words, shingle)) if words else 0


def shingle_hashes(words: list[bytes], shingle: int) -> np.ndarray:
    """XXH64 of each shingle, repeats included; of all words where there are fewer."""
    if len(words) < shingle:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), SEED)]
    else:
        line = b" ".join(words)
        ends = np.cumsum([len(w) + 1 for w in words]) - 1
        starts = np.concatenate(([0], ends[: len(words) - shingle] + 1)).tolist()
        hash64 = xxhash.xxh64_intdigest
        hashes = [hash64(line[a:b], SEED) for a, b in zip(starts, ends[shingle - 1 :].tolist(), strict=True)]
    return np.array(hashes, dtype=np.uint64)


def majority(hashes: np.ndarray) -> int:
    """Bits set in over half the hashes."""
    counts = np.zeros(64, np.int64)
    values = hashes.astype(">u8").view(np.uint8).reshape(-1, 8)
    for at in range(0, len(values), 1 << 16):  # bounded memory for a text of any length
        counts += np.unpackbits(values[at : at + (1 << 16)], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes)).tobytes(), "big")


def set_prints(text: bytes | None, shingle: int = SIMILAR_SHINGLE, prints: int = PRINTS) -> tuple[list[int], list[int]]:
    """Fingerprints of the set of words and of that of shingles; all zero without words."""
    words = words_of(text.lower()) if text else []
    if not words:
        return [0] * prints, [0] * prints
    single = np.array([xxhash.xxh64_intdigest(w, SEED) for w in set(words)], np.uint64)
    return mixed_prints(single, prints), mixed_prints(np.unique(shingle_hashes(words, shingle)), prints)


def mixed_prints(own: np.ndarray, prints: int) -> list[int]:
    """Fingerprints of the hashes, mixed with another number for each."""
    out = []
    with np.errstate(over="ignore"):
        for i in range(prints):
            h = own + np.uint64((i * 0x9E3779B97F4A7C15) % (1 << 64))
            h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            out.append(majority(h ^ (h >> np.uint64(31))))
    return out


def fingerprints(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """doc_id and fingerprint (a signed long) of every row."""
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(table: pa.Table) -> pa.Table:
        texts = table.column("text").cast(pa.large_binary()).to_pylist()
        found = np.array([fingerprint(t, shingle) for t in texts], dtype=np.uint64).view(np.int64)
        return pa.table({"doc_id": table.column("doc_id"), "fp": pa.array(found)})

    return map_batches(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")), run, f"doc_id {kind}, fp long")


def _syndrome(half: np.ndarray) -> np.ndarray:
    """Of the (31, 26) Hamming code; a flipped bit b alone gives b + 1."""
    found = np.zeros(len(half), np.uint32)
    for b in range(31):
        found ^= ((half >> np.uint32(b)) & np.uint32(1)) * np.uint32(b + 1)
    return found


def anchors_of(half: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index into half, anchor, whether it is the home) of every anchor within 2 of each 32-bit word."""
    half = half.astype(np.uint32)
    syndrome = _syndrome(half)
    flip = np.where(syndrome > 0, np.uint32(1) << np.maximum(syndrome, 1).astype(np.uint32) - np.uint32(1), np.uint32(0)).astype(np.uint32)
    home = half ^ flip
    every = np.arange(len(half))
    free = np.uint32(1 << 31)
    out = [(every, home, True), (every, home ^ free, False)]
    off = np.flatnonzero(syndrome > 0)  # a code word itself has no other within 2
    for b in range(1, 32):  # two flips a < b whose syndromes cancel this one
        other = syndrome[off] ^ np.uint32(b)
        at = off[(other > b)]
        if len(at):
            a = other[other > b]
            out.append((at, half[at] ^ (np.uint32(1) << np.uint32(b - 1)) ^ (np.uint32(1) << (a - np.uint32(1))), False))
    return (
        np.concatenate([i for i, _, _ in out]),
        np.concatenate([a for _, a, _ in out]),
        np.concatenate([np.full(len(i), h) for i, _, h in out]),
    )


def _covered(columns: list[str]):
    """(key, entered, node): each node at the anchors of every half of its fingerprints, entered at home; the key names anchor, half and fingerprint."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                node, keys, own, homes = part.column("node").to_numpy(), [], [], []
                for number, name in enumerate(columns):
                    prints = part.column(name).to_numpy().view(np.uint64)
                    for side in (0, 1):
                        index, anchor, home = anchors_of((prints >> np.uint64(32 * side)).astype(np.uint32))
                        keys.append((anchor.astype(np.int64) * 2 + side) * len(columns) + number)
                        own.append(node[index])
                        homes.append(home)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (keys, homes, own)], names=["key", "entered", "node"])

    return run


def near_rows(a: list[np.ndarray], b: list[np.ndarray], limits: list[int]) -> np.ndarray:
    """For every row of a and b whether the first column differs in at most as many bits as the first limit says, and the others together as the second."""
    near = np.bitwise_count(a[0][:, None] ^ b[0][None]) <= limits[0]
    if len(a) > 1:
        near &= sum(np.bitwise_count(x[:, None] ^ y[None]).astype(np.uint16) for x, y in zip(a[1:], b[1:], strict=True)) <= limits[1]
    return near


def forest(a: list[np.ndarray], b: list[np.ndarray], limits: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Places (in a, in b) of links of a spanning forest of the graph in which near rows of a and b are joined.

    A breadth-first search over both sides; each row and each column of the
    distances is worked out once, and a node enters by one link.
    """
    left, right = [], []
    open_a, open_b = np.ones(len(a[0]), bool), np.ones(len(b[0]), bool)
    step = max(1, (1 << 21) // max(1, len(open_a), len(open_b)))
    for seed in range(len(open_a)):
        if not open_a[seed]:
            continue
        open_a[seed] = False
        front, from_a = np.array([seed]), True
        while len(front):
            mine, theirs, still = (a, b, open_b) if from_a else (b, a, open_a)
            found = []
            for at in range(0, len(front), step):
                rest = np.flatnonzero(still)
                if not len(rest):
                    break
                part = front[at : at + step]
                near = near_rows([x[part] for x in mine], [y[rest] for y in theirs], limits)
                hit = np.flatnonzero(near.any(axis=0))
                via = part[near[:, hit].argmax(axis=0)]
                still[rest[hit]] = False
                found.append(rest[hit])
                left.append(via if from_a else rest[hit])
                right.append(rest[hit] if from_a else via)
            front, from_a = (np.concatenate(found) if found else np.array([], int)), not from_a
    none = np.array([], int)
    return (np.concatenate(left), np.concatenate(right)) if left else (none, none)


def links_at_anchors(nodes: DataFrame, *, prints: list[str], limit: int = THRESHOLD, checks: list[str] | None = None, apart: int = 0, block: int = BLOCK) -> DataFrame:
    """Links (a, b) between rows of nodes (node, *prints, *checks) that leave the components of all such links as they are.

    Two nodes meet if a half of one of their prints differs in one bit at most,
    which is so for all that differ in up to 3 bits. They link if this print
    differs in at most limit bits and the columns of checks in at most apart together.
    """
    checks = checks or []
    covered = nodes.select("node", *prints).mapInArrow(_covered(prints), MET)
    covered = covered.repartition("key").sortWithinPartitions("key", F.col("entered").desc(), "node")
    met = materialize(covered.mapInArrow(meeting, MET), "simhash-met")
    parts = met.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("parts"))
    met = met.join(materialize(parts, "simhash-anchors"), "key").join(nodes, "node")
    which = F.pmod("key", F.lit(len(prints)))
    shown = F.element_at(F.array(*prints), which.cast("int") + 1).alias("print")
    met = met.select("key", "entered", "node", "parts", shown, *checks)
    own = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    homes = met.where("entered").select("key", own.alias("i"), every.alias("j"), "node", "print", *checks, F.lit(True).alias("home"))
    guests = met.select("key", every.alias("i"), own.alias("j"), "node", "print", *checks, F.lit(False).alias("home"))
    keys = ["key", "i", "j"]

    def compare(table: pa.Table, cuts: np.ndarray) -> pa.RecordBatch:
        node, home = table.column("node").to_numpy(), table.column("home").to_numpy()
        columns = [table.column(c).to_numpy().view(np.uint64) for c in ("print", *checks)]
        found = [(np.array([], np.int64),) * 2]
        for start, stop in zip(cuts[:-1], cuts[1:], strict=True):
            here = start + np.flatnonzero(home[start:stop])
            there = start + np.flatnonzero(~home[start:stop])
            if len(here) and len(there):
                x, y = forest([c[here] for c in columns], [c[there] for c in columns], [limit, apart])
                found.append((node[here[x]], node[there[y]]))
        a, b = map(np.concatenate, zip(*found, strict=True))
        return pa.record_batch({"a": pa.array(np.minimum(a, b)[a != b]), "b": pa.array(np.maximum(a, b)[a != b])})

    def run(batches):
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = (pa.concat_tables([held, table]) if held is not None else table).combine_chunks()
            cols = [held.column(k).to_numpy() for k in keys]
            change = np.flatnonzero(np.any([c[1:] != c[:-1] for c in cols], axis=0)) + 1
            if len(change):  # the last key may go on in the next batch
                yield compare(held.slice(0, int(change[-1])), np.concatenate(([0], change)))
                held = held.slice(int(change[-1]))
        if held is not None and held.num_rows:
            yield compare(held, np.array([0, held.num_rows]))

    dealt = homes.unionByName(guests).repartition(*keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(run, "a long, b long").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node of the component of every node that has a link.

    Alternating large-star and small-star rounds; a round is one grouping by
    node with partial minima and one join, written out, and ends when a round
    leaves the links as they were.
    """

    def star(edges: DataFrame, small: bool) -> DataFrame:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        seen = both.where("v < u") if small else both
        low = materialize(seen.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "components-low")
        joined = seen.join(low, "u")
        out = joined.where("v <> m" if small else "v > u").select(F.col("m").alias("a"), F.col("v").alias("b"))
        if small:
            out = out.unionByName(low.where("u <> m").select(F.col("m").alias("a"), F.col("u").alias("b")))
        return materialize(out.where("a <> b").distinct(), "components-star")

    def mark(edges: DataFrame) -> tuple:
        return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a").cast("decimal(38,0)"))).first())

    edges = materialize(links.where("a <> b"), "components-links")
    before = mark(edges)
    while before[0]:
        edges = star(star(edges, False), True)
        now = mark(edges)
        if now == before:
            break
        before = now
    roots = edges.groupBy("b").agg(F.min("a").alias("root")).withColumnRenamed("b", "node")
    return roots.unionByName(edges.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())


def near_groups(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", row_id: str | None = None, shingle: int = SHINGLE, threshold: int = THRESHOLD) -> DataFrame:
    """One row per row of docs: doc_id, fp, component_id, and row_id and kept if row_id names the column that numbers the rows."""
    if not 0 <= threshold <= 3:
        raise ValueError("the covering is for thresholds of 0 to 3 bits")
    frame = docs.select(F.struct(F.col(doc_id).alias("doc_id"), F.col(row_id or doc_id).alias("row_id")).alias("doc_id"), F.col(text).alias("text"))
    rows = fingerprints(frame, shingle=shingle).select("doc_id.doc_id", "doc_id.row_id", F.col("fp").alias("node"))
    found = _grouped(rows if row_id else rows.drop("row_id"), [], lambda nodes: links_at_anchors(nodes.withColumn("fp", F.col("node")), prints=["fp"], limit=threshold))
    return found.withColumnRenamed("node", "fp")


def similar_groups(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", row_id: str, shingle: int = SIMILAR_SHINGLE) -> DataFrame:
    """doc_id, node, component_id, row_id and kept of every row of docs; texts link if they share, as far as fingerprints tell, 0.8 of their shingles."""
    kinds = {c: docs.schema[c].dataType.simpleString() for c in (doc_id, row_id)}
    prints, shown = [f"f{i}" for i in range(PRINTS)], [f"s{i}" for i in range(PRINTS)]

    def run(table: pa.Table) -> pa.Table:
        texts = table.column("text").cast(pa.large_binary()).to_pylist()
        found = np.array([sum(set_prints(t, shingle), []) for t in texts], dtype=np.uint64).reshape(-1, 2 * PRINTS)
        node = np.array([xxhash.xxh64_intdigest(x.tobytes()) for x in found], dtype=np.uint64)
        columns = {name: pa.array(x.view(np.int64)) for name, x in zip(["node", *prints, *shown], [node, *np.ascontiguousarray(found.T)], strict=True)}
        return pa.table({"doc_id": table.column("doc_id"), "row_id": table.column("row_id")} | columns)

    frame = docs.select(F.col(doc_id).alias("doc_id"), F.col(row_id).alias("row_id"), F.col(text).cast("string").alias("text"))
    rows = map_batches(frame, run, f"doc_id {kinds[doc_id]}, row_id {kinds[row_id]}, node long, " + ", ".join(f"{p} long" for p in [*prints, *shown]))
    return _grouped(rows, [*prints, *shown], lambda nodes: links_at_anchors(nodes, prints=prints, limit=WIDE, checks=shown, apart=APART))


def _grouped(rows: DataFrame, shown: list[str], links) -> DataFrame:
    """doc_id, node, component_id, and row_id and kept if rows has row_id; links are made between nodes (node, *shown)."""
    rows = materialize(rows, "simhash-rows")
    numbered = "row_id" in rows.columns
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", *(["row_id"] if numbered else []))).alias("first")
    nodes = materialize(rows.groupBy("node").agg(first, *[F.min(c).alias(c) for c in shown]), "simhash-nodes")
    roots = materialize(components(links(nodes.select("node", *shown))), "simhash-roots")
    told = materialize(nodes.join(roots, "node", "left").select("node", "first", F.coalesce("root", "node").alias("root")), "simhash-told")
    lowest = materialize(told.groupBy("root").agg(F.min("first").alias("first")), "simhash-lowest")  # so that a join with a large group can be split
    named = materialize(told.select("node", "root").join(lowest, "root").select("node", "first"), "simhash-named")
    out = ["doc_id", "node", F.col("first.doc_id").alias("component_id")]
    if numbered:
        out += ["row_id", (F.col("row_id") == F.col("first.row_id")).alias("kept")]
    return rows.join(named, "node").select(*out)


def drop_near_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The first row (smallest id, then input order) of each component of similar texts, with all columns of docs."""
    named, row = row_keyed(docs, doc_id, "simhash-input")
    fates = similar_groups(named, doc_id=doc_id, text=text, row_id=row)
    dropped = materialize(fates.where(~F.col("kept")).select(F.col("row_id").alias(row)), "simhash-dropped")
    return named.join(dropped, row, "left_anti").drop(row)
