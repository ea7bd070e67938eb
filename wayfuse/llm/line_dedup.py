"""Near-duplicate lines by a segment-partition edit join.

Lines within MAX_EDITS edits are links. A line is split into MAX_EDITS + 1
segments; of two linked lines the longer holds a segment of the shorter whole,
near its place. Distinct lines are entered under (length, segment number,
segment) and probe, for each length they may meet, the few substrings that the
position and length difference leave possible. Lines that meet are verified by
a bit-parallel edit distance within the band, in blocks.

Equal lines are one node, so copies are never paired. A line of MAX_EDITS
characters or fewer has an empty segment, which every line of a length that it
may link to holds: such lines are all compared. A key under which many lines
meet is cut into blocks that are compared block by block; what their characters
alone tell apart is not compared further. Two lines may meet under several keys
and are a link under the first of them only, so links are counted where they are
found: out of a block come the counts of its lines and a spanning forest of its
links, which grow with its lines and not with their pairs.

Defined results: a null text has no lines; white space at the ends of a line is
not compared and an empty line is never a duplicate; of a class the line that
comes first by (document, row, line number) stays; a null id comes last; repeated
rows are documents of their own; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import MET, WHITE, materialize, meeting, row_keyed, text_or_empty
from .simhash_dedup import components

MAX_EDITS = 2
BLOCK = 512
#: Bins that characters are counted in; blocks of fewer pairs are compared without.
BINS, FEW = 64, 16
#: Up to so many lines that meet another are broadcast, by their 8-byte hashes, to pick their texts; beyond it they are joined by shuffle.
BROADCAST_NODES = 200_000


def segments(length: int, parts: int) -> list[tuple[int, int]]:
    """(start, size) of even segments; the longer ones come last."""
    small, more = divmod(length, parts)
    out, at = [], 0
    for i in range(parts):
        size = small + (i >= parts - more)
        out.append((at, size))
        at += size
    return out


def probes(length: int, other: int, edits: int) -> list[tuple[int, int, int]]:
    """(segment number, start, size) of the substrings of a line that may equal a segment of a line of another, not larger, length."""
    out, gap = [], length - other
    for i, (at, size) in enumerate(segments(other, edits + 1)):
        low = max(0, at - i, at + gap - (edits - i))
        high = min(length - size, at + i, at + gap + (edits - i))
        out += [(i, p, size) for p in range(low, high + 1)]
    return out


def edit_distance(a: str, b: str, most: int) -> int:
    """Edits that turn a into b, or most + 1 if they are more: bit-parallel over a band of 2 * most + 1 diagonals.

    One word of bits per number of edits is carried along a: bit j is set if what
    was read of a becomes the first j characters of b with so many edits. Bits
    more than most off the diagonal are masked out.
    """
    if abs(len(a) - len(b)) > most:
        return most + 1
    start = 0
    limit = min(len(a), len(b))
    while start < limit and a[start] == b[start]:
        start += 1
    stop = 0
    while stop < limit - start and a[-1 - stop] == b[-1 - stop]:
        stop += 1
    a, b = a[start : len(a) - stop], b[start : len(b) - stop]
    if not a or not b:
        return max(len(a), len(b))
    where: dict[str, int] = {}
    for j, c in enumerate(b):
        where[c] = where.get(c, 0) | 1 << j
    # states[e]: bit j set if some prefix of a read so far becomes b[:j] with e edits
    full = (1 << len(b) + 1) - 1
    states = [(1 << e + 1) - 1 for e in range(most + 1)]
    for i, c in enumerate(a):
        band = full if len(b) <= 4 * most else ((1 << i + most + 2) - 1) & ~((1 << max(0, i + 1 - most)) - 1) & full
        hit, new = where.get(c, 0), []
        for e, state in enumerate(states):
            now = (state & hit) << 1
            if e:  # replace, delete from a, insert into a
                now |= states[e - 1] << 1 | states[e - 1] | new[-1] << 1
            new.append(now & band)
        states = new
        if not any(states):
            return most + 1
    last = 1 << len(b)
    for e, state in enumerate(states):
        if state & last:
            return e
    return most + 1


def split_lines(docs: DataFrame, *own, text: str = "text") -> DataFrame:
    """(*own, line_no, line) of every line, white space at its ends cut off; line is null where nothing is left, and a row without text has one such line."""
    held = docs.select(*own, text_or_empty(text).alias("__text"))  # a row is numbered before it becomes several
    lines = held.select(*held.columns[:-1], F.posexplode(F.split("__text", "\n")).alias("line_no", "line"))
    return lines.withColumn("line", F.nullif(F.btrim("line", F.lit(WHITE)), F.lit("")))


@lru_cache(maxsize=4096)
def plan(length: int, edits: int) -> tuple[tuple[str, int, int], ...]:
    """(what goes before the substring in its key, start, end) of a line's own segments, then of the substrings that it probes with."""
    own = segments(length, edits + 1)
    places = [(f"{length},{i},", at, at + size) for i, (at, size) in enumerate(own)]
    for other in range(max(1, length - edits), length + 1):
        for i, at, size in probes(length, other, edits):
            if other < length or at != own[i][0]:  # else it is met as an entry
                places.append((f"{other},{i},", at, at + size))
    return tuple(places)


def first_key(entry: str, guest: str, edits: int) -> int:
    """The key under which an entry and a guest that link are a link: the first that they share."""
    own = segments(len(entry), edits + 1)
    for i, at, size in probes(len(guest), len(entry), edits):
        start = own[i][0]
        if guest[at : at + size] == entry[start : start + size]:
            return xxhash.xxh64_intdigest(f"{len(entry)},{i},{guest[at : at + size]}")
    return -1


def _key_rows(edits: int):
    """(key, entered, node) of the lines of texts; a line is taken once a batch."""

    def run(batches):
        hash64 = xxhash.xxh64_intdigest
        for batch in batches:
            seen: set[str] = set()
            for text in batch.column("text").to_pylist():
                if text:
                    seen.update(y.strip(WHITE) for y in text.split("\n"))
            seen.discard("")
            lines = list(seen)
            for at in range(0, len(lines), 20_000):
                part = lines[at : at + 20_000]
                plans = [plan(len(line), edits) for line in part]
                keys = [hash64(before + line[a:b]) for line, places in zip(part, plans, strict=True) for before, a, b in places]
                many = np.fromiter(map(len, plans), np.int64, len(part))
                node = np.repeat(np.array([hash64(line, 42) for line in part], np.uint64).view(np.int64), many)
                entry = np.arange(len(node)) - np.repeat(np.cumsum(many) - many, many) <= edits
                yield pa.RecordBatch.from_arrays([pa.array(np.array(keys, np.uint64).view(np.int64)), pa.array(entry), pa.array(node)], names=["key", "entered", "node"])

    return run


def alike(left: list[str], right: list[str], edits: int) -> list[tuple[int, int]]:
    """Places of pairs that lengths and counts of characters do not tell apart."""
    if len(left) * len(right) <= FEW:
        return [(i, j) for i, x in enumerate(left) for j, y in enumerate(right) if 0 <= len(y) - len(x) <= edits]
    bins = []
    for lines in (left, right):
        counts = np.zeros((len(lines), BINS), np.int32)
        for i, line in enumerate(lines):
            np.add.at(counts[i], np.frombuffer(line.encode("utf-32-le"), np.uint32) % BINS, 1)
        bins.append(counts)
    a, b = (np.array([len(x) for x in lines]) for lines in (left, right))
    out: list[tuple[int, int]] = []
    step = max(1, (1 << 22) // (BINS * len(right)))
    for at in range(0, len(left), step):
        far = np.abs(bins[0][at : at + step, None] - bins[1][None]).sum(axis=2)  # an edit changes two counts at most
        more = b[None] - a[at : at + step, None]
        i, j = np.nonzero((far <= 2 * edits) & (more >= 0) & (more <= edits))
        out += zip((i + at).tolist(), j.tolist(), strict=True)
    return out


def block_links(key: int, rows: list[tuple[int, str, bool]], edits: int) -> list[tuple[int, int]]:
    """Links between entries and guests (node, line, entered) of a block whose key is the one that they count under."""
    entries, guests = dict((n, x) for n, x, e in rows if e), dict((n, x) for n, x, e in rows if not e)
    left, right, out = list(entries.items()), list(guests.items()), []
    for i, j in alike([x for _, x in left], [x for _, x in right], edits):
        (n, x), (m, y) = left[i], right[j]
        if n != m and (len(x) < len(y) or n < m) and edit_distance(x, y, edits) <= edits and first_key(x, y, edits) == key % (1 << 64):
            out.append((n, m))
    return out


def _blocks(edits: int, emit):
    """emit over the links of each block of rows sorted by (key, i, j)."""

    def run(batches):
        held, key = [], None
        for batch in batches:
            links = []
            cols = [batch.column(c).to_pylist() for c in ("key", "i", "j", "node", "line", "entered")]
            for k, i, j, node, line, entered in zip(*cols, strict=True):
                if (k, i, j) != key:
                    links += emit(block_links(key[0], held, edits)) if key else []
                    held, key = [], (k, i, j)
                held.append((node, line, entered))
            yield links_batch(links)
        yield links_batch(emit(block_links(key[0], held, edits)) if key else [])

    return run


def links_batch(rows: list[tuple[int, int | None, int]]) -> pa.RecordBatch:
    a, b, n = zip(*rows, strict=True) if rows else ([], [], [])
    return pa.record_batch({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "n": pa.array(n, pa.int64())})


def summed(links: list[tuple[int, int]]) -> list[tuple[int, int | None, int]]:
    """Of the links of a block: (node, null, how many it has), and those of a spanning forest as (a, b, 0)."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = x = root[root[x]]
        return x

    many, out = Counter(x for pair in links for x in pair), []
    for a, b in links:
        x, y = find(a), find(b)
        if x != y:
            root[max(x, y)] = min(x, y)
            out.append((a, b, 0))
    return [*((x, None, n) for x, n in many.items()), *out]


def _linked(docs: DataFrame, text: str, edits: int, block: int, emit) -> DataFrame:
    texts = docs.select(F.col(text).cast("string").alias("text"))
    keyed = texts.mapInArrow(_key_rows(edits), MET)
    keyed = keyed.repartition("key").sortWithinPartitions("key", F.col("entered").desc(), "node")
    met = materialize(keyed.mapInArrow(meeting, MET), "line-met")
    nodes = materialize(met.select("node").distinct(), "line-nodes")
    lines = split_lines(docs, text=text).where("line is not null").select(F.xxhash64("line").alias("node"), "line")
    few = nodes.count() <= BROADCAST_NODES
    lines = lines.join(F.broadcast(nodes) if few else nodes, "node", "left_semi").groupBy("node").agg(F.min("line").alias("line"))
    lines = materialize(lines, "line-texts")
    parts = met.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("parts"))
    met = met.join(materialize(parts, "line-parts"), "key").join(lines, "node")
    own = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    entries = met.where("entered").select("key", own.alias("i"), every.alias("j"), "node", "line", F.lit(True).alias("entered"))
    guests = met.select("key", every.alias("i"), own.alias("j"), "node", "line", F.lit(False).alias("entered"))
    dealt = entries.unionByName(guests).repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return dealt.mapInArrow(_blocks(edits, emit), "a long, b long, n long")


def edit_links(docs: DataFrame, *, text: str = "text", edits: int = MAX_EDITS, block: int = BLOCK) -> DataFrame:
    """(a, b), a < b, hashes of every two different lines of docs within the edits. Among many lines that are all alike there are as many links as pairs."""
    return _linked(docs, text, edits, block, lambda links: [(min(x), max(x), 1) for x in links]).select("a", "b")


def dedup_lines(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", row_id: str | None = None, edits: int = MAX_EDITS, block: int = BLOCK) -> DataFrame:
    """What becomes of every line: row_id, doc_id, line_no, line_id, class_id, n_links, duplicate; an empty line has no line_id and no class_id.

    line_id names the line's text; class_id is the smallest line_id of the
    component of links that the line is in, its own without a link; n_links is
    how many other texts it links to; duplicate is true unless it is the first
    line of its class.
    """
    number = (F.col(row_id) if row_id else F.monotonically_increasing_id()).alias("row_id")
    node = F.when(F.col("line").isNotNull(), F.xxhash64("line")).alias("node")
    lines = split_lines(docs, number, F.col(doc_id).alias("doc_id"), text=text).select("row_id", "doc_id", "line_no", node)
    lines = materialize(lines, "line-rows")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_id", "line_no")).alias("first")
    starts = materialize(lines.where("node is not null").groupBy("node").agg(first), "line-starts")
    found = materialize(_linked(docs, text, edits, block, summed), "line-links")
    many = found.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n_links"))
    fates = starts.join(many, "node", "left").join(components(found.where("b is not null").select("a", "b")), "node", "left")
    fates = materialize(fates.select("node", F.coalesce("root", "node").alias("class_id"), "first", F.coalesce("n_links", F.lit(0)).alias("n_links")), "line-fates")
    linked = materialize(fates.where("n_links > 0").groupBy("class_id").agg(F.min("first").alias("opening")), "line-openings")
    fates = fates.join(linked, "class_id", "left").select("node", "class_id", "n_links", F.coalesce("opening", "first").alias("opening"))
    joined = lines.join(fates, "node", "left")
    stays = (F.col("row_id") == F.col("opening.row_id")) & (F.col("line_no") == F.col("opening.line_no"))
    return joined.select("row_id", "doc_id", "line_no", F.col("node").alias("line_id"), "class_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), (F.col("node").isNotNull() & ~stays).alias("duplicate"))


def per_document(fates: DataFrame) -> DataFrame:
    """doc_id, n_lines (that are not empty), n_duplicates, n_links (of its lines, summed) and lines of every document.

    lines holds line_no, line_id, class_id and n_links of each line that is not
    empty, in order; lines of one class_id are of one class, in whatever document.
    """
    some = F.col("line_id").isNotNull()
    line = F.when(some, F.struct("line_no", "line_id", "class_id", "n_links"))
    sums = fates.groupBy("row_id", "doc_id").agg(
        F.count_if(some).alias("n_lines"), F.count_if("duplicate").alias("n_duplicates"), F.sum("n_links").cast("long").alias("n_links"), F.array_sort(F.collect_list(line)).alias("lines")
    )
    return sums.drop("row_id")


def drop_duplicate_lines(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with the duplicate lines cut out of the texts; other lines stay as they are."""
    named, row = row_keyed(docs, doc_id, "line-input")
    fates = dedup_lines(named, doc_id=doc_id, text=text, row_id=row).where("duplicate")
    gone = fates.groupBy(F.col("row_id").alias(row)).agg(F.collect_set("line_no").alias(f"{row}_gone"))
    kept = F.filter(F.split(F.col(text), "\n"), lambda _, i: ~F.array_contains(F.col(f"{row}_gone"), i))
    new = F.when(F.col(f"{row}_gone").isNull(), F.col(text)).otherwise(F.array_join(kept, "\n"))
    return named.join(gone, row, "left").withColumn(text, new).select(*docs.columns)
