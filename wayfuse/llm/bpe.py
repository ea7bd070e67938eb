"""Byte-level BPE with a given vocabulary, by a pair occurrence index.

The distinct pieces of an Arrow batch that the task has not met yet lie in one
flat list of symbols linked to their neighbours. An index maps each adjacent
pair that has a rank to all its positions. A heap yields the active ranks in
ascending order; all positions of a rank are merged at once, and the pairs that
these merges make are entered into their own lists. Pieces do not share
neighbours, and each token is made by one merge alone, so that a new pair ranks
behind the merge that made it: each piece gets what merging it alone gives.

Defined results: a null or empty text has no ids and decodes to an empty text;
ids that are null decode to an empty text; unknown ids are an error; bytes that
are not UTF-8 decode to U+FFFD. Extra columns are carried unless they clash
with the columns that are added, which replace them.
"""

from __future__ import annotations

import json
from array import array
from heapq import heappop, heappush
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

#: Fixed value: how the byte-level vocabulary cuts a text into pieces.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Signs that are a piece of their own at the end of a part.
ONE_SIGN = frozenset(".,;:!?|\"()")
#: Parts that a task remembers; it forgets all of them beyond this.
REMEMBERED = 250_000
#: Characters that are merged at once, or one longer text.
AT_ONCE = 4_000_000


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in a byte-level vocabulary file."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {b: chr(b) for b in shown}
    hidden = [b for b in range(256) if b not in letters]
    return letters | {b: chr(256 + i) for i, b in enumerate(hidden)}


class Vocabulary:
    """Ranks, token bytes and special tokens of a vocabulary file's content."""

    def __init__(self, content: str):
        found = json.loads(content)
        ids, letters = found["model"]["vocab"], byte_letters()
        byte_of = {c: b for b, c in letters.items()}
        self.first = np.array([ids[letters[b]] for b in range(256)], np.int64)
        keys, made = [], []
        for pair in found["model"]["merges"]:
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            keys.append(ids[left] << 32 | ids[right])
            made.append(ids[left + right])
        #: Pairs by rank, and the same sorted for look-up.
        self.pairs, self.made = np.array(keys, np.int64), np.array(made, np.int64)
        self.order = np.argsort(self.pairs)
        self.sorted = np.append(self.pairs[self.order], np.iinfo(np.int64).max)
        self.order = np.append(self.order, -1)
        self.special = {t["content"]: t["id"] for t in found["added_tokens"]}
        self.bytes = {i: bytes(byte_of[c] for c in token) for token, i in ids.items()}
        self.bytes |= {i: token.encode() for token, i in self.special.items()}
        self.cut = regex.compile(PIECES).findall
        self.doubtful = regex.compile(r"\s (?:\s|\Z)").search
        self.at_special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair of symbols, -1 where it has none."""
        key = left << 32 | right
        at = np.searchsorted(self.sorted, key)
        return np.where((self.sorted[at] == key) & (left >= 0) & (right >= 0), self.order[at], -1)

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of each piece as little-endian 32-bit integers."""
        lengths = np.array([len(p) + 1 for p in pieces], np.int64)
        raw = np.frombuffer(b"\0".join(pieces) + b"\0", np.uint8)
        symbol = self.first[raw]
        ends = np.cumsum(lengths) - 1
        symbol[ends] = -1  # no pair reaches over the end of a piece
        symbol = np.append(symbol, -1)
        after, before = np.arange(1, len(symbol) + 1), np.arange(-1, len(symbol) - 1)
        places: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def enter(at: np.ndarray, rank: np.ndarray) -> None:
            some = rank >= 0
            at, rank = at[some], rank[some]
            order = np.argsort(rank, kind="stable")
            at, rank = at[order], rank[order]
            cuts = np.flatnonzero(rank[1:] != rank[:-1]) + 1
            for r, own in zip(rank[np.append(0, cuts)].tolist() if len(rank) else [], np.split(at, cuts), strict=False):
                if r in places:
                    places[r].append(own)
                else:
                    places[r] = [own]
                    heappush(active, r)

        enter(np.arange(len(symbol) - 1), self.ranks(symbol[:-1], symbol[1:]))
        while active:
            rank = heappop(active)
            left, right, made = self.pairs[rank] >> 32, self.pairs[rank] & 0xFFFFFFFF, self.made[rank]
            at = places.pop(rank)
            at = np.unique(np.concatenate(at)) if len(at) > 1 else at[0]
            at = at[(symbol[at] == left) & (symbol[after[at]] == right)]
            if left == right and len(at) > 1:  # in a run each second pair loses its first symbol to the one before
                follows = np.append(False, after[at[:-1]] == at[1:])
                first = np.maximum.accumulate(np.where(follows, 0, np.arange(len(at))))
                at = at[(np.arange(len(at)) - first) % 2 == 0]
            if not len(at):
                continue
            gone = after[at]
            symbol[at], symbol[gone] = made, -2
            onward = after[gone]
            after[at], before[onward] = onward, at
            prior = before[at]
            enter(np.concatenate([prior, at]), self.ranks(np.append(symbol[prior], symbol[at]), np.append(symbol[at], symbol[onward])))
        stays = symbol[:-1] >= 0
        counts = np.append(0, np.cumsum(stays))[np.append(0, ends + 1)]
        ids = symbol[:-1][stays].astype("<i4").tobytes()
        return [ids[4 * a : 4 * b] for a, b in zip(counts[:-1].tolist(), counts[1:].tolist(), strict=True)]

    def encode(self, texts: list[str | None], known: dict[str, bytes]) -> list[bytes]:
        """Ids of each text as 32-bit integers.

        No piece reaches over a space that has a character other than white
        space on either side, so texts are first cut there, which is cheap, and
        known remembers the ids of each such part: keys are parts without the
        space before them, which all parts but the first of a text have.
        """
        out: list[bytes] = []
        part: list[str | None] = []
        size = 0
        for text in texts:
            part.append(text)
            size += len(text or "")
            if size >= AT_ONCE:
                out += self._encode(part, known)
                part, size = [], 0
        return out + self._encode(part, known)

    def _encode(self, texts: list[str | None], known: dict[str, bytes]) -> list[bytes]:
        if len(known) > REMEMBERED:
            known.clear()
        plan: list[list] = []  # for each text: ids of special tokens, and lists of parts
        fresh: dict[str, None] = {}
        heads: dict[str, bytes] = {}
        for text in texts:
            own: list = []
            for part in self.at_special.split(text) if text and self.at_special and any(t in text for t in self.special) else [text or ""]:
                if part in self.special:
                    own.append(self.special[part])
                elif self.doubtful(part):
                    own.append([part])
                else:
                    own.append(part.split(" "))
                if isinstance(own[-1], list):
                    heads[own[-1][0]] = b""
                    fresh |= dict.fromkeys(own[-1][1:])
            plan.append(own)
        todo = [p for p in fresh if p not in known]
        pieces: dict[str, int] = {}
        number = lambda p: pieces.setdefault(p, len(pieces))
        counts, flat = [], []
        for p in todo:
            if p.isalpha():  # by far the most parts are letters, or letters and one other sign
                flat.append(number(" " + p))
                counts.append(1)
            elif p[:-1].isalpha() and p[-1] in ONE_SIGN:
                flat += (number(" " + p[:-1]), number(p[-1]))
                counts.append(2)
            else:
                own = [number(x) for x in self.cut(" " + p)]
                flat += own
                counts.append(len(own))
        for p in heads:
            own = [number(x) for x in self.cut(p)]
            flat += own
            counts.append(len(own))
        if pieces:
            ids = self.merge([p.encode() for p in pieces])
            found = iter([ids[x] for x in flat])
            joined = [next(found) if n == 1 else b"".join(islice(found, n)) for n in counts]
            known.update(zip(todo, joined, strict=False))
            heads = dict(zip(heads, joined[len(todo) :], strict=True))
        get = known.__getitem__
        return [b"".join(array("i", [x]).tobytes() if isinstance(x, int) else heads[x[0]] + b"".join(map(get, x[1:])) for x in own) for own in plan]


def read_vocabulary(spark: SparkSession, path: str) -> str:
    """The file's content, by Spark where the driver can't open the path; a vocabulary is a few MB whatever the corpus."""
    if "://" in path:
        return spark.read.text(path, wholetext=True).first()[0]
    with open(path, encoding="utf-8") as file:
        return file.read()


def encode(docs: DataFrame, vocabulary: str, *, text: str = "text", to: str = "ids") -> DataFrame:
    """docs with the ids of each text as array<int>; vocabulary is the path of a tokenizers JSON file."""
    spark = docs.sparkSession
    content = spark.sparkContext.broadcast(read_vocabulary(spark, vocabulary))
    names = [c for c in docs.columns if c != to]
    schema = docs.select(*[F.col(f"`{c}`") for c in names]).schema.add(to, ArrayType(IntegerType()))

    def run(batches):
        vocab, known = Vocabulary(content.value), {}
        for batch in batches:
            texts = batch.column(text).to_pylist()
            ids_of = vocab.encode(texts, known)
            for at in range(0, batch.num_rows, 1000):
                part, found = batch.slice(at, 1000), ids_of[at : at + 1000]
                offsets = np.concatenate(([0], np.cumsum([len(b) // 4 for b in found]))).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(found), np.int32)))
                yield pa.RecordBatch.from_arrays([*part.columns, ids], names=[*part.schema.names, to])

    return docs.select(*[F.col(f"`{c}`") for c in names]).mapInArrow(run, schema)


def decode(docs: DataFrame, vocabulary: str, *, ids: str = "ids", to: str = "decoded") -> DataFrame:
    """docs with the text of each array of ids; special tokens are not skipped."""
    spark = docs.sparkSession
    content = spark.sparkContext.broadcast(read_vocabulary(spark, vocabulary))
    names = [c for c in docs.columns if c != to]
    schema = docs.select(*[F.col(f"`{c}`") for c in names]).schema.add(to, "string")

    def run(batches):
        table = Vocabulary(content.value).bytes
        tokens = np.full(max(table) + 1, None, object)
        tokens[list(table)] = list(table.values())
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                lists = part.column(ids)
                values = lists.flatten().to_numpy(zero_copy_only=False)
                sizes = [x or 0 for x in lists.value_lengths().to_pylist()]
                texts, start = [], 0
                for n in sizes:
                    own = values[start : start + n]
                    texts.append(b"".join(tokens[own].tolist()).decode("utf-8", "replace"))
                    start += n
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=[*part.schema.names, to])

    return docs.select(*[F.col(f"`{c}`") for c in names]).mapInArrow(run, schema)
