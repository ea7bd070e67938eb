"""Quality rules that vote, joined by weak supervision.

Each rule looks at counts of a text and votes good, bad or abstains. Several
rules look at each kind of fault from different sides, since only where rules
overlap can their agreement tell how right each is. The votes of all documents
are counted by pattern, of which there are at most 3 to the number of rules, and
expectation-maximisation over the patterns estimates how right each rule is on
good and on bad texts and how common good texts are, without labels and from a
majority vote on. A text's posterior probability of being good decides: a bad
vote of a rule that the others seldom agree with does not drop a text, and a text
for which little speaks goes even if no rule votes against it.

Defined results: a null or empty text has counts of 0, fails the base rules and
is not kept; rules abstain where they have nothing to divide by or too little to
tell; repeated rows are judged alike; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WHITE, map_batches, materialize, words_of

SYMBOLS = "#*$%&|<>"
WINDOW = 5
#: What is known of a rule before any vote: so many texts, on which it is right this often where it votes. Weak next to any corpus.
PRIOR, RIGHT = 2.0, 0.7
MIN_WORDS, MAX_REPEAT_PCT = 10, 20
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_end_lines", "n_upper", "n_shout", "n_distinct", "n_plain", "n_lettered", "n_marked")
# Words in UTF-8: of letters with marks around, with a letter, and with a symbol.
PLAIN = re.compile(rb"[(\"']*[A-Za-z\x80-\xff]+(?:['-][A-Za-z\x80-\xff]+)*[.,;:!?)\"']*").fullmatch
LETTERED = re.compile(rb"[A-Za-z\x80-\xff]").search
MARKED = re.compile(rb"[#*$%&|<>]").search


def repeat_words(words: list, window: int = WINDOW) -> int:
    """Words that lie in a window of words which occurs twice or more, the first time included."""
    if len(words) <= window:
        return 0
    grams = list(zip(*(words[i:] for i in range(window)), strict=False))
    counts = Counter(grams)
    if len(counts) == len(grams):
        return 0
    starts = np.flatnonzero(np.fromiter((counts[g] > 1 for g in grams), bool, len(grams)))
    depth = np.zeros(len(words) + 1, np.int64)
    np.add.at(depth, starts, 1)
    np.add.at(depth, starts + window, -1)
    return int((np.cumsum(depth)[:-1] > 0).sum())


def counts_of(text: str | None) -> tuple[int, ...]:
    """The counts of a text in the order of COUNTS."""
    if not text:
        return (0,) * len(COUNTS)
    raw = text.encode()
    words = words_of(raw)
    seen = Counter(words)
    lines = [x for x in text.split("\n") if x.strip(WHITE)]
    return (
        len(words),
        len(text) - sum(map(text.count, WHITE)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeat_words(words),
        len(lines),
        sum(x.rstrip(WHITE)[-1] in ".!?:;\"')" for x in lines),
        sum(map(str.isupper, text)) if not text.islower() else 0,
        text.count("!"),
        len(seen),
        *(sum(n for w, n in seen.items() if has(w)) for has in (PLAIN, LETTERED, MARKED)),
    )


def with_counts(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and the counts of every row."""
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(table: pa.Table) -> pa.Table:
        found = np.array([counts_of(t) for t in table.column("text").to_pylist()], np.int64).reshape(-1, len(COUNTS))
        return pa.table({"doc_id": table.column("doc_id")} | {c: pa.array(found[:, i]) for i, c in enumerate(COUNTS)})

    schema = f"doc_id {kind}, " + ", ".join(f"{c} long" for c in COUNTS)
    return map_batches(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")), run, schema)


def vote(share: Column, bad: Column, good: Column) -> Column:
    """-1, 1 or, where neither holds or the share is null, 0."""
    return F.when(share.isNull(), 0).when(bad, -1).when(good, 1).otherwise(0)


def votes() -> dict[str, Column]:
    """The rules; bounds are fixed values."""
    ratio = lambda a, b, least=1: F.when(F.col("n_words") >= least, F.try_divide(F.col(a).cast("double"), F.col(b)))
    out = {}
    for name, share, bad, good in (
        ("word_length", ratio("word_chars", "n_words"), lambda x: (x < 2.5) | (x > 10), lambda x: (x >= 3) & (x <= 8)),
        ("symbols", ratio("n_symbols", "word_chars"), lambda x: x > 0.04, lambda x: x < 0.01),
        ("marked_words", ratio("n_marked", "n_words"), lambda x: x > 0.1, lambda x: x < 0.02),
        ("lettered_words", ratio("n_lettered", "n_words"), lambda x: x < 0.8, lambda x: x >= 0.95),
        ("plain_words", ratio("n_plain", "n_words"), lambda x: x < 0.7, lambda x: x >= 0.9),
        ("dup_lines", ratio("n_dup_lines", "n_lines"), lambda x: x > 0.3, lambda x: x <= 0.05),
        ("repeats", ratio("n_repeat_words", "n_words"), lambda x: x > 0.15, lambda x: x <= 0.03),
        ("distinct", ratio("n_distinct", "n_words", 50), lambda x: x < 0.15, lambda x: x >= 0.3),
        ("line_ends", ratio("n_end_lines", "n_lines"), lambda x: x < 0.3, lambda x: x >= 0.7),
        ("upper", ratio("n_upper", "word_chars"), lambda x: x > 0.35, lambda x: x < 0.12),
        ("shout", ratio("n_shout", "n_words"), lambda x: x > 0.3, lambda x: x < 0.05),
    ):
        out[name] = vote(share, bad(share), good(share))
    return out


def fit(patterns: np.ndarray, counts: np.ndarray, *, rounds: int = 2000) -> tuple[float, np.ndarray, np.ndarray]:
    """(share of good texts, each rule's accuracy on good texts, and on bad ones) that make the patterns of votes likeliest.

    Bad texts are bad in different ways, so a rule may miss most of them and
    still hardly ever be wrong about a good one; hence two accuracies. The first
    guess is the majority of the votes of each text; of the two classes that come
    out, the one that more votes speak for is good.
    """
    rules = patterns.shape[1]
    good, on_good, on_bad = 0.5, np.full(rules, RIGHT), np.full(rules, RIGHT)
    if not len(patterns):
        return good, on_good, on_bad
    up, down = (patterns == 1).astype(float), (patterns == -1).astype(float)
    cast = up + down
    p = np.where(up.sum(axis=1) > down.sum(axis=1), 0.9, 0.1)
    for _ in range(rounds):
        p, q = counts * p, counts * (1 - p)
        new_good = (up.T @ p + PRIOR * RIGHT) / (cast.T @ p + PRIOR)
        new_bad = (down.T @ q + PRIOR * RIGHT) / (cast.T @ q + PRIOR)
        share = float((p.sum() + PRIOR) / (counts.sum() + 2 * PRIOR))
        still = max(np.abs(new_good - on_good).max(), np.abs(new_bad - on_bad).max(), abs(share - good))
        good, on_good, on_bad = share, new_good, new_bad
        p = 1 / (1 + np.exp(-np.clip(np.log(good / (1 - good)) + log_odds(patterns, on_good, on_bad), -500, 500)))
        if still < 1e-10:
            break
    if (cast.T @ counts) @ (on_good + on_bad - 1) < 0:
        good, on_good, on_bad = 1 - good, 1 - on_bad, 1 - on_good
    return good, on_good, on_bad


def log_odds(patterns: np.ndarray, on_good: np.ndarray, on_bad: np.ndarray) -> np.ndarray:
    """What the votes add to the log odds of good; a rule that abstains adds nothing."""
    return (patterns == 1) @ np.log(on_good / (1 - on_bad)) + (patterns == -1) @ np.log((1 - on_good) / on_bad)


def judge(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, the counts, base_failed, quality (posterior) and kept of every row."""
    counted = materialize(with_counts(docs, doc_id=doc_id, text=text), "rules-counts")
    rules = votes()
    cast = counted.select("*", *[c.alias(f"vote_{n}") for n, c in rules.items()])
    names = [f"vote_{n}" for n in rules]
    digits = sum(((F.col(name) + 1) * 3**i for i, name in enumerate(names)), F.lit(0))
    seen = sorted(cast.groupBy(digits.alias("pattern")).count().collect())  # at most 3 to the number of rules
    code = np.array([r["pattern"] for r in seen], np.int64)
    patterns = code[:, None] // 3 ** np.arange(len(names)) % 3 - 1
    good, on_good, on_bad = fit(patterns, np.array([r["count"] for r in seen], float))
    odds = F.lit(float(np.log(good / (1 - good))))
    for name, g, b in zip(names, on_good.tolist(), on_bad.tolist(), strict=True):
        odds = odds + F.when(F.col(name) == 1, float(np.log(g / (1 - b)))).when(F.col(name) == -1, float(np.log((1 - g) / b))).otherwise(0.0)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words"))
    judged = cast.withColumn("base_failed", failed).withColumn("quality", 1 / (1 + F.exp(-odds)))
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= 0.5)).drop(*names)
