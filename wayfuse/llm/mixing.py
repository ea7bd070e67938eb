"""Mixing sources to target weights by a low-discrepancy schedule.

The mix is a sequence of slots of equal tokens. Slot i holds point i of a
golden-ratio sequence; the source into whose part of the cumulative target
weights the point falls owns the slot, so every stretch of slots holds the
sources near their weights. A source's documents are shuffled by a hash, laid
end to end and cut into blocks of equal tokens (the last may be shorter), and
its slots, ranked, take its blocks in order, over and over. A source stops at
its target; what the schedule leaves short of it, a few blocks at most, is
appended in closing slots.

Nothing is ranked in one task: slots are counted by chunk and source before
they are numbered, and documents by hash range and source before they are laid
out. The table of sources alone is ordered as a whole.

Defined results: a null text has no words; the null source is a source of its
own and the last; a document or source without words is taken 0 times; repeated
rows are documents of their own; an empty table gives an empty result. Extra
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WHITE_CLASS, materialize, row_keyed, text_or_empty

BLOCK_TOKENS = 2048
MAX_REPEATS = 3
#: Slots that are numbered together, and hash ranges of a source's documents.
CHUNK, RANGES = 1 << 14, 1 << 12
#: Golden ratio in 31 bits: point i is (i * GOLDEN mod 2^31) / 2^31, so 2^31 slots pass before points repeat.
BITS = 31
GOLDEN = 1327217885


def word_count(text: str = "text") -> Column:
    """Runs of anything but white space: places where one begins."""
    body = F.concat(F.lit(" "), text_or_empty(text))
    squeezed = F.regexp_replace(body, f"{WHITE_CLASS}+", "\n")
    gaps = F.char_length(squeezed) - F.char_length(F.translate(squeezed, "\n", ""))
    return (gaps - F.when(F.substring(squeezed, -1, 1) == "\n", 1).otherwise(0)).cast("long")


def source_targets(sizes: DataFrame, *, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """(source, source_size, weight, target, rank) of a table (source, source_size).

    Targets are weight times a common level, or max_repeats times the source's
    size where that is less; the level is the one at which targets add up to
    all sizes, which is where resharing ends. Sources are put in order of the
    level at which they stop, and the last level with room for the rest holds.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.encode("source", "UTF-8"))
    ranked = sizes.withColumn("rank", F.row_number().over(by_name) - 1)
    ranked = ranked.withColumn("weight", (F.col("rank") % 3 + 1).cast("double"))
    cap = F.col("source_size") * float(max_repeats)
    by_stop = Window.orderBy(F.col("cap") / F.col("weight"), "rank").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy()
    level = (F.col("total") - (F.sum("cap").over(by_stop) - F.col("cap"))) / (F.sum("weight").over(whole) - F.sum("weight").over(by_stop) + F.col("weight"))
    found = ranked.withColumn("cap", cap).withColumn("total", F.sum("source_size").over(whole).cast("double")).withColumn("level", level)
    # The first source that does not stop below the level of those from it on is where the level is reached.
    held = found.withColumn("reached", F.min(F.when(F.col("cap") / F.col("weight") >= F.col("level"), F.struct(F.col("cap") / F.col("weight"), "rank", "level"))).over(whole))
    target = F.least("cap", F.coalesce(F.col("weight") * F.col("reached.level"), F.col("cap")))
    return held.select("source", "source_size", "weight", "rank", target.alias("target"))


def layout(docs: DataFrame, *, seed: int = 0) -> DataFrame:
    """Lays out rows (row_id, doc_id, source, size, ...): adds start, the tokens before it among its source in shuffled order."""
    order = F.xxhash64(F.lit(seed), F.col("doc_id").cast("string"), F.col("size"))
    ranged = docs.withColumn("__order", order).withColumn("__range", F.shiftrightunsigned("__order", 64 - 12).cast("int"))
    parts = ranged.groupBy("source_rank", "__range").agg(F.sum("size").alias("__tokens"))
    before = Window.partitionBy("source_rank").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    parts = materialize(parts.select("source_rank", "__range", F.coalesce(F.sum("__tokens").over(before), F.lit(0)).alias("__base")), "mix-ranges")
    within = Window.partitionBy("source_rank", "__range").orderBy("__order", "doc_id", "row_id").rowsBetween(Window.unboundedPreceding, -1)
    return (
        ranged.join(parts, ["source_rank", "__range"])
        .withColumn("start", F.col("__base") + F.coalesce(F.sum("size").over(within), F.lit(0)))
        .drop("__order", "__range", "__base")
    )


def schedule(targets: DataFrame, *, block: int = BLOCK_TOKENS) -> DataFrame:
    """Slots (slot, source_rank, pass, block_no, tokens) of the mix; closing slots come last, by source."""
    spark = targets.sparkSession
    goal = F.round("target").cast("long")
    plan = targets.where("source_size > 0").select(
        "rank",
        goal.alias("goal"),
        F.col("source_size").alias("n"),
        F.ceil(F.col("source_size") / block).alias("blocks"),
        "target",
    )
    plan = plan.withColumn(
        "needed",
        F.floor(F.col("goal") / F.col("n")) * F.col("blocks") + F.ceil((F.col("goal") % F.col("n")) / block),
    )
    edge = Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    plan = plan.withColumn("share", F.sum("target").over(edge) / F.sum("target").over(Window.partitionBy()))
    plan = plan.withColumn("hi", F.round(F.col("share") * (1 << BITS)).cast("long"))
    plan = plan.withColumn("lo", F.coalesce(F.lag("hi").over(Window.orderBy("rank")), F.lit(0)))
    plan = materialize(plan.select(F.col("rank").cast("int").alias("source_rank"), "goal", "n", "blocks", "needed", "lo", "hi"), "mix-plan")
    slots = plan.agg(F.sum("needed")).first()[0] or 0
    cell = BITS - 12
    cells = plan.where("hi > lo").select("source_rank", "lo", "hi", F.explode(F.sequence(F.shiftright("lo", cell), F.shiftright(F.col("hi") - 1, cell))).alias("cell"))
    point = (F.col("slot") % (1 << BITS)) * GOLDEN % (1 << BITS)
    owned = (
        spark.range(slots)
        .select(F.col("id").alias("slot"))
        .withColumn("point", point)
        .withColumn("cell", F.shiftright("point", cell))
        .join(cells, "cell")
        .where("lo <= point and point < hi")
        .select("slot", "source_rank", F.floor(F.col("slot") / CHUNK).alias("chunk"))
    )
    counts = owned.groupBy("source_rank", "chunk").count()
    before = Window.partitionBy("source_rank").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    counts = materialize(counts.select("source_rank", "chunk", "count", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base")), "mix-chunks")
    within = Window.partitionBy("source_rank", "chunk").orderBy("slot")
    ranked = owned.join(counts, ["source_rank", "chunk"]).select("slot", "source_rank", (F.col("base") + F.row_number().over(within) - 1).alias("turn"))
    used = counts.groupBy("source_rank").agg(F.sum("count").alias("had"))
    closing = plan.join(used, "source_rank", "left").where("coalesce(had, 0) < needed")
    closing = closing.select(
        (F.lit(slots) + F.col("source_rank")).alias("slot"),
        "source_rank",
        F.explode(F.sequence(F.coalesce("had", F.lit(0)), F.col("needed") - 1)).alias("turn"),
    )
    turns = ranked.unionByName(closing).join(plan.select("source_rank", "goal", "n", "blocks"), "source_rank")
    lap, no = F.floor(F.col("turn") / F.col("blocks")), F.col("turn") % F.col("blocks")
    taken_before = lap * F.col("n") + no * block
    length = F.least(F.lit(block).cast("long"), F.col("n") - no * block, F.col("goal") - taken_before)
    return turns.select("slot", "source_rank", lap.alias("pass"), no.alias("block_no"), length.alias("tokens")).where("tokens > 0")


def mix(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", source: str = "source", block: int = BLOCK_TOKENS, seed: int = 0, row_id: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(documents, takes).

    documents: row_id, doc_id, size, source_size, target, start of every row.
    takes: slot, pass, block_no, row_id, from_word, words: what each slot takes of
    each document, which is the mix in the order of slot, block_no and row place.
    """
    number = F.col(row_id) if row_id else F.monotonically_increasing_id()
    sized = docs.select(number.alias("row_id"), F.col(doc_id).alias("doc_id"), F.col(source).cast("string").alias("source"), word_count(text).alias("size"))
    sized = materialize(sized, "mix-sizes")
    sizes = materialize(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-sources")
    targets = materialize(source_targets(sizes), "mix-targets")
    known = sized.join(targets, sized.source.eqNullSafe(targets.source)).select("row_id", "doc_id", "size", "source_size", "target", F.col("rank").cast("int").alias("source_rank"))
    placed = materialize(layout(known, seed=seed), "mix-layout")
    first, last = F.floor(F.col("start") / block), F.floor((F.col("start") + F.col("size") - 1) / block)
    pieces = placed.where("size > 0").select("row_id", "source_rank", "start", "size", F.explode(F.sequence(first, last)).alias("block_no"))
    slots = schedule(targets, block=block)
    begin = F.greatest("start", F.col("block_no") * block)
    end = F.least(F.col("start") + F.col("size"), F.col("block_no") * block + F.col("tokens"))
    takes = (
        pieces.join(slots, ["source_rank", "block_no"])
        .select("slot", "pass", "block_no", "row_id", (begin - F.col("start")).alias("from_word"), (end - begin).alias("words"))
        .where("words > 0")
    )
    return placed, takes


def taken_words(placed: DataFrame, takes: DataFrame) -> DataFrame:
    """Every row of placed with taken, the words that the mix takes of it, repeats counted."""
    counts = takes.groupBy("row_id").agg(F.sum("words").alias("words"))
    return placed.join(counts, "row_id", "left").withColumn("taken", F.coalesce("words", F.lit(0)).cast("long")).drop("words")


def apply_mix(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """docs in the proportions of the mix: a row for each time its words are taken whole, rounded half up.

    Documents are not cut, so a document stays once for each half or more of it
    that the mix takes, and goes if less is taken; one without words goes.
    """
    named, row = row_keyed(docs, doc_id, "mix-input")
    placed, takes = mix(named, doc_id=doc_id, text=text, source=source, row_id=row)
    times = taken_words(placed, takes).where("size > 0")
    times = times.select(F.col("row_id").alias(row), F.floor(F.col("taken") / F.col("size") + 0.5).cast("int").alias(f"{row}_n"))
    times = materialize(times.where(F.col(f"{row}_n") > 0), "mix-times")
    many = F.explode(F.sequence(F.lit(1), F.col(f"{row}_n")))
    # As many rows as documents: never one to broadcast, whatever the planner reckons of a small input.
    return named.join(times.hint("merge"), row).withColumn(f"{row}_i", many).select(*docs.columns)
