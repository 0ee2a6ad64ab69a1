"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

A source gets a budget of words. Whole epochs of it come first; what is left
of the budget takes documents in the order of exponential keys, -ln(u) / w,
with u from a hash of the document's id and w its quality weight, until their
words reach it.

Prefix sums are made in two steps, so that no task needs a whole source: keys
fall into BUCKETS ranges, whose sums are added up first; only the one range of
a source in which the budget ends is sorted by row.

Null texts have no words and cost nothing; a null source is a source, the
last. A table without rows or words has targets of 0. Rows are told apart by
doc_id: repeated rows get keys of equal rank, each counts for itself. Extra
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, WORD_REGEX, materialize, null_text, scratch

#: Weights of the sources by code point, repeating.
WEIGHTS = (1, 2, 3)
#: A source is read so many times at most.
MAX_EPOCHS = 3
#: Ranges of keys.
BUCKETS = 4096
#: Sources that one task sorts, about.
SOURCES_PER_TASK = 500_000
SEED = "mix-1"


def n_words(text: Column) -> Column:
    return F.regexp_count(null_text(text), F.lit(WORD_REGEX)).cast("long")


def quality_weight(text: Column) -> Column:
    """1 to 4: three times the share of the text's characters that aren't symbols of markup, and one."""
    x = null_text(text)
    symbols = F.length(F.regexp_replace(x, r"[^#*$%&|<>]+", ""))
    return 4 - 3 * (symbols / F.greatest(F.length(x), F.lit(1)))


def uniform(key: Column, seed: str = SEED) -> Column:
    """A number between 0 and 1 from 52 bits of a hash."""
    digits = F.substring(F.md5(F.concat(key.cast("string"), F.lit(f":{seed}"))), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / float(1 << 52)


def sized(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """doc_id, source, size and key of each document."""
    u = F.coalesce(uniform(F.col("doc_id"), seed), F.lit(0.5))
    return docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), (-F.log(u) / quality_weight(F.col("text"))).alias("key"))


def numbered(per: DataFrame) -> DataFrame:
    """The sources with their place in the order of code points, null last: ranges of sources are sorted, and the rows of the ranges before added."""
    n = per.count()
    order = F.col("source").asc_nulls_last()
    rows = materialize(per.repartitionByRange(n // SOURCES_PER_TASK + 1, order).sortWithinPartitions(order).withColumn("__id", F.monotonically_increasing_id()), "sources")
    part = F.shiftright("__id", 33)
    ahead, offsets = 0, []
    for r in sorted(rows.groupBy(part.alias("part")).count().collect()):  # a row for each range
        offsets += [F.lit(r["part"]), F.lit(ahead)]
        ahead += r["count"]
    before = F.element_at(F.create_map(*offsets), part) if offsets else F.lit(0)
    return rows.withColumn("place", before + F.col("__id").bitwiseAND((1 << 33) - 1)).drop("__id")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """source, source_size and target of each source.

    Sources whose share by weight would exceed the limit are held at it, and
    the rest is shared anew by weight, until none exceeds it. Each round is
    one aggregate over the sources, however many they are; sums of integers
    and one division give each target.
    """
    per = numbered(sizes.groupBy("source").agg(F.sum("size").alias("source_size")))
    per = per.withColumn("w", F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int")).cast("long"))
    capped, held = F.lit(False), -1
    while True:
        free = F.sum(F.when(~capped, F.col("w")))
        row = per.agg(F.sum("source_size"), F.sum(F.when(capped, F.col("source_size"))), free, F.count_if(capped)).first()
        total, capped_size, free_w = (x or 0 for x in row[:3])
        if row[3] == held:
            break
        held = row[3]
        capped = F.col("w") * F.lit(total - max_epochs * capped_size) > F.col("source_size") * F.lit(max_epochs * free_w)
    share = F.try_divide((F.col("w") * F.lit(total - max_epochs * capped_size)).cast("double"), F.lit(free_w).cast("double"))
    return per.select("source", "source_size", F.when(capped, (max_epochs * F.col("source_size")).cast("double")).otherwise(share).alias("target"))


def _bucket(key: Column) -> Column:
    """The range of a key; keys are about exponential, so ranges of 1 - exp(-key) fill evenly."""
    return F.least(F.floor((1 - F.exp(-2 * key)) * BUCKETS), F.lit(BUCKETS - 1)).cast("int")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """doc_id, size, source_size, target, taken and source of each document.

    A document of the fractional selection is taken if the middle of it lies
    within the budget, so a source misses its target by half a document.
    """
    rows = materialize(sized(docs, seed).withColumn("bucket", _bucket(F.col("key"))), "sized")
    same = F.col("s.source").eqNullSafe(F.col("t.source"))
    buckets = rows.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"))
    goal = targets(rows, weights, max_epochs).withColumn("epochs", F.coalesce(F.floor(F.try_divide(F.col("target"), F.col("source_size").cast("double"))), F.lit(0)))
    goal = goal.withColumn("left", F.col("target") - F.col("epochs") * F.col("source_size"))
    ahead = W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    ranges = buckets.withColumn("before", F.coalesce(F.sum("bucket_size").over(ahead), F.lit(0)))
    ranges = ranges.alias("s").join(goal.alias("t"), same).select("s.source", "bucket", "before", "bucket_size", "source_size", "target", "epochs", "left")
    # the ranges that lie within the budget as a whole are taken, those beyond it aren't
    whole = F.when(F.col("before") + F.col("bucket_size") <= F.col("left"), F.lit("in")).when(F.col("before") >= F.col("left"), F.lit("out")).otherwise(F.lit("part"))
    ranges = materialize(ranges.withColumn("place", whole), "ranges", goal.count() * BUCKETS)
    # some thousand ranges a source, by name and number: the join is by both, so a hot source is spread over its ranges
    placed = rows.alias("s").join(ranges.alias("t"), same & (F.col("s.bucket") == F.col("t.bucket"))).select("doc_id", "s.source", "size", "key", "s.bucket", "source_size", "target", "epochs", "left", "before", "place")
    inside = W.partitionBy("source", "bucket").orderBy("key", "doc_id", "size").rowsBetween(W.unboundedPreceding, -1)
    part = placed.where("place = 'part'").withColumn("ahead", F.col("before") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
    chosen = F.when(2 * F.col("ahead") + F.col("size") <= 2 * F.col("left"), 1).otherwise(0)
    out = placed.where("place <> 'part'").withColumn("more", F.when(F.col("place") == "in", 1).otherwise(0)).drop("place").unionByName(part.withColumn("more", chosen).drop("place", "ahead"))
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * (F.col("epochs") + F.col("more"))).cast("long").alias("taken"), "source")


def mixture(docs: DataFrame, **options) -> DataFrame:
    """The documents that the mix takes, with all their columns and size, source_size, target, taken and repeats.

    doc_id must be unique; rows with a null one are not taken. The plan, a row
    of numbers for each document that is taken, is broadcast up to a checked
    number of rows, so texts aren't shuffled; beyond that both sides are, once.
    """
    added = ("size", "source_size", "target", "taken", "repeats")
    with scratch() as keep:
        chosen = mix(docs, **options).drop("source").where("taken > 0").withColumn("repeats", (F.col("taken") / F.col("size")).cast("int"))
        plan = keep(materialize(chosen, "mix"))
    small = plan.limit(BROADCAST_ROWS // 4 + 1).count() <= BROADCAST_ROWS // 4
    return docs.drop(*added).join(F.broadcast(plan) if small else plan.hint("shuffle_hash"), "doc_id")
