"""Quality rules: text statistics, base rules, and a learned decision list.

The statistics, the rules and the verdict are Column expressions; texts never
leave the JVM. The list is learned by sequential covering: on the growing part
of the labelled rows a rule starts empty and takes the threshold condition
with the most information gain until it covers hardly any good row; on the
pruning part it loses its last conditions where that raises its worth; rows it
covers are then left out and the next rule starts. What the driver sees are
counts by feature and bin. A learned list is an ordered CASE expression.

Null and empty texts have no words and fail the base rules. Statistics are per
row: repeated rows get equal ones, and extra columns are kept. Without labels,
or with labels of one value, the list is empty and the base rules decide.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, WORD_REGEX, materialize, null_text, scratch

#: Labelled rows that the list is learned from, chosen by hash: at most about so many.
TRAIN_ROWS = 20_000
#: Thresholds tried for a feature: its quantiles.
BINS = 24
MAX_RULES, MAX_CONDITIONS = 8, 4
#: A rule stays if, on the pruning rows, at least this share of what it covers is bad; so that good documents are kept.
LEAST_PRECISION = 0.9
LEAST_COVERED = 5

#: Base rules: fewer words, or a larger percentage of words in repeated windows, fail.
MIN_WORDS, MAX_REPEAT_PERCENT = 10, 20
#: Words of a window that counts as repeated.
REPEAT_WINDOW = 5
SYMBOLS = r"[^#*$%&|<>]+"

STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: What conditions are about: shares of words or characters, and means.
FEATURES: dict[str, Callable[[], Column]] = {
    "words": lambda: F.col("n_words").cast("double"),
    "word_length": lambda: F.col("word_chars") / F.greatest(F.col("n_words"), F.lit(1)),
    "symbol_share": lambda: F.col("n_symbols") / F.greatest(F.col("word_chars"), F.lit(1)),
    "symbols_per_word": lambda: F.col("n_symbols") / F.greatest(F.col("n_words"), F.lit(1)),
    "dup_line_share": lambda: F.col("n_dup_lines") / F.greatest(F.col("__n_lines"), F.lit(1)),
    "repeat_share": lambda: F.col("n_repeat_words") / F.greatest(F.col("n_words"), F.lit(1)),
    "upper_share": lambda: F.col("__n_upper") / F.greatest(F.col("word_chars"), F.lit(1)),
    "mark_share": lambda: F.col("__n_marks") / F.greatest(F.col("n_words"), F.lit(1)),
    "letter_share": lambda: F.col("__n_letters") / F.greatest(F.col("word_chars"), F.lit(1)),
    "distinct_share": lambda: F.col("__n_distinct") / F.greatest(F.col("n_words"), F.lit(1)),
}
#: Columns of the statistics beyond STATS.
HIDDEN = ("__n_lines", "__n_upper", "__n_marks", "__n_letters", "__n_distinct")


def _left(text: str, pattern: str) -> Column:
    """Code points that stay once what matches is taken out."""
    return F.length(F.regexp_replace(text, pattern, "")).cast("long")


def with_stats(docs: DataFrame) -> DataFrame:
    """docs with STATS and HIDDEN; columns of these names are replaced.

    A row's windows are hashed into one array. Most texts repeat none, which
    the size of the distinct array shows; only the others are sorted, by hash
    and place, so that equal windows are neighbours. The cost of a text is
    that of a sort of its windows.
    """
    docs = docs.drop(*STATS, *HIDDEN, "__t", "__w", "__x", "__h", "__lines", "__at")
    size = F.lit(REPEAT_WINDOW)
    out = docs.withColumn("__t", null_text(F.col("text")))
    trimmed = F.btrim("__t", F.lit(SPACES))
    out = out.withColumn("__w", F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]++")))
    out = out.withColumn("n_words", F.size("__w").cast("long"))
    # each word is hashed once; a window's hash is made of its words'
    out = out.withColumn("__x", F.transform("__w", lambda w: F.xxhash64(w)))
    window = lambda i: F.xxhash64(*(F.get("__x", i + k) for k in range(REPEAT_WINDOW)))
    out = out.withColumn("__h", F.when(F.col("n_words") >= size, F.transform(F.sequence(F.lit(0), F.size("__x") - size), window)).otherwise(F.array().cast("array<bigint>")))
    out = out.withColumn("__n_distinct", F.size(F.array_distinct("__x")).cast("long"))
    out = out.withColumn("__h", F.when(F.size(F.array_distinct("__h")) < F.size("__h"), F.col("__h")).otherwise(F.array().cast("array<bigint>")))
    # equal hashes stand together: those like a neighbour give the places of repeated windows
    out = out.withColumn("__h", F.sort_array(F.transform("__h", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    same = lambda x, j: F.get("__h", j)["h"].eqNullSafe(x["h"])
    out = out.withColumn("__at", F.sort_array(F.transform(F.filter("__h", lambda x, j: same(x, j - 1) | same(x, j + 1)), lambda x: x["i"])))
    # each place adds the words up to the next place, five at most
    covered = F.aggregate("__at", F.struct(F.lit(0).cast("long").alias("n"), F.lit(-REPEAT_WINDOW).alias("p")), lambda acc, p: F.struct((acc["n"] + F.least(size, p - acc["p"])).alias("n"), p.alias("p")), lambda acc: acc["n"])
    out = out.withColumn("n_repeat_words", covered)
    out = out.withColumn("__lines", F.filter(F.split("__t", "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != ""))
    return out.withColumns({
        "word_chars": _left("__t", r"[\x20\x09-\x0D]++"),
        "n_symbols": _left("__t", SYMBOLS),
        "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
        "__n_lines": F.size("__lines").cast("long"),
        "__n_upper": _left("__t", r"\P{Lu}++"),
        "__n_marks": _left("__t", r"[^.,;:!?]++"),
        "__n_letters": _left("__t", r"\P{L}++"),
    }).drop("__t", "__w", "__x", "__h", "__at", "__lines")


def base_failed() -> Column:
    """The base rules on columns of STATS."""
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    """feature <= threshold (below) or feature > threshold."""

    feature: str
    below: bool
    threshold: float

    def column(self) -> Column:
        value = FEATURES[self.feature]()
        return value <= self.threshold if self.below else value > self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'<=' if self.below else '>'} {self.threshold:.6g}"


@dataclass
class DecisionList:
    """Rules in order; the first whose conditions all hold rejects the row, and without one the row is kept."""

    rules: list[tuple[Condition, ...]] = field(default_factory=list)

    def matches(self, rule: tuple[Condition, ...]) -> Column:
        out = F.lit(True)
        for c in rule:
            out = out & c.column()
        return F.coalesce(out, F.lit(False))

    def rule_number(self) -> Column:
        """1 for the first rule and so on; 0 where none holds."""
        out = None
        for i, rule in enumerate(self.rules, 1):
            out = F.when(self.matches(rule), F.lit(i)) if out is None else out.when(self.matches(rule), F.lit(i))
        return F.lit(0) if out is None else out.otherwise(F.lit(0))

    def accepts(self) -> Column:
        return self.rule_number() == 0

    def __str__(self) -> str:
        return "".join(f"reject if {' and '.join(map(str, r))}\n" for r in self.rules) + "else keep"


def _training_rows(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """Statistics and label of at most about rows labelled documents, in one partition, as their number is bounded."""
    named = labels.where("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("__quality"))
    n = named.count()
    if n > rows:
        share = int(rows / n * 1_000_000)
        named = named.where(F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1_000_000)) < share)
    joined = docs.select("doc_id", "text").join(F.broadcast(named), "doc_id")
    part = F.when(F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(3)) < 2, F.lit("grow")).otherwise(F.lit("prune"))
    numbers = with_stats(joined).select("doc_id", (F.col("__quality") < 1).cast("int").alias("__bad"), part.alias("__part"), *STATS, *HIDDEN)
    return materialize(numbers, "labelled", 2 * rows).where(~base_failed()).coalesce(1)


def _gain(p: float, n: float, p0: float, n0: float) -> float:
    """The information gain of a condition that leaves p of p0 bad and n of n0 good rows."""
    return p * (math.log2((p + 1e-9) / (p + n)) - math.log2((p0 + 1e-9) / (p0 + n0))) if p else 0.0


def _grow(rows: DataFrame, cuts: dict[str, list[float]], learned: DecisionList) -> list[Condition]:
    rule: list[Condition] = []
    while len(rule) < MAX_CONDITIONS:
        counts: dict[str, dict[int, tuple[int, int]]] = {}
        part = rows.where(learned.matches(tuple(rule)))
        for f, b, bad, good in part.select("__bad", F.inline("__bins").alias("feature", "bin")).groupBy("feature", "bin").agg(F.sum("__bad"), F.sum(1 - F.col("__bad"))).collect():
            counts.setdefault(f, {})[b] = (bad, good)
        if not counts:
            return []
        p0, n0 = (sum(x[i] for x in next(iter(counts.values())).values()) for i in (0, 1))
        if n0 == 0 or p0 < LEAST_COVERED:
            break
        best, found = 1e-6, None
        for f, points in sorted(cuts.items()):
            p = n = 0
            for b, point in enumerate(points):
                bad, good = counts[f].get(b, (0, 0))
                p, n = p + bad, n + good
                for below, x, y in ((True, p, n), (False, p0 - p, n0 - n)):
                    if x >= LEAST_COVERED and (g := _gain(x, y, p0, n0)) > best:
                        best, found = g, Condition(f, below, point)
        if found is None:
            break
        rule.append(found)
    return rule


def _bins(cuts: dict[str, list[float]]) -> Column:
    """For each feature the number of its thresholds below the value."""
    number = lambda f, points: F.size(F.filter(F.array(*map(F.lit, points)), lambda x: FEATURES[f]() > x))
    return F.array(*(F.struct(F.lit(f).alias("feature"), number(f, points).alias("bin")) for f, points in cuts.items()))


def _prune(rows: DataFrame, rule: list[Condition], learned: DecisionList) -> tuple[Condition, ...]:
    """The beginning of the rule that is worth most on the pruning rows; empty if none is precise enough."""
    sums = []
    for k in range(1, len(rule) + 1):
        m = learned.matches(tuple(rule[:k]))
        sums += [F.sum(F.when(m, F.col("__bad"))), F.sum(F.when(m, 1 - F.col("__bad")))]
    if not sums:
        return ()
    row = [x or 0 for x in rows.agg(*sums).first()]
    best: tuple[float, int] = (-2.0, 0)
    for k in range(1, len(rule) + 1):
        p, n = row[2 * k - 2 : 2 * k]
        if p + n >= max(1, LEAST_COVERED // 2) and p >= LEAST_PRECISION * (p + n):
            best = max(best, ((p - n) / (p + n) * math.log2(2 + p + n), k))
    return tuple(rule[: best[1]])


def _margin(rows: DataFrame, rule: tuple[Condition, ...], learned: DecisionList) -> tuple[Condition, ...]:
    """The rule with each threshold moved half way to the values that it covers, all but the last fiftieth of them.

    A quantile lies at the edge of what the rule leaves alone; documents just
    beyond that edge are kept, too.
    """
    row = rows.where(learned.matches(rule)).agg(*(F.percentile(FEATURES[c.feature](), F.lit(0.98 if c.below else 0.02)) for c in rule)).first()
    return tuple(Condition(c.feature, c.below, (c.threshold + x) / 2) if x is not None else c for c, x in zip(rule, row, strict=True))


def learn(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> DecisionList:
    """A decision list that rejects what the labels call bad (quality 0), from at most about train_rows labelled rows.

    Rows that fail the base rules are rejected anyway and teach nothing.
    """
    with scratch():
        return _learned(_training_rows(docs, labels, train_rows))


def _learned(rows: DataFrame) -> DecisionList:
    """The list that the rows teach: growing, pruning, and leaving out what is covered, in turns."""
    learned = DecisionList()
    names = list(FEATURES)
    probabilities = [i / BINS for i in range(1, BINS)]
    first = rows.agg(*(F.percentile(FEATURES[f](), F.array(*map(F.lit, probabilities))) for f in names), F.count_if(F.col("__bad") == 1)).first()
    if not first[-1] or any(x is None for x in first[:-1]):
        return learned
    cuts = {f: sorted(set(q)) for f, q in zip(names, first, strict=False)}
    for f in names:  # quantiles of the bad rows too: what is rare among all may be common among them
        more = rows.where("__bad = 1").agg(F.percentile(FEATURES[f](), F.array(*map(F.lit, probabilities[::2])))).first()[0]
        cuts[f] = sorted({*cuts[f], *(more or ())})
    rows = materialize(rows.withColumn("__bins", _bins(cuts)), "binned")
    while len(learned.rules) < MAX_RULES:
        left = rows.where(learned.accepts())
        rule = _grow(left.where("__part = 'grow'"), cuts, learned)
        rule = _prune(left.where("__part = 'prune'"), rule, learned)
        if not rule:
            break
        learned.rules.append(_margin(left.where("__bad = 1"), rule, learned))
    return learned


def judged(docs: DataFrame, learned: DecisionList) -> DataFrame:
    """docs with STATS, base_failed, rule (the number of the rule that rejects, else 0) and kept."""
    out = with_stats(docs.drop("base_failed", "rule", "kept"))
    out = out.withColumn("base_failed", base_failed()).withColumn("rule", learned.rule_number())
    # a filter on kept must not be pushed below the statistics, where it would compute them once for each mention:
    # a term that isn't deterministic, though always true, holds it back
    here = F.monotonically_increasing_id() >= 0
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0) & here).drop(*HIDDEN)


def quality(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, STATS, base_failed, kept and rule of each document."""
    docs = docs.select("doc_id", "text")
    return judged(docs, learn(docs, labels, train_rows)).drop("text").select("doc_id", *STATS, "base_failed", "kept", "rule")


def keep(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """The documents, with their own columns, that quality() keeps."""
    learned = learn(docs, labels, train_rows)
    own = docs.columns
    renamed = docs.select(F.struct(*own).alias("__row"), F.col("text").alias("text"))
    return judged(renamed, learned).where("kept").select("__row.*")
