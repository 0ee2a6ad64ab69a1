"""Personal data: fixed patterns, and bootstrapped contextual extraction beyond them.

E-mail addresses, IP addresses, card and phone numbers that fixed patterns
find are the seeds. The words around a seed make lexical patterns. Patterns
and instances form a bipartite graph that is scored in rounds: a pattern is
as trustworthy, for a kind, as the instances that it surrounds are likely to
be of that kind; an unknown identifier is as likely as its best pattern.
Identifiers that trusted patterns surround are added; seeds always stay. What
one round trusts counts among the seeds of the next, so patterns that only new
instances show qualify as well.

All of it is Column expressions and joins: no text leaves the JVM. Patterns
that Java's engine would match by recursion, or from every place of a long
run anew, are written with possessive repetition and start only where a run
starts, or where the last match ended; they match the same.

Null and empty texts have no spans. Rows are told apart by a number of their
own, so a null doc_id, or one that many rows share, is a row like any other;
repeated rows get equal spans. Extra columns are ignored. No match crosses a
line end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import materialize, null_text

#: The kinds in their order, and their patterns.
KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must contain to be searched for a kind.
NEEDS = {"email": "@", "ip": ".", "phone": "+"}
BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"
CARD_DIGITS, PHONE_DIGITS = (13, 19), (9, 15)

#: An unknown identifier: a run of these characters with so many digits, or with an at sign and a letter.
RUN = r"(?<![0-9A-Za-z@._+-])[A-Za-z@._+-]*+[0-9@][0-9A-Za-z@._+-]*+"
LEAST_DIGITS = 5
#: Or groups of digits with spaces or brackets between them, with no more digits in all than a card has.
_GAP = r"[\x20().-]"
GROUPS = rf"(?<![0-9A-Za-z@._+(-])(?<![0-9]{_GAP}{{1,3}})(?=\(?[0-9.-]*+[\x20()]++{_GAP}*+[0-9])\(?[0-9](?:{_GAP}{{0,3}}+[0-9]){{{LEAST_DIGITS - 1},{CARD_DIGITS[1] - 1}}}+(?!{_GAP}{{0,3}}+[0-9]|[A-Za-z@_])"
IDENTIFIER = f"{GROUPS}|{RUN}"
#: Characters of context on either side.
CONTEXT = 48
ROUNDS = 3
#: A pattern is trusted with seeds of so many values and this confidence; it is shrunk as if it had one more false instance.
MIN_SEEDS, TRUST, SHRINK = 5, 0.8, 1.0


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the checksum."""
    n = F.length(digits)

    def worth(i: Column) -> Column:
        x = F.substr(digits, n - i + F.lit(1), F.lit(1)).cast("int")
        twice = F.when(x > 4, 2 * x - 9).otherwise(2 * x)
        return F.when(i % 2 == 0, twice).otherwise(x)

    total = F.aggregate(F.sequence(F.lit(1), n), F.lit(0), lambda acc, i: acc + worth(i))
    return F.when(n > 0, total % 10 == 0).otherwise(F.lit(False))


def valid(kind: str, match: Column) -> Column:
    """Whether a match of a kind's pattern is one of the kind."""
    if kind == "ip":
        return F.rlike(match, F.lit(rf"\A{BYTE}(?:\.{BYTE}){{3}}\z"))
    if kind == "card":
        n = F.length(_digits(match))
        return F.when(n.between(*CARD_DIGITS), luhn(_digits(match))).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(_digits(match)).between(*PHONE_DIGITS)
    return F.lit(True)


SPAN = "array<struct<start:bigint,end:bigint,value:string>>"


def _placed(matches: Column, gaps: Column) -> Column:
    """Start, end and text of each match: what lies between the matches, and they, are added up."""
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(SPAN).alias("out"))

    def step(acc: Column, i: Column) -> Column:
        m = F.get(matches, i)
        begin = acc["at"] + F.length(F.get(gaps, i))
        end = begin + F.length(m)
        return F.struct(end.cast("bigint").alias("at"), F.array_append(acc["out"], F.struct(begin.cast("bigint").alias("start"), end.cast("bigint").alias("end"), m.alias("value"))).alias("out"))

    return F.aggregate(F.sequence(F.lit(0), F.size(matches) - 1), start, step, lambda acc: acc["out"])


def _with_spans(df: DataFrame, name: str, pattern: str, needs: str | None) -> DataFrame:
    """df with a column of the places of all matches of the pattern in __t."""
    none = F.array().cast("array<string>")
    found = F.regexp_extract_all("__t", F.lit(pattern), F.lit(0))
    df = df.withColumn("__m", F.when(F.contains("__t", F.lit(needs)), found).otherwise(none) if needs else found)
    df = df.withColumn("__g", F.when(F.size("__m") > 0, F.split("__t", pattern, -1)).otherwise(none))
    return df.withColumn(name, F.when(F.size("__m") > 0, _placed(F.col("__m"), F.col("__g"))).otherwise(F.array().cast(SPAN))).drop("__m", "__g")


def contexts(text: Column, start: Column, end: Column) -> Column:
    """The lexical patterns around a span: the word before, the two before, and the words before and after."""
    size = F.lit(CONTEXT)
    before = F.lower(F.substr(text, (F.greatest(start - size, F.lit(0)) + 1).cast("int"), F.least(start, size).cast("int")))
    after = F.lower(F.substr(text, (end + 1).cast("int"), size))
    one = F.regexp_extract(before, r"(\p{L}[\p{L}\p{N}]*)[^\p{L}\p{N}\n]*\z", 1)
    two = F.regexp_extract(before, r"(\p{L}[\p{L}\p{N}]*)[^\p{L}\p{N}\n]+\p{L}[\p{L}\p{N}]*[^\p{L}\p{N}\n]*\z", 1)
    right = F.regexp_extract(after, r"\A[^\p{L}\p{N}\n]*([\p{L}\p{N}]+)", 1)
    made = F.array(F.concat(F.lit("l "), one), F.when(two != "", F.concat(F.lit("ll "), two, F.lit(" "), one)), F.when(right != "", F.concat(F.lit("lr "), one, F.lit(" "), right)))
    return F.when(one != "", F.array_compact(made)).otherwise(F.array().cast("array<string>"))


def occurrences(docs: DataFrame) -> DataFrame:
    """row (a number of its own), doc_id and found: kind (null for an unknown identifier), start, end, value and contexts of what each text has, materialized.

    This is the one pass over the texts.
    """
    df = docs.select("doc_id", null_text(F.col("text")).alias("__t"), F.monotonically_increasing_id().alias("row"))
    for k in KINDS:
        df = _with_spans(df, k, PATTERNS[k], NEEDS.get(k))
    df = _with_spans(df, "unknown", IDENTIFIER, None)

    def described(kind: str | None) -> Column:
        name = F.lit(kind).cast("string")
        fits = (lambda x: valid(kind, x["value"])) if kind else (lambda x: (F.length(_digits(x["value"])) >= LEAST_DIGITS) | F.rlike(x["value"], F.lit("[A-Za-z0-9]@[A-Za-z]")))
        return F.transform(
            F.filter(F.col(kind or "unknown"), fits),
            lambda x: F.struct(name.alias("kind"), x["start"].alias("start"), x["end"].alias("end"), F.lower(x["value"]).alias("value"), contexts(F.col("__t"), x["start"], x["end"]).alias("contexts")),
        )

    return materialize(df.select("row", "doc_id", F.concat(*(described(k) for k in (*KINDS, None))).alias("found")), "personal-data")


def _scores(per: str) -> list[Column]:
    """For each kind the confidence of a pattern: instances by their score, over all and SHRINK."""
    return [(F.sum(F.col("n") * F.col(f"s_{k}")) / (F.sum("n") + SHRINK)).alias(f"p_{k}") for k in KINDS]


def discover(found: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """row, kind, start, end and value of the unknown identifiers that trusted patterns surround.

    found is as from occurrences(). The graph has a row for each pattern and
    value, pre-aggregated; a pattern that surrounds very many values makes a
    large partition beside its one row of scores, which adaptive execution
    splits.
    """
    each = found.select("row", F.explode("found").alias("x")).select("row", "x.*")
    in_doc = W.partitionBy("row").orderBy("start", F.col("kind").isNull())
    before = F.max(F.when(F.col("kind").isNotNull(), F.col("end"))).over(in_doc.rowsBetween(W.unboundedPreceding, -1))
    after = F.min(F.when(F.col("kind").isNotNull(), F.col("start"))).over(in_doc.rowsBetween(1, W.unboundedFollowing))
    free = F.coalesce(before <= F.col("start"), F.lit(True)) & F.coalesce(after >= F.col("end"), F.lit(True))
    each = materialize(each.withColumn("__free", F.col("kind").isNotNull() | free).where("__free").drop("__free"), "identifiers")
    n = 3 * each.count()
    links = each.select("value", "kind", F.explode("contexts").alias("pattern"))
    graph = materialize(links.groupBy("pattern", "value").agg(F.count("*").alias("n"), F.max("kind").alias("kind")), "graph", n)
    # a pattern of fewer values never has the seeds it needs
    enough = graph.groupBy("pattern").count().where(F.col("count") >= MIN_SEEDS).select("pattern")
    graph = materialize(graph.join(enough, "pattern"), "trusted-graph", n)
    trusted = F.coalesce(F.greatest(*(F.col(f"u_{k}") for k in KINDS)) >= TRUST, F.lit(False))
    known = [F.when(F.col("kind").isNotNull(), (F.col("kind") == k).cast("double")).otherwise(F.coalesce(F.col(f"u_{k}"), F.lit(0.0))).alias(f"s_{k}") for k in KINDS]
    unknown = found.sparkSession.createDataFrame([], "value string, " + ", ".join(f"u_{k} double" for k in KINDS))
    for _ in range(rounds):
        scored = graph.join(unknown, "value", "left").select("pattern", "value", "n", (F.col("kind").isNotNull() | trusted).alias("seed"), *known)
        patterns = scored.groupBy("pattern").agg(F.count_if("seed").alias("seeds"), *_scores("pattern")).where(F.col("seeds") >= MIN_SEEDS)
        reached = graph.where("kind is null").join(patterns, "pattern")
        unknown = materialize(reached.groupBy("value").agg(*(F.max(f"p_{k}").alias(f"u_{k}") for k in KINDS)), "scores", n)
    likely = unknown.withColumn("__best", F.greatest(*(F.col(f"u_{k}") for k in KINDS))).where(F.col("__best") >= TRUST)
    kind = F.coalesce(*(F.when(F.col(f"u_{k}") == F.col("__best"), F.lit(k)) for k in KINDS))
    return each.where("kind is null").drop("kind").join(likely.select("value", kind.alias("kind")), "value").select("row", "kind", "start", "end", "value")


def _line(spans: Column) -> Column:
    """kind:start:end of spans in order, joined by commas."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def personal_data(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256 and spans of each document; the counts are of base spans."""
    found = occurrences(docs)
    more = discover(found, rounds)
    order = F.element_at(F.create_map(*(x for i, k in enumerate(KINDS) for x in (F.lit(k), F.lit(i)))), F.col("kind"))
    added = more.withColumn("o", order).groupBy("row").agg(F.collect_set(F.struct("o", "start", "end", "kind")).alias("__more"))
    base = F.transform(F.filter("found", lambda x: x["kind"].isNotNull()), lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end")))
    out = found.select("row", "doc_id", base.alias("__base")).join(added, "row", "left")
    is_kind = lambda k: lambda x: x["kind"] == k
    number = lambda x: F.element_at(F.create_map(*(y for i, k in enumerate(KINDS) for y in (F.lit(k), F.lit(i)))), x["kind"])
    full = F.sort_array(F.concat(F.transform("__base", lambda x: F.struct(number(x).alias("o"), x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind"))), F.coalesce("__more", F.array().cast("array<struct<o:int,start:bigint,end:bigint,kind:string>>"))))
    return out.select(
        "doc_id",
        *(F.size(F.filter("__base", is_kind(k))).cast("long").alias(f"n_{k}") for k in KINDS),
        F.sha2(_line(F.col("__base")), 256).alias("base_sha256"),
        F.when(F.col("__more").isNull(), _line(F.col("__base"))).otherwise(_line(full)).alias("spans"),
    )


def hidden_seeds(docs: DataFrame, share: int = 5, rounds: int = ROUNDS) -> DataFrame:
    """kind, hidden, found and right: how many distinct seeds of a kind come back when each one in share, by a hash of its value, is taken for an unknown identifier.

    right counts those that come back as the kind that they are. It tells how
    much of what the fixed patterns miss the contexts can be trusted to find.
    """
    found = occurrences(docs)
    hidden = lambda x: x["kind"].isNotNull() & (F.pmod(F.xxhash64(x["value"], F.lit("hidden")), F.lit(share)) == 0)
    fields = ("start", "end", "value", "contexts")
    masked = found.withColumn("found", F.transform("found", lambda x: F.struct(F.when(~hidden(x), x["kind"]).alias("kind"), *(x[f].alias(f) for f in fields))))
    truth = found.select(F.explode(F.filter("found", hidden)).alias("x")).groupBy(F.col("x.value").alias("value")).agg(F.min("x.kind").alias("kind"))
    back = discover(masked, rounds).groupBy("value").agg(F.min("kind").alias("as"))
    return truth.join(back, "value", "left").groupBy("kind").agg(F.count("*").alias("hidden"), F.count("as").alias("found"), F.count_if(F.col("as") == F.col("kind")).alias("right"))
