"""Personal data: base patterns, and bootstrapped contextual extraction of more.
Spark functions only.

1. The base kinds are found by pattern and check (IP parts, Luhn, digit counts).
2. Seeds: every base entity is an instance of its kind, and the words before it are
   lexical patterns (the last word, and the last two). The same patterns are read
   off before every other identifier-like token: a token with a digit or an @.
3. The pattern-instance graph is scored in rounds. A pattern's score for a kind is
   the smoothed share of that kind among its distinct instances, weighted by how
   sure each instance is; an instance that a trusted pattern precedes is as sure as
   its best such pattern, and counts in the next round. So it induces patterns of its
   own: one that precedes no seed at all is trusted once enough found instances follow it.
4. Unseen identifiers after trusted patterns become spans of the pattern's kind.

A pattern is trusted from ``trust`` on with at least ``support`` distinct instances
(seeds, or found in an earlier round) behind it. Base spans are never changed; added spans don't overlap them.

Nulls, ties, odd rows: a null text is empty. Rows that repeat a doc_id, or have
none, are rows of their own. A token after trusted patterns of two kinds takes the
kind with the higher score, then the first kind listed. Other columns are not
looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reconlake.llm import spans
from reconlake.llm.store import written

FOUND = "array<struct<start:bigint,rank:int,end:bigint,kind:string>>"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    """Luhn's check of the digits: from the right, every second one is doubled."""
    figure = F.filter(F.split(F.reverse(_digits(value)), ""), lambda d: d != "")
    worth = F.transform(figure, lambda d, i: spans.let(
        d.cast("int") * (F.pmod(i, F.lit(2)) + 1), lambda x: F.when(x > 9, x - 9).otherwise(x)))
    return F.aggregate(worth, F.lit(0), lambda acc, x: acc + x) % 10 == 0


def _between(value: Column, low: int, high: int) -> Column:
    return F.length(_digits(value)).between(low, high)


# The kinds and patterns of the contract, in its order. Quantifiers are
# possessive and starts are anchored where that changes no match, so that long runs
# of one character class cost no repeated scans.
KINDS = (
    ("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@",
     lambda v: F.lit(True)),
    ("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", ".",
     lambda v: F.forall(F.split(v, r"\."), lambda p: F.length(F.regexp_replace(p, "^0+", "")) <= 3)
     & F.forall(F.split(v, r"\."), lambda p: F.right(F.concat(F.lit("000"), p), F.lit(3)).cast("int") <= 255)),
    ("card", r"[0-9](?:[\x20-]?[0-9])++", "", lambda v: F.when(_between(v, 14, 19), _luhn(v)).otherwise(False)),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "+", lambda v: _between(v, 10, 15)),
)
RANK = {kind: i for i, (kind, *_) in enumerate(KINDS)}
TOKEN = r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+"
EDGE = "!\"#$%&'()*+,-./:;<=>?[\\]^_`{|}~"
CONTEXT = 80                       # characters before an entity in which its words are looked for


def base_spans(text: Column, found: dict[str, Column]) -> Column:
    """Base spans by start, then kind; each with its value and the text before it."""
    def of(kind: str, pattern: str, check) -> Column:
        hits = F.filter(spans.located(text, found[kind], pattern), lambda s: check(s["value"]))
        return F.transform(hits, lambda s: F.struct(
            s["start"].alias("start"), F.lit(RANK[kind]).alias("rank"), s["end"].alias("end"),
            F.lit(kind).alias("kind"), s["before"].alias("before"), s["value"].alias("value")))

    return F.array_sort(F.concat(*[of(kind, pattern, check) for kind, pattern, _, check in KINDS]))


def _patterns(before: Column) -> Column:
    """The last word, and the last two words, of the text before an entity."""
    near = F.lower(F.right(before, F.lit(CONTEXT)))
    return spans.let(F.filter(F.split(near, r"\s+"), lambda w: w != ""), lambda w: F.filter(
        F.array(F.get(w, F.size(w) - 1), F.concat_ws(" ", F.get(w, F.size(w) - 2), F.get(w, F.size(w) - 1))),
        lambda p: p.isNotNull() & (p != "")))


def _unseen(base: Column, tokens: Column) -> Column:
    """Tokens outside all base spans, without punctuation around them."""
    core = F.transform(tokens, lambda t: spans.let(F.ltrim(t["value"], F.lit(EDGE)), lambda left: spans.let(
        F.rtrim(left, F.lit(EDGE)), lambda v: F.struct(
            v.alias("value"), (t["end"] - F.length(left)).alias("start"),
            (t["end"] - F.length(left) + F.length(v)).alias("end"), _patterns(t["before"]).alias("patterns")))))
    return F.filter(core, lambda t: F.rlike(t["value"], F.lit("[0-9@]")) & ~F.exists(
        base, lambda b: (b["start"] < t["end"]) & (b["end"] > t["start"])))


def base_table(docs: DataFrame) -> DataFrame:
    """(rid, doc_id, base, unseen) per row of ``docs``."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    none = F.array().cast("array<string>")
    rows = rows.select("*", *[
        (F.when(F.contains("text", F.lit(needs)), spans.matches(F.col("text"), pattern)).otherwise(none) if needs
         else spans.matches(F.col("text"), pattern)).alias(f"m_{kind}") for kind, pattern, needs, _ in KINDS],
        spans.matches(F.col("text"), TOKEN).alias("m_token"))
    rows = rows.select("doc_id", base_spans(F.col("text"), {k: F.col(f"m_{k}") for k in RANK}).alias("base"),
                       spans.located(F.col("text"), F.col("m_token"), TOKEN).alias("tokens"))
    return rows.select(F.monotonically_increasing_id().alias("rid"), "doc_id",
                       F.transform("base", lambda b: F.struct(
                           b["start"].alias("start"), b["rank"].alias("rank"), b["end"].alias("end"),
                           b["kind"].alias("kind"), F.lower(b["value"]).alias("value"),
                           _patterns(b["before"]).alias("patterns"))).alias("base"),
                       _unseen(F.col("base"), F.col("tokens")).alias("unseen"))


def trusted_patterns(seeds: DataFrame, unseen: DataFrame, rounds: int, trust: float, support: int) -> DataFrame:
    """(pattern, rank, score) of the patterns that are trusted after the last round.

    ``seeds``: distinct (pattern, instance, rank); ``unseen``: distinct (pattern, instance)."""
    spark = seeds.sparkSession
    size = seeds.select("pattern", "instance").unionByName(unseen.select("pattern", "instance")).groupBy(
        "pattern").agg(F.count_distinct("instance").alias("n"))
    size = written(spark, "pii-sizes", size)
    known = written(spark, "pii-patterns", seeds.groupBy("pattern", "rank").agg(F.count(F.lit(1)).alias("seeds")))

    def scores(found: DataFrame | None) -> DataFrame:
        """Patterns with enough instances; ``found``: (pattern, rank, more, n_more)."""
        rows = known.withColumns({"more": F.lit(0.0), "n_more": F.lit(0)}) if found is None else known.join(
            found, ["pattern", "rank"], "full_outer")
        rows = rows.select("pattern", "rank", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("seeds", "more", "n_more")])
        return rows.where(F.col("seeds") + F.col("n_more") >= support).join(size, "pattern").withColumn(
            "score", (F.col("seeds") + F.col("more")) / (F.col("n") + 1))

    scored = scores(None)
    for _ in range(rounds - 1):
        sure = unseen.join(scored.where(F.col("score") >= trust), "pattern").groupBy("instance", "rank").agg(
            F.max("score").alias("sure"))
        found = unseen.join(sure, "instance").groupBy("pattern", "rank").agg(
            F.round(F.sum("sure"), 6).alias("more"), F.count(F.lit(1)).alias("n_more"))
        scored = written(spark, "pii-scores", scores(found))
    return scored.where(F.col("score") >= trust).select("pattern", "rank", "score")


def personal_data(docs: DataFrame, rounds: int = 3, trust: float = 0.8, support: int = 4) -> DataFrame:
    """(doc_id, base, added) per row of ``docs``: spans by start, then kind."""
    spark = docs.sparkSession
    rows = written(spark, "pii-rows", base_table(docs))
    seed = rows.select(F.explode("base").alias("b")).select(
        F.explode("b.patterns").alias("pattern"), F.col("b.value").alias("instance"), F.col("b.rank").alias("rank"))
    loose = rows.select("rid", F.explode("unseen").alias("u")).select(
        "rid", "u.start", "u.end", F.lower("u.value").alias("instance"), F.explode("u.patterns").alias("pattern"))
    edges = written(spark, "pii-edges", loose.select("pattern", "instance").distinct())
    trusted = trusted_patterns(seed.distinct(), edges, rounds, trust, support)
    best = loose.join(trusted, "pattern").groupBy("rid", "start", "end").agg(
        F.max(F.struct("score", (-F.col("rank")).alias("r"))).alias("m"))
    kinds = F.array(*[F.lit(k) for k in RANK])
    span = F.struct("start", (-F.col("m.r")).cast("int").alias("rank"), "end", F.get(kinds, -F.col("m.r")).alias("kind"))
    added = best.groupBy("rid").agg(F.array_sort(F.collect_list(span)).alias("added"))
    own = F.transform("base", lambda b: F.struct(b["start"].alias("start"), b["rank"].alias("rank"),
                                                 b["end"].alias("end"), b["kind"].alias("kind")))
    return rows.select("rid", "doc_id", own.alias("base")).join(added, "rid", "left").select(
        "doc_id", "base", F.coalesce("added", F.array().cast(FOUND)).alias("added"))


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns: counts and digest of the base spans, and all spans."""
    count = [F.size(spans.of_kind(F.col("base"), k)).cast("long").alias(f"n_{k}") for k in RANK]
    return found.select("doc_id", *count, F.sha2(spans.joined(F.col("base")), 256).alias("base_sha256"),
                        spans.joined(F.array_sort(F.concat("base", "added"))).alias("spans"))
