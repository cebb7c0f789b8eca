"""Secret scans with an incremental blob ledger, in Spark functions only.

Every version of every path is content-addressed (SHA-256 of the text). The ledger
holds, per blob and rule version, the spans found. A scan reads the texts of those
blobs only for which some rule version is not in the ledger yet, one text per blob,
runs just the missing rules on it, appends to the ledger, and joins the findings
back to all paths that hold the blob.

Nulls, ties, odd rows: a null text is the empty blob. Rows that repeat a doc_id are
versions of their own; a row without doc_id gets its findings too. Other columns are
not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reconlake.llm import spans
from reconlake.llm.store import written

SPAN = "struct<start:bigint,rank:int,end:bigint,kind:string>"
FOUND = f"array<{SPAN}>"


@dataclass(frozen=True)
class Rule:
    """A pattern and what a match must hold beyond it. A new version is scanned for anew."""
    kind: str
    version: int
    pattern: str
    least: int                 # characters of the match, or of ``part`` in it
    part: str = ""             # pattern of the part that counts, with one group
    needs: str = ""            # characters without which a text has no match
    base: bool = True

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"

    def spans(self, text: Column, rank: int) -> Column:
        hits = spans.located(text, spans.matches(text, self.pattern), self.pattern)
        value = (lambda s: F.regexp_extract(s["value"], self.part, 1)) if self.part else (lambda s: s["value"])
        kept = F.filter(hits, lambda s: F.length(value(s)) >= self.least)
        found = spans.kind_spans(kept, self.kind, rank)
        none = F.array().cast(FOUND)
        return F.when(F.contains(text, F.lit(self.needs)), found).otherwise(none) if self.needs else found


# The kinds and patterns of the contract, in its order.
RULES = (
    Rule("assign", 1, r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]"""
                      r"""|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+""",
         6, r"""[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)$"""),
    Rule("access", 1, r"AKIA[A-Z0-9]++", 20, needs="AKIA"),
    Rule("hex", 1, r"[0-9a-f]{24,}+", 24),
    # beyond the base kinds
    Rule("pem", 1, r"-----BEGIN (?:[A-Z]{1,20} ){0,3}PRIVATE KEY-----", 1, needs="-----BEGIN ", base=False),
)


def address(text: Column) -> Column:
    return F.sha2(F.coalesce(text.cast("string"), F.lit("")), 256)


def addressed(docs: DataFrame) -> DataFrame:
    """(doc_id, blob, text): every row's text with its content address."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), address(F.col("text")).alias("blob"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def scan_new(docs: DataFrame, versions: DataFrame, ledger: DataFrame | None, rules: tuple[Rule, ...]) -> DataFrame:
    """Ledger rows (blob, rule, spans) of the pairs that ``ledger`` lacks."""
    blobs = versions.groupBy("blob").agg(F.min("doc_id").alias("path"))
    due = blobs.select("blob", "path", F.explode(F.array(*[F.lit(r.name) for r in rules])).alias("rule"))
    if ledger is not None:
        due = due.join(ledger.select("blob", "rule"), ["blob", "rule"], "left_anti")
    due = due.groupBy("blob").agg(F.first("path").alias("path"), F.collect_set("rule").alias("rules"))
    # the texts themselves: one path of each blob
    texts = addressed(docs).alias("d").join(
        due.alias("u"), (F.col("d.blob") == F.col("u.blob")) & F.col("doc_id").eqNullSafe(F.col("path")))
    out = texts.select("d.blob", "rules", "text")
    for rank, rule in enumerate(rules):
        out = out.withColumn(f"r{rank}", F.when(F.array_contains("rules", rule.name), rule.spans(F.col("text"), rank)))
    entries = F.filter(F.array(*[F.struct(F.lit(r.name).alias("rule"), F.col(f"r{i}").cast(FOUND).alias("spans"))
                                 for i, r in enumerate(rules)]), lambda e: e["spans"].isNotNull())
    # a repeated row is scanned twice, but entered once
    return (out.select("blob", entries.alias("entries")).dropDuplicates(["blob"])
            .select("blob", F.explode("entries").alias("e")).select("blob", "e.rule", "e.spans"))


class BlobLedger:
    """Findings by blob and rule version, as a table that only grows."""

    def __init__(self, spark: SparkSession, path: str, rules: tuple[Rule, ...] = RULES):
        self.spark, self.path, self.rules = spark, path, rules

    def entries(self) -> DataFrame | None:
        jvm = self.spark._jvm
        at = jvm.org.apache.hadoop.fs.Path(self.path)
        if not at.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(at):
            return None
        return self.spark.read.schema(f"blob string, rule string, spans {FOUND}").parquet(self.path)

    def scan(self, docs: DataFrame) -> DataFrame:
        """(doc_id, blob, spans) per row of ``docs``; scans what is new and enters it."""
        versions = written(self.spark, "secret-versions", addressed(docs).select("doc_id", "blob"))
        scan_new(docs, versions, self.entries(), self.rules).write.mode("append").parquet(self.path)
        # of the scanned blobs only; a pair that two scans entered counts once
        mine = self.entries().where(F.col("rule").isin([r.name for r in self.rules]) & (F.size("spans") > 0)).join(
            versions.select("blob").distinct(), "blob", "left_semi").dropDuplicates(["blob", "rule"])
        found = (mine.groupBy("blob")
                 .agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans")))
        return versions.join(found, "blob", "left").select(
            "doc_id", "blob", F.coalesce("spans", F.array().cast(FOUND)).alias("spans"))


def digest(found: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The contract's columns: counts and digest of the base kinds, and all spans."""
    base = [r.kind for r in rules if r.base]
    count = [F.size(spans.of_kind(F.col("spans"), k)).cast("long").alias(f"n_{k}") for k in base]
    own = F.filter("spans", lambda s: s["kind"].isin(base))
    return found.select("doc_id", *count, F.sha2(spans.joined(own), 256).alias("base_sha256"),
                        spans.joined(F.col("spans")).alias("spans"))


CUT = 1024                 # characters of the blocks that pieces of a text are put together from


def redacted(text: Column, found: Column) -> Column:
    """``text`` with every span replaced by [REDACTED], overlapping spans by one. The text is
    read once, into blocks; a piece costs its own length and that of a block."""
    def piece(blocks: Column, start: Column, end: Column) -> Column:
        first = F.floor(start / CUT).cast("int")
        last = F.floor((end - 1) / CUT).cast("int")
        return F.when(end > start, F.substring(
            F.array_join(F.slice(blocks, first + 1, last - first + 1), ""),
            (start - first * CUT + 1).cast("int"), (end - start).cast("int"))).otherwise("")

    def glued(f: Column, blocks: Column) -> Column:
        def parts(reach: Column) -> Column:
            # the text between what the spans before reach and this span's start
            return F.filter(F.transform(f, lambda s, i: F.struct(F.get(reach, i).alias("from"), s["start"].alias("to"))),
                            lambda p: p["to"] >= p["from"])

        pieces = spans.let(spans.running_greatest(F.transform(f, lambda s: s["end"])), lambda reach: F.transform(
            parts(reach), lambda p: piece(blocks, p["from"], p["to"])))
        last = F.array_max(F.transform(f, lambda s: s["end"]))
        return F.concat(F.array_join(pieces, "[REDACTED]"), F.lit("[REDACTED]"),
                        piece(blocks, last, F.length(text).cast("long")))

    cut = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CUT}}}"), F.lit(0))
    return spans.let(found, lambda f: F.when(F.size(f) > 0, spans.let(cut, lambda blocks: glued(f, blocks))).otherwise(text))
