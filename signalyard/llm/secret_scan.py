"""Secret scans with an incremental ledger of blobs.

Every version of every path is content-addressed: its text is a blob, named by
its sha256.  The ledger holds, per blob and rule version, the findings of that
rule on that blob.  A scan looks only at pairs that the ledger lacks, adds
them, and joins the ledger back to all paths, so a copied or unchanged file is
searched once, ever, and a new rule version re-searches each blob once.

Only DataFrame functions are used."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.utils import AnalysisException

from signalyard.llm.common import cut, text_or_empty


@dataclass(frozen=True)
class Rule:
    """``pattern`` is a Java regular expression.  A match is dropped if its
    group ``group`` has fewer than ``least`` characters."""

    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 1
    #: a cheap pattern that any kept match implies
    hint: str | None = None

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


# The base rules, in the order of the report.
BASE = (
    Rule("assign", 1, r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12,
         r"""(?i:word|passwd|secret|token|key)["']?\x20*[:=]"""),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 18),
    # Runs of at least 16 are the maximal runs that pass, so the length is in the pattern.
    Rule("hex", 1, r"[0-9a-f]{16,}"),
)
#: Further kinds that the ledger's later rule version brings.
MORE = (
    Rule("pem", 2, r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", 2, r"\bgh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", 2, r"\bxox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", 2, r"\beyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("bearer", 2, r"\b[Bb]earer\x20+[A-Za-z0-9._~+/-]{20,}=*"),
)

_SPAN = "struct<start:long,end:long>"


def spans(text: Column, rule: Rule) -> Column:
    """Code point spans of ``rule`` in ``text``, leftmost and non-overlapping.

    What lies between the matches (split) and the matches themselves
    alternate, so their running lengths are the spans."""
    gaps = F.split(text, rule.pattern, -1)
    found = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    kept = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))
    steps = F.zip_with(
        F.zip_with(gaps, found, lambda g, f: F.struct(F.length(g).alias("gap"), F.coalesce(F.length(f), F.lit(0)).alias("hit"))),
        kept, lambda s, k: F.struct(s["gap"].alias("gap"), s["hit"].alias("hit"), F.length(k).alias("kept")))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        end = start + x["hit"]
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(x["kept"] >= rule.least, F.concat(acc["out"], span))
                        .otherwise(acc["out"]).alias("out"))

    none = F.array().cast(f"array<{_SPAN}>")
    walked = F.aggregate(steps, F.struct(F.lit(0).cast("long").alias("at"), none.alias("out")), step, lambda acc: acc["out"])
    return F.when(text.rlike(rule.hint or rule.pattern), walked).otherwise(none)


def _findings(text: Column, rules: tuple[Rule, ...], todo: Column | None) -> Column:
    """array<struct<rule,start,end>> of the rules in ``todo`` (null: all)."""
    none = F.array().cast("array<struct<rule:string,start:long,end:long>>")

    def found(rule: Rule) -> Column:
        all_of = F.transform(spans(text, rule), lambda s: F.struct(
            F.lit(rule.key).alias("rule"), s["start"].alias("start"), s["end"].alias("end")))
        return all_of if todo is None else F.when(F.array_contains(todo, rule.key), all_of).otherwise(none)

    return F.concat(*map(found, rules))


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame | None:
    """blob, rules (the rule versions that were run on it), found; or None."""
    try:
        return spark.read.parquet(ledger)
    except AnalysisException:
        return None


def update_ledger(versions: DataFrame, ledger: str, rules: tuple[Rule, ...] = BASE + MORE) -> None:
    """Run every (blob, rule version) pair of ``versions`` (column text) that
    the ledger lacks and append the findings."""
    spark = versions.sparkSession
    blobs = versions.select(F.sha2(text_or_empty(), 256).alias("blob"), text_or_empty().alias("text")).distinct()
    known = read_ledger(spark, ledger)
    if known is None:
        scanned = blobs.select("blob", F.array(*[F.lit(r.key) for r in rules]).alias("rules"),
                               _findings(F.col("text"), rules, None).alias("found"))
    else:
        done = known.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("done"))
        todo = F.array_except(F.array(*[F.lit(r.key) for r in rules]),
                              F.coalesce("done", F.array().cast("array<string>")))
        scanned = (blobs.join(done, "blob", "left").withColumn("todo", todo).filter(F.size("todo") > 0)
                   .select("blob", F.col("todo").alias("rules"),
                           _findings(F.col("text"), rules, F.col("todo")).alias("found")))
    scanned.write.mode("append").parquet(ledger)


def scan(versions: DataFrame, ledger: str, rules: tuple[Rule, ...] = BASE + MORE) -> DataFrame:
    """``versions`` with columns blob and found (array of rule, start, end of
    the given rules, by start, then rule as listed), after bringing the ledger
    up to date.  Needs a column text; a null text is the empty blob; columns
    named blob or found are replaced.  Text, blobs and findings stay in Spark
    tables; repeated texts are joined back by a plain join of the versions to
    one ledger row a blob, which Spark splits where a blob is frequent."""
    update_ledger(versions, ledger, rules)
    order = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.key), F.lit(i))])
    asked = F.filter(F.flatten(F.collect_list("found")), lambda f: order[f["rule"]].isNotNull())
    ranked = F.array_sort(F.transform(asked, lambda f: F.struct(
        f["start"].alias("start"), order[f["rule"]].alias("no"), f["end"].alias("end"), f["rule"].alias("rule"))))
    per_blob = cut(read_ledger(versions.sparkSession, ledger).groupBy("blob").agg(ranked.alias("found")))
    paths = versions.drop("blob", "found").withColumn("blob", F.sha2(text_or_empty(), 256)).drop("text")
    return paths.join(per_blob, "blob")


def report(docs: DataFrame, ledger: str) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans of every row of
    ``docs``: the base findings' counts and digest, and all findings as
    kind:start:end, by start, then kind, in code points with an exclusive end.
    An empty table gives no rows."""
    base = [r.key for r in BASE]
    written = lambda found: F.concat_ws(",", F.transform(found, lambda f: F.concat_ws(
        ":", F.split_part(f["rule"], F.lit("@"), F.lit(1)), f["start"], f["end"])))
    of_base = F.filter("found", lambda f: f["rule"].isin(base))
    count = lambda rule: F.size(F.filter("found", lambda f: f["rule"] == rule.key)).cast("long")
    found = scan(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), ledger)
    return found.select("doc_id", *[count(r).alias(f"n_{r.kind}") for r in BASE],
                        F.sha2(written(of_base), 256).alias("base_sha256"), written(F.col("found")).alias("spans"))
