"""Secret scan with an incremental ledger of blobs.

Every version of a text is addressed by its content. The ledger names the pairs of blob and rule version that were
scanned, the findings table what they gave. A run scans only the pairs that neither has, appends both, and joins
findings back to every path that holds the blob. Texts move once, to the one row per new blob that is scanned; a group
of copies is one blob, and its rows meet its findings in a join that adaptive execution may split.

Positions come from the gaps that a split leaves between matches, so all of it is built-in functions.

Defined results: a null text counts as empty (one blob); repeated rows give repeated results; a null path stays null.
Appending is two table writes, findings first: a run that is lost between them is scanned again, and findings are read
once per pair, so a second scan of a pair changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollkeep.llm.common import exists, hex_sha256, split_join, texts
from rollkeep.sources.staging import staged


@dataclass(frozen=True)
class Rule:
    """A pattern, its version, and what a match (``whole``) or its group must reach. ``clue`` is a cheap test before."""

    kind: str
    pattern: str
    version: int = 1
    least: int = 0
    group: int = 0
    clue: str = ""


# The three base kinds, in their order.
BASE = (
    Rule(
        "assign",
        r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        least=6,
        group=2,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", least=20, clue="AKIA"),
    Rule("hex", r"[0-9a-f]{24,}", least=24),
)
# Kinds of the method's own, found beside the base kinds.
ADDED = (
    Rule("key_block", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", clue="-----BEGIN"),
    Rule("web_token", r"\beyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{5,}", clue="eyJ"),
    Rule("repo_token", r"\bgh[pousr]_[A-Za-z0-9]{30,}", clue="gh"),
    Rule("chat_token", r"\bxox[abprs]-[A-Za-z0-9-]{10,}", clue="xox"),
)
RULES = BASE + ADDED
FINDINGS = "blob binary, rule string, version int, spans array<struct<start:int,end:int>>"
LEDGER = "blob binary, rule string, version int"


NO_SPANS = "array<struct<start:int,end:int>>"


BLOCK = 256  # matches that are added up in one go


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once: a lambda's parameter holds it."""
    return F.transform(F.array(value), use)[0]


def spans(text: Column, rule: Rule) -> Column:
    """All matches of a rule that are long enough, as code points, leftmost and without overlap.

    The lengths of gaps and matches are put side by side once, then added up block by block: a list that grows by one span
    at a time is copied each time, so it is kept to a block's length.
    """
    found = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    judged = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)) if rule.group else found
    lengths = lambda values: F.transform(values, lambda x: F.length(x))
    gaps = F.slice(lengths(F.split(text, rule.pattern, -1)), F.lit(1), F.size(found))
    sizes = F.zip_with(
        F.zip_with(gaps, lengths(found), lambda gap, size: F.struct(gap.alias("gap"), size.alias("size"))),
        lengths(judged),
        lambda x, y: F.struct(x["gap"].alias("gap"), x["size"].alias("size"), y.alias("judged")),
    )
    none = F.array().cast(NO_SPANS)

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        one = F.array(F.struct(start.alias("start"), (start + x["size"]).alias("end")))
        out = F.when(x["judged"] < rule.least, acc["out"]).otherwise(F.concat(acc["out"], one))
        return F.struct((start + x["size"]).alias("at"), out.alias("out"))

    def add_block(acc: Column, block: Column) -> Column:
        inner = F.aggregate(block, F.struct(acc["at"].alias("at"), none.alias("out")), step)
        return _bound(inner, lambda r: F.struct(r["at"].alias("at"), F.concat(acc["blocks"], F.array(r["out"])).alias("blocks")))

    def blocks(all_sizes: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(all_sizes), F.lit(BLOCK))
        return F.transform(starts, lambda k: F.slice(all_sizes, k, F.lit(BLOCK)))

    zero = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{NO_SPANS}>").alias("blocks"))
    walked = F.aggregate(_bound(sizes, blocks), zero, add_block, lambda acc: F.flatten(acc["blocks"]))
    likely = text.contains(rule.clue) & text.rlike(rule.pattern) if rule.clue else text.rlike(rule.pattern)
    return F.when(likely, walked).otherwise(none)


def _table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(path) if exists(spark, path) else spark.createDataFrame([], schema)


def _pending(paths: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """One row per blob with unseen rules: the blob, one path that holds it, and those rules."""
    known = ledger.groupBy("blob").agg(F.collect_set(F.concat_ws("@", "rule", "version")).alias("seen"))
    blobs = paths.groupBy("blob").agg(F.min("doc_id").alias("doc_id"))
    wanted = F.array(*[F.lit(f"{r.kind}@{r.version}") for r in rules])
    unseen = F.array_except(wanted, F.coalesce("seen", F.array().cast("array<string>")))
    return blobs.join(known, "blob", "left").select("blob", "doc_id", unseen.alias("rules")).where(F.size("rules") > 0)


def scan(versions: DataFrame, ledger_dir: str, rules: tuple[Rule, ...] = RULES, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Scan what the ledger does not have yet, append it, and give every path its findings.

    ``versions`` holds every version of every path (``key``). The result has one row per row of it: ``doc_id``, ``blob``
    and one array of (start, end) per rule kind.
    """
    spark = versions.sparkSession
    blobs = texts(versions, key, text).withColumn("blob", F.unhex(hex_sha256(F.col("text"))))
    paths = blobs.select("doc_id", "blob")
    todo = staged(_pending(paths, _table(spark, f"{ledger_dir}/ledger", LEDGER), rules), "pending-blobs")

    chosen = todo.select(F.col("blob").alias("todo_blob"), F.col("doc_id").alias("todo_id"), "rules").hint("shuffle_hash")
    same = (F.col("blob") == F.col("todo_blob")) & F.col("doc_id").eqNullSafe(F.col("todo_id"))
    scanned = blobs.join(chosen, same, "inner").select(
        "blob",
        *[
            F.when(F.array_contains("rules", f"{r.kind}@{r.version}"), spans(F.col("text"), r)).alias(r.kind)
            for r in rules
        ],
    )
    per_rule = F.explode(F.array(*[F.struct(F.lit(r.kind).alias("rule"), F.lit(r.version).alias("version"), F.col(r.kind).alias("spans")) for r in rules]))
    some = scanned.where(" or ".join(f"size({r.kind}) > 0" for r in rules))
    found = some.select("blob", per_rule.alias("f")).select("blob", "f.rule", "f.version", "f.spans").where(F.size("spans") > 0)
    found.write.mode("append").parquet(f"{ledger_dir}/findings")
    pairs = todo.select("blob", F.explode("rules").alias("pair")).select("blob", F.split("pair", "@").alias("p"))
    done = pairs.select("blob", F.col("p")[0].alias("rule"), F.col("p")[1].cast("int").alias("version"))
    done.write.mode("append").parquet(f"{ledger_dir}/ledger")

    findings = _table(spark, f"{ledger_dir}/findings", FINDINGS)
    of = lambda r: F.max(F.when((F.col("rule") == r.kind) & (F.col("version") == r.version), F.col("spans")))
    by_blob = findings.groupBy("blob").agg(*[of(r).alias(r.kind) for r in rules])
    none = F.array().cast(NO_SPANS)
    return split_join(paths, by_blob, ["blob"], "left").select("doc_id", "blob", *[F.coalesce(r.kind, none).alias(r.kind) for r in rules])


def _labelled(rule: Rule, order: int) -> Column:
    text = lambda s: F.concat_ws(":", F.lit(rule.kind), s["start"], s["end"]).alias("text")
    return F.transform(F.col(rule.kind), lambda s: F.struct(s["start"].alias("start"), F.lit(order).alias("order"), text(s)))


def described(rules: tuple[Rule, ...]) -> Column:
    """The spans of these rules as kind:start:end, by start and then in the rules' order."""
    every = F.concat(*[_labelled(rule, order) for order, rule in enumerate(rules)])
    return F.array_join(F.transform(F.array_sort(every), lambda x: x["text"]), ",")
