"""Secret scans with an incremental ledger of blobs.

Every version of a text is a blob under its content address (SHA-256). A ledger, a Parquet table in any store Spark
reads, holds for every blob and rule version what was found. A scan takes only the pairs that the ledger lacks: old
blobs are not scanned again, a new version of a rule scans all blobs with that rule alone, and copies are scanned once.
Findings are joined back to every path that has, or had, the blob. DataFrame expressions throughout.

Defined results: a null text is scanned as an empty one and has no findings; a null path is kept like any other value;
equal rows each get their findings. Only the path and text columns are read, so other columns cannot clash. Spans count
code points and their end is exclusive.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import unused
from millrace.workdir import checkpointed, fresh_dir

#: A blob's row: the rule versions that were run, and every match as the characters between it and the match before of
#: its rule, its own length, and whether it counts.
LEDGER = "blob string, rules array<string>, matches array<struct<rule:string,gap:int,size:int,counts:boolean>>"


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern`` count where ``group`` has ``least`` characters; raise ``version`` with any change."""

    name: str
    pattern: str
    version: int = 1
    group: int = 0
    least: int = 1

    @property
    def key(self) -> str:
        return f"{self.name}@{self.version}"


#: The order breaks ties between spans that start together.
RULES = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", group=2, least=6),
    Rule("access", "AKIA[A-Z0-9]{16,}"),
    Rule("hex", "[0-9a-f]{24,}"),
    Rule("private_key", "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("hosting_token", "gh[pousr]_[A-Za-z0-9]{36,}"),
)


def _matches(text: Column, rule: Rule) -> Column:
    """The matches of one rule. What stands between them comes from splitting, so that no place is searched for."""
    pattern = F.lit(rule.pattern)
    zipped = F.arrays_zip(
        F.transform(F.split(text, rule.pattern, -1), lambda x: F.length(x)).alias("gap"),
        F.regexp_extract_all(text, pattern, F.lit(0)).alias("whole"),
        F.regexp_extract_all(text, pattern, F.lit(rule.group)).alias("part"),
    )
    each = F.transform(
        F.filter(zipped, lambda x: x["whole"].isNotNull()),  # after the last match stands one piece more
        lambda x: F.struct(F.lit(rule.name).alias("rule"), x["gap"].alias("gap"), F.length(x["whole"]).alias("size"),
                           (F.length(x["part"]) >= rule.least).alias("counts")),
    )
    return F.when(F.regexp_like(text, pattern), each).otherwise(F.array())


def _ledger(docs: DataFrame, path: str) -> DataFrame | None:
    try:
        return docs.sparkSession.read.schema(LEDGER).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def blob_of(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def scan(docs: DataFrame, ledger: str, text: str = "text", rules: tuple[Rule, ...] = RULES) -> int:
    """Scan what the ledger lacks and append it, in one write; the number of blobs scanned.

    ``docs`` may hold any number of versions of any number of paths. Texts are made distinct before they are shuffled.
    """
    blobs = docs.select(F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text")).distinct().withColumn("blob", blob_of(F.col("text")))
    wanted = F.array(*(F.lit(rule.key) for rule in rules))
    old = _ledger(docs, ledger)
    if old is not None:
        seen = old.select("blob", F.explode("rules").alias("rule")).groupBy("blob").agg(F.collect_set("rule").alias("seen"))
        blobs = blobs.join(seen, "blob", "left").withColumn("todo", F.array_except(wanted, F.coalesce("seen", F.array().cast("array<string>"))))
        blobs = blobs.filter(F.size("todo") > 0)
    else:
        blobs = blobs.withColumn("todo", wanted)
    parts = [F.when(F.array_contains("todo", rule.key), _matches(F.col("text"), rule)).otherwise(F.array()) for rule in rules]
    new = blobs.select("blob", F.col("todo").alias("rules"), F.concat(*parts).alias("matches"))
    before = 0 if old is None else old.count()
    new.write.mode("append").parquet(ledger)
    return docs.sparkSession.read.schema(LEDGER).parquet(ledger).count() - before


def findings(docs: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per blob with findings of these rule versions: ``spans`` by start and order of the rules, ``keep`` the
    pieces of text outside them, and ``rest``, where the last piece starts. ``docs`` only lends its session."""
    table = docs.sparkSession.read.schema(LEDGER).parquet(ledger)
    keys, order = {rule.name: rule.key for rule in rules}, {rule.name: k for k, rule in enumerate(rules)}
    known = F.create_map(*(F.lit(x) for pair in keys.items() for x in pair))
    rank = F.create_map(*(F.lit(x) for pair in order.items() for x in pair))
    each = table.filter(F.size("matches") > 0).select("blob", "rules", F.posexplode("matches").alias("k", "m"))
    each = each.filter(F.array_contains("rules", known[F.col("m.rule")])).select("blob", "k", "m.*")
    upto = Window.partitionBy("blob", "rule").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    spans = each.withColumn("end", F.sum(F.col("gap") + F.col("size")).over(upto)).filter("counts")
    spans = spans.select("blob", (F.col("end") - F.col("size")).alias("start"), rank[F.col("rule")].alias("kind"), "end", "rule").distinct()
    before = Window.partitionBy("blob").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.withColumn("from", F.coalesce(F.max("end").over(before), F.lit(0)))
    piece = F.when(F.col("from") <= F.col("start"), F.struct("from", F.col("start").alias("to")))
    return spans.groupBy("blob").agg(
        F.sort_array(F.collect_list(F.struct("start", "kind", "end", "rule"))).alias("spans"),
        F.sort_array(F.collect_list(piece)).alias("keep"),
        F.max("end").alias("rest"),
    )


def paths_with(docs: DataFrame, found: DataFrame, text: str = "text") -> tuple[DataFrame, str]:
    """Every row of ``docs`` with its blob's findings (null where there are none), in one struct column, and its name.

    The findings go through the shared folder, so that the join reads plain exchanges and Spark can split a hot blob.
    """
    blob, name = unused(docs, "blob"), unused(docs, "found")
    side = checkpointed(found.select(F.col("blob").alias(blob), F.struct("spans", "keep", "rest").alias(name)))
    return docs.withColumn(blob, blob_of(F.col(f"`{text}`"))).join(side, blob, "left").drop(blob), name


def secret_spans(docs: DataFrame, ledger: str | None = None, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """One row per document: id and ``spans``, an array of (start, kind, end, rule). A fresh ledger if none is named."""
    ledger = ledger or fresh_dir(docs.sparkSession, "secret-ledger")
    scan(docs, ledger, text)
    narrow = docs.select(F.col(f"`{id_column}`").alias("doc_id"), blob_of(F.col(f"`{text}`")).alias("blob"))
    side = checkpointed(findings(docs, ledger).select("blob", "spans"))
    joined = narrow.join(side, "blob", "left")
    return joined.select("doc_id", F.coalesce("spans", F.array().cast(side.schema["spans"].dataType)).alias("spans"))


def redact(docs: DataFrame, ledger: str | None = None, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """The documents with every span replaced by ``mark`` (overlapping spans by one)."""
    ledger = ledger or fresh_dir(docs.sparkSession, "secret-ledger")
    scan(docs, ledger, text)
    joined, name = paths_with(docs, findings(docs, ledger), text)
    whole, found = F.col(f"`{text}`"), F.col(name)
    pieces = F.transform(found["keep"], lambda p: F.concat(F.substring(whole, p["from"].cast("int") + 1, (p["to"] - p["from"]).cast("int")), F.lit(mark)))
    clean = F.concat(F.array_join(pieces, ""), F.substring(whole, found["rest"].cast("int") + 1, F.lit(2**31 - 1)))
    return joined.withColumn(text, F.when(found.isNull(), whole).otherwise(clean)).select(*(F.col(f"`{c}`") for c in docs.columns))
