"""Quality rules as weak supervision.

Every rule votes good, bad or not at all. The votes of all documents are counted by pattern (at most three to the
power of the number of rules, however many documents there are). Expectation-maximisation over these counts estimates,
for either class, how often each rule gives each vote, with no labels. A document's verdict is the posterior
probability of the good class under these estimates, so that one weak complaint is outvoted and one that good documents
never earn is not. Everything here is DataFrame expressions; the estimates are a few numbers.

Defined results: a null or empty text has no words, no lines and zero in every count; every rule abstains on it. Extra
columns are carried along; a computed column whose name is taken gets trailing underscores (`Measured.names`). An
empty table leaves the starting estimates as they are.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import unused
from millrace.workdir import checkpointed, fresh_dir

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
BAD, ABSTAIN, GOOD = -1, 0, 1
VOTES = (BAD, ABSTAIN, GOOD)


@dataclass(frozen=True)
class Rule:
    """SQL conditions over the measures; where neither holds, or a measure is null, the rule abstains."""

    name: str
    bad: str
    good: str

    def vote(self, names: dict[str, str]) -> Column:
        def condition(sql: str) -> Column:
            return F.expr(sql.format(**{k: f"`{v}`" for k, v in names.items()}))

        return F.when(condition(self.bad), BAD).when(condition(self.good), GOOD).otherwise(ABSTAIN)


RULES = (
    Rule("symbol_runs", "{n_symbol_runs} > 0.1 * {n_words}", "{n_words} > 0 and {n_symbol_runs} <= 0.01 * {n_words}"),
    Rule("symbols", "{n_symbols} > 0.1 * {n_words}", "{n_words} > 0 and {n_symbols} <= 0.02 * {n_words}"),
    Rule("bare_symbols", "{n_bare_symbols} > 0.1 * {n_words}", "{n_words} > 0 and {n_bare_symbols} <= 0.02 * {n_words}"),
    Rule("capitals", "{n_capitals} > 0.4 * {word_chars}", "{n_words} > 0 and {n_capitals} <= 0.15 * {word_chars}"),
    Rule("exclamations", "{n_exclamations} > 0.3 * {n_words}", "{n_words} > 0 and {n_exclamations} <= 0.05 * {n_words}"),
    Rule("repeated_windows", "{n_repeat_words} > 0.4 * {n_words}", "{n_words} > 0 and {n_repeat_words} <= 0.2 * {n_words}"),
    Rule("repeated_lines", "{n_dup_lines} > 0.6 * {n_lines}", "{n_lines} > 0 and {n_dup_lines} <= 0.35 * {n_lines}"),
    Rule("word_length", "{n_words} > 0 and ({word_chars} < 2 * {n_words} or {word_chars} > 20 * {n_words})",
         "{word_chars} between 3 * {n_words} and 12 * {n_words} and {n_words} > 0"),
)

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
            "n_lines", "n_symbol_runs", "n_bare_symbols", "n_capitals", "n_exclamations")


@dataclass(frozen=True)
class Measured:
    """A frame with the measures, and under which names it has them."""

    frame: DataFrame
    names: dict[str, str]
    fence: str

    def __getitem__(self, measure: str) -> Column:
        return F.col(f"`{self.names[measure]}`")


def measure(docs: DataFrame, text: str = "text") -> Measured:
    """The input with a column for each of `MEASURES`."""
    plain = unused(docs, "_plain")
    inputs = docs.columns
    frame = docs.withColumn(plain, F.coalesce(F.col(f"`{text}`"), F.lit("")))
    value = F.col(plain)

    def add(name: str, column: Column) -> str:
        nonlocal frame
        name = unused(frame, name)
        frame = frame.withColumn(name, column)
        return name

    names: dict[str, str] = {}
    lines = add("_lines", F.filter(F.split(value, "\n", -1), lambda line: F.regexp_like(line, F.lit(r"[^\x20\x09-\x0D]"))))
    words = add("_words", F.filter(F.split(value, SPACE, -1), lambda word: word != ""))
    names["n_lines"] = add("n_lines", F.size(lines).cast("bigint"))
    names["n_dup_lines"] = add("n_dup_lines", (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint"))
    names["n_words"] = add("n_words", F.size(words).cast("bigint"))
    names["word_chars"] = add("word_chars", F.length(F.array_join(words, "")).cast("bigint"))
    for name, pattern in (("n_symbols", SYMBOLS), ("n_symbol_runs", SYMBOLS + "{3,}"),
                          ("n_bare_symbols", rf"(?<![^\x20\x09-\x0D]){SYMBOLS}+(?![^\x20\x09-\x0D])"), ("n_capitals", "[A-Z]"), ("n_exclamations", "!")):
        names[name] = add(name, F.regexp_count(value, F.lit(pattern)).cast("bigint"))

    # Windows of three words, by hash. Only a text that has some hash twice is looked at further: hash and place in one
    # number (the place takes as many low bits as the text has words), so that sorting makes equal windows neighbours,
    # which are then compared word by word.
    def window(i: Column) -> Column:
        return F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))

    def same(pair: Column) -> Column:
        i, j = place(pair["a"]), place(pair["b"])
        return (F.get(words, i) == F.get(words, j)) & (F.get(words, i + 1) == F.get(words, j + 1)) & (F.get(words, i + 2) == F.get(words, j + 2))

    def place(key: Column) -> Column:
        return key.bitwiseAND(F.col(mask)).cast("int")

    bits = add("_bits", F.length(F.bin(F.size(words).cast("bigint"))))
    mask = add("_mask", F.call_function("shiftleft", F.lit(1).cast("bigint"), bits) - 1)
    hashes = add("_hashes", F.when(F.size(words) >= 3, F.transform(F.sequence(F.lit(0), F.size(words) - 3), window)))
    keys = F.transform(hashes, lambda h, i: F.call_function("shiftleft", h, bits).bitwiseOR(i.cast("bigint")))
    windows = add("_windows", F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), F.sort_array(keys)))
    pairs = F.zip_with(windows, F.slice(windows, F.lit(2), F.greatest(F.size(windows), F.lit(0))), lambda a, b: F.when(
        F.call_function("shiftrightunsigned", a.bitwiseXOR(b), bits) == 0, F.struct(a.alias("a"), b.alias("b"))))
    close = add("_close", F.filter(pairs, F.isnotnull))
    places = F.flatten(F.transform(F.filter(close, same), lambda pair: F.array(place(pair["a"]), place(pair["b"]))))
    repeated = add("_repeated", F.sort_array(F.array_distinct(places)))
    covered = F.transform(repeated, lambda at, k: F.least(F.lit(3), F.coalesce(F.get(repeated, k + 1) - at, F.lit(3))))
    names["n_repeat_words"] = add("n_repeat_words", F.coalesce(F.aggregate(covered, F.lit(0), lambda a, b: a + b), F.lit(0)).cast("bigint"))
    # Conditions that use a column that is not deterministic stay above it; else the optimiser would copy the measures
    # into every condition on them.
    fence = add("_fence", F.monotonically_increasing_id())
    return Measured(frame.select(*(F.col(f"`{c}`") for c in inputs), *(F.col(f"`{names[m]}`") for m in MEASURES), fence), names, fence)


@dataclass(frozen=True)
class Estimates:
    """The share of good documents, and by class how often each rule, in order, gives each vote."""

    good: float
    votes: tuple[dict[bool, dict[int, float]], ...]

    def posterior(self, votes: Column) -> Column:
        """Of an array with each rule's vote. The numbers are one constant array, so that all rounds share their code."""
        ratios = [[math.log(by[True][v]) - math.log(by[False][v]) for v in VOTES] for by in self.votes]
        prior = math.log(self.good) - math.log1p(-self.good)
        table = F.array(*(F.array(*(F.lit(x) for x in row)) for row in [*ratios, [prior] * len(VOTES)]))
        picked = F.transform(F.concat(votes, F.array(F.lit(ABSTAIN))), lambda v, k: F.get(F.get(table, k), v + 1))
        return 1 / (1 + F.exp(-F.aggregate(picked, F.lit(0.0), lambda a, b: a + b)))


#: Where expectation-maximisation starts: a complaint is rare among good documents, a bad one earns only some.
START = {True: {BAD: 0.001, ABSTAIN: 0.049, GOOD: 0.95}, False: {BAD: 0.3, ABSTAIN: 0.1, GOOD: 0.6}}
#: What the two classes mean: bad documents earn each complaint at least so many times as often as good ones.
COMPLAINT_RATIO = 20


def fit(patterns: DataFrame, rules: tuple[Rule, ...] = RULES, rounds: int = 12, tolerance: float = 1e-4) -> Estimates:
    """Estimates from ``patterns``: ``votes``, an array in the order of the rules, and ``rows``.

    Each round is one aggregation of at most 3 ** len(rules) rows to 3 * len(rules). Counts are smoothed by half a document.
    """
    found = Estimates(0.9, (START,) * len(rules))
    for _ in range(rounds):
        weighed = patterns.select("rows", (F.col("rows") * found.posterior(F.col("votes"))).alias("good"), F.posexplode("votes").alias("rule", "vote"))
        sums = weighed.groupBy("rule", "vote").agg(F.sum("rows").alias("rows"), F.sum("good").alias("good"))
        counts = {(row["rule"], row["vote"]): (row["rows"], row["good"]) for row in sums.collect()}
        if not counts:
            break
        rows, good = (sum(counts.get((0, v), (0, 0.0))[k] for v in VOTES) for k in (0, 1))
        shares = []
        for k in range(len(rules)):
            there = {v: counts.get((k, v), (0, 0.0)) for v in VOTES}
            by = {True: {v: (there[v][1] + 0.5) / (good + 1.5) for v in VOTES},
                  False: {v: (there[v][0] - there[v][1] + 0.5) / (rows - good + 1.5) for v in VOTES}}
            most = by[False][BAD] / COMPLAINT_RATIO
            if by[True][BAD] > most:  # the other votes of good documents share what is left
                rest = (1 - most) / (1 - by[True][BAD])
                by[True] = {v: most if v == BAD else x * rest for v, x in by[True].items()}
            shares.append(by)
        last, found = found, Estimates((good + 0.5) / (rows + 1), tuple(shares))
        if abs(last.good - found.good) < tolerance:
            break
    return found


def vote_patterns(measured: Measured, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Documents by pattern of votes, in the shared folder."""
    return checkpointed(measured.frame.select(votes(measured, rules).alias("votes")).groupBy("votes").agg(F.count(F.lit(1)).alias("rows")))


def votes(measured: Measured, rules: tuple[Rule, ...] = RULES) -> Column:
    return F.array(*(rule.vote(measured.names) for rule in rules))


def judged(measured: Measured, rules: tuple[Rule, ...] = RULES) -> tuple[DataFrame, str]:
    """The measured frame with its posterior probability of being good, and that column's name."""
    found = fit(vote_patterns(measured, rules), rules)
    name = unused(measured.frame, "good_probability")
    return measured.frame.withColumn(name, found.posterior(votes(measured, rules))), name


def base_failed(measured: Measured) -> Column:
    """Too few words, or more than half of them in repeated windows."""
    return (measured["n_words"] < 50) | (100 * measured["n_repeat_words"] > 50 * measured["n_words"])


def quality(docs: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """One row per document: id, measures, base_failed, good_probability, kept.

    The measures are written to the shared folder once; votes are counted and judged from there.
    """
    narrow = docs.select(F.col(f"`{id_column}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    measured = measure(narrow)
    saved = Measured(checkpointed(measured.frame.drop("text")), measured.names, measured.fence)
    frame, probability = judged(saved)
    return frame.withColumn("base_failed", base_failed(saved)).withColumn("kept", ~F.col("base_failed") & (F.col(probability) >= 0.5))


def keep_good(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents that pass, as they are. They are measured once and stored with their votes, which the estimates and the
    verdicts are then made from; no text is shuffled."""
    spark = docs.sparkSession
    measured = measure(docs, text)
    vote, failed = unused(measured.frame, "_votes"), unused(measured.frame, "_failed")
    inputs = [F.col(f"`{c}`") for c in docs.columns]
    path = fresh_dir(spark, "votes")
    measured.frame.select(*inputs, votes(measured).alias(vote), base_failed(measured).alias(failed)).write.option("compression", "zstd").parquet(path)
    stored = spark.read.parquet(path)
    patterns = checkpointed(stored.groupBy(F.col(vote).alias("votes")).agg(F.count(F.lit(1)).alias("rows")))
    return stored.filter(~F.col(failed) & (fit(patterns).posterior(F.col(vote)) >= 0.5)).select(*inputs)
