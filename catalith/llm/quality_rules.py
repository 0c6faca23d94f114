"""Quality rules: text statistics, and an ordered list of threshold rules learned from labels.

All statistics are Spark expressions over the text's word array; a document is never
exploded into rows. The list is learned by sequential covering: a rule grows by the
threshold condition of best information gain until it covers no good text, is pruned
from its end on rows held back, and is taken if it is precise enough there; what it
covers is set aside and the next rule is sought. Growing reads counts per statistic and
threshold that Spark aggregates; only these few hundred numbers come to the driver. The
learned list is one conditional Spark expression.

Learning uses about `SAMPLE` labelled rows at most, drawn by a hash of the id; statistics
and verdicts cover every row. Without labels, or with labels of one kind only, the list
is empty and rejects nothing.

Null and empty texts have no words and fail the base rule. Rows with a null or repeated
id are judged like any other. Labels without a document and null labels are not used; a
document labelled both ways counts once each way. Of conditions of equal gain the one that
covers fewer good rows, then the first by name and threshold, is taken. `judge` returns the
columns of `keep` and its own; no other column is read. An empty table gives no rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalith.checkpoints import stage, staging_folder
from catalith.functions.binding import compute_once, let

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS, MAX_REPEAT_PERCENT = 10, 20

SAMPLE = 20_000
THRESHOLDS = 24
MAX_RULES, MAX_CONDITIONS = 12, 3
# A rule must cover so many rejected texts of the growing part, and be so precise on both parts.
MIN_COVER, MIN_PRECISION = 5, 0.98
# Every so many-th labelled row is held back for pruning.
PRUNE_EVERY = 3


def _zero() -> Column:
    return F.lit(0).cast("bigint")


def _repeat_words(words: str, hashes: str) -> Column:
    """Words that lie in a five-word window found twice or more.

    Windows are told apart by hash first; where all hashes differ, nothing repeats. Only
    else are they sorted by their words, so a clash of hashes cannot change the result.
    """
    places = F.sequence(_zero(), F.size(words).cast("bigint") - WINDOW)
    windows = F.transform(
        places, lambda i: F.struct(F.array_join(F.slice(words, i.cast("int") + 1, WINDOW), " ").alias("w"), i.alias("at"))
    )

    def repeated(ordered: Column) -> Column:
        last = F.size(ordered) - 1

        def same(k: Column, other: Column) -> Column:
            return F.get(ordered, other)["w"] == F.get(ordered, k)["w"]

        marked = F.transform(
            F.sequence(F.lit(0), last),
            lambda k: F.when(((k > 0) & same(k, k - 1)) | ((k < last) & same(k, k + 1)), F.get(ordered, k)["at"]),
        )
        return F.sort_array(F.array_compact(marked))

    def covered(at: Column) -> Column:
        steps = F.transform(at, lambda a, k: F.least(F.coalesce(F.get(at, k + 1) - a, F.lit(WINDOW)), F.lit(WINDOW)))
        return F.aggregate(steps, _zero(), lambda s, x: s + x)

    count = let(let(F.sort_array(windows), repeated), covered)
    return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), count).otherwise(_zero())


def statistics(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """`keep` columns and the statistics of each text, all of type long."""
    content = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(*[F.col(k) for k in keep], content.alias("_t"))
    rows = compute_once(
        rows,
        {
            "_words": F.array_remove(F.split("_t", SPACE), ""),
            "_marks": F.regexp_replace("_t", f"[^A-Z0-9!?{SYMBOLS}]+", ""),
            "_lines": F.filter(F.split("_t", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")),
        },
    ).drop("_t")
    n = F.size("_words")
    window = lambda i: F.xxhash64(*[F.get("_words", i + k) for k in range(WINDOW)])
    windows = F.when(n >= WINDOW, F.transform(F.sequence(F.lit(0), n - WINDOW), window))
    rows = compute_once(rows, {"_hashes": F.coalesce(windows, F.array().cast("array<bigint>"))})

    def marks(of: str) -> Column:
        return F.length("_marks") - F.length(F.translate("_marks", of, ""))

    found = {
        "n_words": n,
        "word_chars": F.length(F.array_join("_words", "")),
        "n_symbols": marks(SYMBOLS),
        "n_dup_lines": F.size("_lines") - F.size(F.array_distinct("_lines")),
        "n_repeat_words": _repeat_words("_words", "_hashes"),
        "n_lines": F.size("_lines"),
        "n_shouts": marks("!?"),
        "n_capitals": marks("ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
        "n_digits": marks("0123456789"),
        "n_distinct_words": F.size(F.array_distinct("_words")),
    }
    return rows.select(*keep, *[c.cast("bigint").alias(name) for name, c in found.items()])


def base_failed() -> Column:
    repeats = 100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    return (F.col("n_words") < MIN_WORDS) | repeats


def _rate(part: str, whole: str, scale: int) -> Column:
    """Whole-numbered rate; 0 where there is nothing to divide by."""
    return F.coalesce(F.expr(f"try_divide({scale} * {part}, {whole})").cast("bigint"), _zero())


def features() -> dict[str, Column]:
    """What conditions are about: the statistics as rates."""
    return {
        "words": F.col("n_words"),
        "word_length_tenths": _rate("word_chars", "n_words", 10),
        "symbols_per_mille": _rate("n_symbols", "word_chars", 1000),
        "shouts_per_mille": _rate("n_shouts", "word_chars", 1000),
        "capitals_per_mille": _rate("n_capitals", "word_chars", 1000),
        "digits_per_mille": _rate("n_digits", "word_chars", 1000),
        "dup_line_percent": _rate("n_dup_lines", "n_lines", 100),
        "repeat_percent": _rate("n_repeat_words", "n_words", 100),
        "distinct_percent": _rate("n_distinct_words", "n_words", 100),
    }


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: int

    def column(self) -> Column:
        value = F.col(self.feature)
        return value > self.threshold if self.above else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold}"


Rule = tuple[Condition, ...]


def _matches(rule: Rule) -> Column:
    return reduce(Column.__and__, [c.column() for c in rule], F.lit(True))


def decision(rules: list[Rule]) -> Column:
    """The first rule that a row meets, as text; null if it meets none."""
    names = [" and ".join(map(str, r)) for r in rules]
    verdict = F.lit(None).cast("string")
    for rule, name in reversed(list(zip(rules, names, strict=True))):
        verdict = F.when(_matches(rule), F.lit(name)).otherwise(verdict)
    return verdict


def _gain(p: int, n: int, p0: int, n0: int) -> float:
    return p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0))) if p else 0.0


def _best_condition(rows: DataFrame, cuts: dict[str, list[int]]) -> tuple[Condition | None, int, int]:
    """The condition of best information gain over the rows, with the rejected and good rows it covers."""
    entries = [
        F.struct(F.lit(f).alias("f"), F.lit(t).cast("bigint").alias("t"), (F.col(f) > t).alias("above"))
        for f, ts in cuts.items()
        for t in ts
    ]
    counts = (
        rows.select("bad", F.explode(F.array(*entries)).alias("e"))
        .groupBy("e.f", "e.t", "e.above")
        .agg(F.count_if("bad").alias("p"), F.count_if(~F.col("bad")).alias("n"))
        .collect()
    )
    first = [r for r in counts if r["f"] == next(iter(cuts)) and r["t"] == cuts[r["f"]][0]]
    p0, n0 = sum(r["p"] for r in first), sum(r["n"] for r in first)
    if not p0:
        return None, 0, 0
    ranked = sorted(counts, key=lambda r: (-_gain(r["p"], r["n"], p0, n0), r["n"], r["f"], r["t"], r["above"]))
    top = ranked[0]
    if _gain(top["p"], top["n"], p0, n0) <= 0:
        return None, p0, n0
    return Condition(top["f"], top["above"], top["t"]), top["p"], top["n"]


def _pruned(rows: DataFrame, rule: Rule) -> tuple[Rule, float, float]:
    """The rule without the end that does not help on held-back rows; its precision there and on all rows."""
    ends = range(1, len(rule) + 1)
    counts = []
    for k in ends:
        m, held = _matches(rule[:k]), F.col("held")
        for bad in (True, False):
            kind = F.col("bad") if bad else ~F.col("bad")
            counts += [F.count_if(m & held & kind).alias(f"held_{k}_{bad}"), F.count_if(m & kind).alias(f"all_{k}_{bad}")]
    r = rows.agg(*counts).collect()[0]

    def worth(k: int) -> tuple[float, int]:
        p, n = r[f"held_{k}_True"], r[f"held_{k}_False"]
        return ((p - n) / (p + n) if p + n else -1.0, -k)

    k = max(ends, key=worth)

    def precision(part: str) -> float:
        p, n = r[f"{part}_{k}_True"], r[f"{part}_{k}_False"]
        return p / (p + n) if p + n else 1.0

    return rule[:k], precision("held"), precision("all")


def learn(rows: DataFrame) -> list[Rule]:
    """An ordered list of rules for rows with the features and boolean columns `bad` and `held`."""
    names = list(features())
    at = [(i + 1) / (THRESHOLDS + 1) for i in range(THRESHOLDS)]
    # The tails are cut finer: junk is rare.
    at = sorted({*at, 0.001, 0.0025, 0.005, 0.01, 0.02, 0.98, 0.99, 0.995, 0.9975, 0.999})
    found = rows.agg(*[F.percentile_approx(f, at, 10_000).alias(f) for f in names]).collect()[0]
    cuts = {f: sorted(set(found[f])) for f in names if found[f]}
    if not cuts:
        return []
    rules: list[Rule] = []
    left = rows
    for _ in range(MAX_RULES):
        rule: Rule = ()
        growing = left.where(~F.col("held"))
        covered = 0
        for _ in range(MAX_CONDITIONS):
            condition, p, n = _best_condition(growing, cuts)
            if condition is None:
                break
            rule, covered = (*rule, condition), p
            growing = growing.where(condition.column())
            if n == 0:
                break
        if not rule or covered < MIN_COVER:
            break
        rule, on_held, on_all = _pruned(left, rule)
        if min(on_held, on_all) < MIN_PRECISION:
            break
        rules.append(rule)
        left = left.where(~_matches(rule))
    return rules


def training_rows(docs: DataFrame, labels: DataFrame, doc: str = "doc_id", text: str = "text", quality: str = "quality") -> DataFrame:
    """Features of about SAMPLE labelled documents, without those that fail the base rule."""
    usable = labels.where(F.col(quality).isNotNull() & F.col(doc).isNotNull())
    usable = usable.select(F.col(doc).alias("_id"), (F.col(quality) == 0).alias("bad")).distinct()
    share = min(1.0, SAMPLE / max(1, usable.count()))
    draw = F.pmod(F.xxhash64("_id", F.lit("quality sample")), F.lit(1 << 30))
    # SAMPLE rows or about that, so the broadcast is bounded.
    drawn = usable.where(draw < int(share * (1 << 30))).withColumn("held", F.pmod(draw, F.lit(PRUNE_EVERY)) == 0)
    joined = docs.select(F.col(doc).alias("_id"), F.col(text).alias("_text")).join(F.broadcast(drawn), "_id")
    # What the base rule rejects needs no learned rule.
    found = statistics(joined, ["bad", "held"], "_text").where(~base_failed())
    return found.select("bad", "held", *[c.alias(f) for f, c in features().items()])


def judge(docs: DataFrame, rules: list[Rule], keep: list[str], text: str = "text") -> DataFrame:
    """`keep` columns, the statistics, base_failed, rule (the learned rule that rejects, or null) and kept."""
    found = statistics(docs, keep, text).withColumns(features())
    judged = found.withColumn("base_failed", base_failed()).withColumn("rule", decision(rules)).drop(*features())
    return judged.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())


def learned_rules(docs: DataFrame, labels: DataFrame, doc: str = "doc_id", text: str = "text") -> list[Rule]:
    rows = stage(training_rows(docs, labels, doc, text), staging_folder(docs.sparkSession), "training")
    return learn(rows)
