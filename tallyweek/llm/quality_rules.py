"""Quality rules: a learned decision list over text statistics, in Spark expressions only.

Sequential covering: a rule grows by adding, one after the other, the threshold
condition with the best information gain on the growing rows, is pruned from its
end on the pruning rows, and the labelled rows it covers are set aside before the
next rule is learned. Every step is one aggregation over the labelled rows, and
the list becomes one CASE expression.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import compute_once
from .common import BLANKS, WORD, cut

MIN_WORDS = 50
MOST_REPEATED_PERCENT = 50

#: Ratios that rules may test, from the statistics of a text.
RATIOS = {
    "word_length": lambda: F.col("word_chars") / F.col("n_words"),
    "symbols_per_word": lambda: F.col("n_symbols") / F.col("n_words"),
    "dup_lines_share": lambda: F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
    "repeated_share": lambda: F.col("n_repeat_words") / F.col("n_words"),
    "upper_share": lambda: F.col("n_upper") / F.col("word_chars"),
    "marks_per_word": lambda: F.col("n_marks") / F.col("n_words"),
    "digit_share": lambda: F.col("n_digits") / F.col("word_chars"),
}
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
EXTRA = ["n_lines", "n_upper", "n_marks", "n_digits"]


def _matched(text: Column, pattern: str) -> Column:
    """Characters in runs that the pattern, a class, matches."""
    return (F.char_length(text) - F.char_length(F.regexp_replace(text, f"{pattern}+", ""))).cast("long")


def text_statistics(docs: DataFrame, hash_bits: int = 64) -> DataFrame:
    """Add the counts named in BASE and EXTRA; a null text counts like the empty one, with zeros.

    Columns of the same names are replaced. Words of three-word windows that occur twice are found
    by sorting each text's windows: a long holds the window's hash above its position, so equal
    windows become neighbours. With n words the hash has 64 - log2(n) bits (at most ``hash_bits``, 1 to 64);
    neighbours' words are compared, and where some differ the text's windows are sorted as words.
    """
    names = [*BASE, *EXTRA]
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = docs.drop(*names)
    words = F.split(F.btrim(text, F.lit(BLANKS)), r"[\x20\x09-\x0D]+")
    step = compute_once(
        docs,
        {
            "_words": F.when(F.btrim(text, F.lit(BLANKS)) == "", F.array().cast("array<string>")).otherwise(words),
            "_lines": F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(BLANKS)) != ""),
            "_solid": F.regexp_replace(text, r"[\x20\x09-\x0D]+", ""),
        },
    )
    # bits for the position, per text
    step = step.withColumns({"n_words": F.size("_words").cast("long"), "_bits": F.length(F.bin(F.size("_words").cast("long")))})
    windows = "sequence(0, CAST(n_words AS int) - 3)"
    hashed = f"(xxhash64(_words[i], _words[i + 1], _words[i + 2]) & {-1 << (64 - hash_bits)}L)"
    keys = (
        "CASE WHEN n_words < 4 THEN CAST(array() AS array<bigint>) ELSE sort_array(transform("
        f"{windows}, i -> coalesce(shiftleft(shiftrightunsigned({hashed}, _bits), _bits) | i, 0L))) END"
    )
    step = compute_once(step, {"_keys": F.expr(keys)})
    # the two positions of neighbours with one hash
    pairs = (
        "filter(zip_with(slice(_keys, 1, greatest(size(_keys) - 1, 0)), slice(_keys, 2, greatest(size(_keys) - 1, 0)), (a, b) -> "
        "IF(shiftrightunsigned(a, _bits) = shiftrightunsigned(b, _bits), "
        "array(CAST(a & (shiftleft(1L, _bits) - 1) AS int), CAST(b & (shiftleft(1L, _bits) - 1) AS int)), NULL)), p -> p IS NOT NULL)"
    )
    step = compute_once(step, {"_pairs": F.expr(pairs)})
    # where one hash stands for different windows, two neighbours differ; such a text's windows are compared as they are
    differ = " OR ".join(f"_words[p[0] + {at}] <> _words[p[1] + {at}]" for at in range(3))
    spelled = f"sort_array(transform({windows}, i -> struct(array(_words[i], _words[i + 1], _words[i + 2]) AS w, i AS at)))"
    apart = (
        f"flatten(zip_with(slice({spelled}, 1, CAST(n_words AS int) - 3), slice({spelled}, 2, CAST(n_words AS int) - 3), "
        "(a, b) -> IF(a.w = b.w, array(a.at, b.at), CAST(array() AS array<int>))))"
    )
    found = f"CASE WHEN exists(_pairs, p -> {differ}) THEN {apart} ELSE flatten(_pairs) END"
    step = compute_once(step, {"_at": F.expr(f"sort_array(array_distinct({found}))")})
    # a repeated window covers three words, or as many as there are up to the next one
    covered = (
        "aggregate(zip_with(_at, slice(_at, 2, size(_at)), (a, b) -> CAST(least(coalesce(b - a, 3), 3) AS bigint)), 0L, (s, x) -> s + x)"
    )
    return step.withColumns(
        {
            "word_chars": F.char_length("_solid").cast("long"),
            "n_symbols": _matched(F.col("_solid"), r"[#*$%&|<>]"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "n_repeat_words": F.expr(covered),
            "n_lines": F.size("_lines").cast("long"),
            "n_upper": _matched(F.col("_solid"), r"\p{Lu}"),
            "n_marks": _matched(F.col("_solid"), r"[\p{P}\p{S}]"),
            "n_digits": _matched(F.col("_solid"), r"[0-9]"),
        }
    ).drop("_words", "_lines", "_solid", "_bits", "_keys", "_pairs", "_at")


def base_failed() -> Column:
    """The fixed rules: too short, or too much of it repeated."""
    return (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_REPEATED_PERCENT)


@dataclass(frozen=True)
class Condition:
    """``name >= cut`` or, if not ``above``, ``name < cut``."""

    name: str
    cut: float
    above: bool

    def column(self) -> Column:
        return F.col(self.name) >= self.cut if self.above else F.col(self.name) < self.cut


Rule = tuple[Condition, ...]


def covers(rule: Rule) -> Column:
    """Whether the rule covers a row; a null value meets no condition."""
    found = F.lit(True)
    for condition in rule:
        found = found & F.coalesce(condition.column(), F.lit(False))
    return found


def _gain(bad: int, good: int, all_bad: int, all_good: int) -> float:
    """Information gain of narrowing to ``bad`` and ``good``, as FOIL defines it."""
    if not bad:
        return -math.inf
    return bad * (math.log2(bad / (bad + good)) - math.log2(all_bad / (all_bad + all_good)))


def _binned(labelled: DataFrame, features: list[str], cuts: int) -> tuple[DataFrame, dict[str, list[float]]]:
    """The rows with ``bins``, the number of cuts at or below each feature, and the cuts.

    Cuts are quantiles of the bad and of the good rows.
    """
    shares = [at / (cuts + 1) for at in range(1, cuts + 1)]
    kinds = {f"{name} {bad}": F.percentile_approx(F.when(F.col("bad") == bad, F.col(name)), shares, 10_000) for name in features for bad in (True, False)}
    found = labelled.agg(*[column.alias(name) for name, column in kinds.items()]).first()
    edges = {name: sorted({value for bad in (True, False) for value in found[f"{name} {bad}"] or ()}) for name in features}

    def bin_of(name: str) -> Column:
        steps = F.array(*[F.lit(float(value)) for value in edges[name]]).cast("array<double>")
        return F.when(F.col(name).isNotNull(), F.size(F.filter(steps, lambda step: step <= F.col(name))))

    return labelled.select("bad", "pruning", *features, F.array(*[bin_of(name) for name in features]).alias("bins")), edges


def _counted(rows: DataFrame, tests: list[Column]) -> list[tuple[int, int]]:
    """Bad and good rows that meet each of a few tests."""
    sums = [F.count(F.when((F.col("bad") == bad) & test, 1)) for test in tests for bad in (True, False)]
    found = list(rows.agg(*sums).first())
    return list(zip(found[::2], found[1::2], strict=True))


def _narrowed(rows: DataFrame, edges: dict[str, list[float]]) -> list[tuple[Condition, int, int]]:
    """Bad and good rows under each possible condition, from one histogram per feature."""
    counts = (
        rows.select("bad", F.posexplode("bins").alias("at", "bin"))
        .where(F.col("bin").isNotNull())
        .groupBy("at", "bin")
        .agg(F.count(F.when(F.col("bad"), 1)).alias("bad"), F.count(F.when(~F.col("bad"), 1)).alias("good"))
        .collect()  # a row per feature and bin
    )
    out = []
    for at, (name, values) in enumerate(edges.items()):
        below = [[0, 0] for _ in range(len(values) + 1)]
        for row in counts:
            if row["at"] == at:
                below[row["bin"]] = [row["bad"], row["good"]]
        total = [sum(part[side] for part in below) for side in (0, 1)]
        under = [0, 0]
        for number, value in enumerate(values):
            under = [under[side] + below[number][side] for side in (0, 1)]
            out.append((Condition(name, value, False), *under))
            out.append((Condition(name, value, True), total[0] - under[0], total[1] - under[1]))
    return out


def learn_rules(
    labelled: DataFrame,
    features: list[str],
    cuts: int = 32,
    max_rules: int = 8,
    max_conditions: int = 3,
    least_precision: float = 0.95,
    least_covered: int = 8,
) -> list[Rule]:
    """Ordered rules that cover rows with ``bad`` true; the columns are ``bad``, ``pruning`` and the features.

    All labelled rows are used. A rule is kept only if its precision on the pruning rows (on all
    rows if it covers none of them) is at least ``least_precision``. No labels, or no bad or no
    good ones, give an empty list. Null feature values are covered by no condition.
    """
    if not features:
        return []
    binned, edges = _binned(labelled, features, cuts)
    left = cut(binned)
    rules: list[Rule] = []
    while len(rules) < max_rules:
        growing, rule = left.where(~F.col("pruning")), ()
        ((bad, good),) = _counted(growing, [F.lit(True)])
        while bad and good and len(rule) < max_conditions:
            options = _narrowed(growing.where(covers(rule)), edges)
            if not options:
                break
            best = max(options, key=lambda option: _gain(*option[1:], bad, good))
            if _gain(*best[1:], bad, good) <= 0:
                break
            rule, bad, good = (*rule, best[0]), best[1], best[2]
        if not rule:
            break
        # prune: the shortest beginning with the best worth on the pruning rows
        starts = [rule[: at + 1] for at in range(len(rule))]
        pruned, everywhere = (_counted(rows, [covers(start) for start in starts]) for rows in (left.where("pruning"), left))
        worth = [(b - g) / (b + g) if b + g else -1.0 for b, g in pruned]
        chosen = max(range(len(starts)), key=lambda at: (worth[at], -at))
        bad, good = pruned[chosen] if sum(pruned[chosen]) else everywhere[chosen]
        if bad < least_precision * (bad + good) or everywhere[chosen][0] < least_covered:
            break
        rules.append(starts[chosen])
        left = left.where(~covers(starts[chosen]))
    return rules


def verdict(rules: list[Rule]) -> Column:
    """False where a rule covers the row; rules are tried in order, the default is true."""
    found = F.lit(True)
    for rule in reversed(rules):
        found = F.when(covers(rule), F.lit(False)).otherwise(found)
    return found


def with_ratios(stats: DataFrame) -> DataFrame:
    return stats.withColumns({name: F.when(F.col("n_words") > 0, ratio()) for name, ratio in RATIOS.items()})


def rules_from_labels(stats: DataFrame, labels: DataFrame, **how) -> list[Rule]:
    """Learn from ``labels`` (doc_id, quality 0 or 1) over statistics rows that hold the ratios.

    Rows that fail the fixed rules are left out. Every third id by hash prunes, the others grow.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1)).groupBy("doc_id").agg(
        F.min("quality").alias("quality")
    )
    labelled = cut(
        stats.where(~base_failed())
        .join(known, "doc_id")
        .select((F.col("quality") == 0).alias("bad"), (F.crc32(F.col("doc_id").cast("string")) % 3 == 0).alias("pruning"), *RATIOS)
    )
    return learn_rules(labelled, list(RATIOS), **how)


def _judged(docs: DataFrame, labels: DataFrame, **how) -> tuple[DataFrame, list[Rule]]:
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    ratios = with_ratios(cut(text_statistics(texts).drop("text")))
    rules = rules_from_labels(ratios, labels, **how)
    kept = ~base_failed() & verdict(rules)
    return ratios.withColumns({"base_failed": base_failed(), "kept": kept}), rules


def judged(docs: DataFrame, labels: DataFrame, **how) -> tuple[DataFrame, list[Rule]]:
    """doc_id, the statistics, base_failed and kept of every row, and the learned rules.

    Repeated ids are separate rows. Rows without words fail the fixed rules. An empty table gives an
    empty result.
    """
    rows, rules = _judged(docs, labels, **how)
    return rows.select("doc_id", *BASE, "base_failed", "kept"), rules


def keep_good(docs: DataFrame, labels: DataFrame, **how) -> DataFrame:
    """The rows that are kept, with all their columns; the rules are learned as in ``judged``.

    The statistics are computed once; a row goes if its doc_id and the hash of its text were rejected.
    """
    rows, _ = _judged(docs, labels, **how)
    rejected = rows.where(~F.col("kept")).select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_text")).distinct()
    # the row travels as one column, so no name in it meets a name of this function
    given = docs.select("doc_id", F.xxhash64("text").alias("_key"), F.struct("*").alias("_row"))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_key") == F.col("_text"))
    return given.join(rejected, same, "left_anti").select("_row.*")
