"""Quality rules as a cascade that stops at the first rule a text fails, cheapest rejection first.

On a sample each rule's cost is timed and the rules that each text fails are counted per combination.
Rules are then taken greedily by the texts they newly reject per second, given the rules before them.
The order decides the work done, never which texts are kept.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.session import written

WORD_BLANKS = "[\\x20\\x09-\\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 3
SAMPLE_ROWS = 2_000


@dataclass(frozen=True)
class Rule:
    """A name and, from the column of the text, whether to reject it."""

    name: str
    rejects: Callable[[Column], Column]


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def words(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), WORD_BLANKS), lambda w: w != "")


def n_words(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def word_chars(text: Column) -> Column:
    return F.length(F.translate(F.coalesce(text, F.lit("")), BLANKS, "")).cast("long")


def n_symbols(text: Column) -> Column:
    known = F.coalesce(text, F.lit(""))
    return (F.length(known) - F.length(F.translate(known, SYMBOLS, ""))).cast("long")


def lines(text: Column) -> Column:
    """Lines that hold a word."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda s: F.translate(s, BLANKS, "") != "")


def n_dup_lines(text: Column) -> Column:
    return bound(lines(text), lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def _covered(places: Column) -> Column:
    """Words in the windows that start at ``places``, each word once."""
    def own(place: Column, i: Column, all_places: Column) -> Column:
        following = F.get(all_places, i + 1)
        return F.when(following.isNull(), WINDOW).otherwise(F.least(F.lit(WINDOW), following - place))

    return bound(F.sort_array(places), lambda p: F.aggregate(
        F.transform(p, lambda place, i: own(place, i, p)), F.lit(0), lambda total, n: total + n,
    ))


def _repeated(windows: Column) -> Column:
    """Words in windows that occur twice or more, by sorting the windows with their places."""
    def twice(x: Column, i: Column, s: Column) -> Column:
        before, after = F.get(s, F.when(i > 0, i - 1)), F.get(s, i + 1)
        return F.coalesce(before["w"] == x["w"], F.lit(False)) | F.coalesce(after["w"] == x["w"], F.lit(False))

    placed = F.sort_array(F.transform(windows, lambda w, i: F.struct(w.alias("w"), i.alias("at"))))
    return bound(placed, lambda s: _covered(
        F.transform(F.filter(s, lambda x, i: twice(x, i, s)), lambda x: x["at"])
    ))


def n_repeat_words(text: Column) -> Column:
    """Words in 3-word windows found twice or more in the text; windows are compared by 64-bit hash."""
    def of_words(w: Column) -> Column:
        windows = F.transform(
            F.sequence(F.lit(0), F.size(w) - WINDOW),
            lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)]),
        )
        repeats = bound(windows, lambda g: F.when(F.size(F.array_distinct(g)) == F.size(g), 0).otherwise(_repeated(g)))
        return F.when(F.size(w) < WINDOW, 0).otherwise(repeats)

    return bound(words(text), of_words).cast("long")


def too_short(least_words: int) -> Rule:
    return Rule("too_short", lambda t: n_words(t) < least_words)


def too_repetitive(percent: int) -> Rule:
    return Rule("too_repetitive", lambda t: 100 * n_repeat_words(t) > percent * n_words(t))


def too_many_symbols(percent: int) -> Rule:
    return Rule("too_many_symbols", lambda t: 100 * n_symbols(t) > percent * word_chars(t))


def too_many_dup_lines(percent: int) -> Rule:
    return Rule("too_many_dup_lines", lambda t: 100 * n_dup_lines(t) > percent * F.size(lines(t)))


def odd_word_length(least: int, most: int) -> Rule:
    def rejects(text: Column) -> Column:
        chars, n = word_chars(text), n_words(text)
        return (chars < least * n) | (chars > most * n)

    return Rule("odd_word_length", rejects)


RULES = (too_short(50), too_repetitive(50), too_many_symbols(5), too_many_dup_lines(50), odd_word_length(2, 15))


def ordered_rules(docs: DataFrame, rules: Sequence[Rule], sample_rows: int = SAMPLE_ROWS, seed: int = 7) -> list[Rule]:
    """``rules`` by rejection per cost on a sample of about ``sample_rows`` texts of ``docs``."""
    total = docs.count()
    if not total:
        return list(rules)
    texts = docs.select("text")
    sample = written(texts.sample(min(1.0, sample_rows / total), seed) if total > sample_rows else texts, "sample")
    text = F.col("text")
    failed = [F.coalesce(r.rejects(text), F.lit(False)).alias(str(i)) for i, r in enumerate(rules)]
    counts = [(r[:-1], r[-1]) for r in map(tuple, sample.select(*failed).groupBy(*map(str, range(len(rules)))).count().collect())]

    def seconds(rule: Rule) -> float:
        start = time.perf_counter()
        sample.select(F.count_if(rule.rejects(text))).first()
        return time.perf_counter() - start

    seconds(rules[0])
    cost = [seconds(r) for r in rules]
    order: list[int] = []
    while len(order) < len(rules):
        def gain(i: int) -> float:
            return sum(n for row, n in counts if row[i] and not any(row[j] for j in order)) / cost[i]

        rest = [i for i in range(len(rules)) if i not in order]
        order.append(max(rest, key=lambda i: (gain(i), -cost[i])))
    return [rules[i] for i in order]


def first_failed(text: Column, rules: Sequence[Rule]) -> Column:
    """Name of the first of ``rules`` that rejects, or null; later rules are not evaluated."""
    verdict = F.when(rules[0].rejects(text), rules[0].name)
    for rule in rules[1:]:
        verdict = verdict.when(rule.rejects(text), rule.name)
    return verdict


def judged(docs: DataFrame, rules: Sequence[Rule] = RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``docs`` with ``failed_rule``, null for texts to keep; a column of that name is replaced.

    A null text counts as empty. Repeated rows get the same verdict, an empty table gives none, and
    other columns pass through.
    """
    order = ordered_rules(docs, rules, sample_rows)
    return docs.withColumn("failed_rule", first_failed(F.col("text"), order))


def passing(docs: DataFrame, rules: Sequence[Rule] = RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows of ``docs`` that no rule rejects."""
    return docs.filter(first_failed(F.col("text"), ordered_rules(docs, rules, sample_rows)).isNull())
