"""Quality rules as a short-circuit cascade of built-in column expressions.

A rule is a condition that rejects a text.  ``measure`` estimates on a bounded
sample how long each rule takes and which rules reject a text together;
``cascade_order`` then takes, again and again, the rule that rejects most of
what the chosen ones leave, per unit of cost.  ``kept`` evaluates the rules in
that order inside one CASE, which stops at the first rejection, so a dear rule
runs only on texts that the cheap ones let pass.  The order changes the work,
never the verdict: a text is kept if no rule rejects it.

Words are maximal runs of characters other than space and U+0009..U+000D; a
line is a part between line feeds and counts if it holds a word.  Metrics of
a text: n_words, word_chars (code points in words), n_symbols (``#*$%&|<>``),
n_dup_lines (lines equal to an earlier line), n_repeat_words (words covered by
3-word windows that occur at least twice).  Repeats are found by sorting the
text's windows with their places, so a text costs n log n at any length.

Everything is a built-in function on the row: no shuffle, no Python worker,
no state beyond one row.  The sample is ``SAMPLE`` texts on average and twice
that at most; it decides the order only.

Defined results: NULL and empty texts have no words, all counts 0, and are
rejected; repeated rows and rows that share an id (or have none) are each
judged; columns of other names are ignored by ``quality_table`` and kept by
``keep_quality``; an empty table gives an empty result.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketlens.llm.common import save

SAMPLE = 500
GAP = "\\x20\\x09-\\x0D"
WORD = f"[^{GAP}]"
MIN_WORDS = 50
MIN_DUP_LINES = 3  # one headline that stands twice says nothing
PLACE = 10  # digits that hold a place in a text


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once (a lambda variable stands for it)."""
    return F.transform(F.array(value), body).getItem(0)


def words(text: Column) -> Column:
    return F.filter(F.split(text, f"[{GAP}]+"), lambda w: w != "")


def lines(text: Column) -> Column:
    """Lines that hold a word."""
    return F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))


def word_chars(text: Column) -> Column:
    return (F.char_length(text) - F.regexp_count(text, F.lit(f"[{GAP}]"))).cast("long")


def n_symbols(text: Column) -> Column:
    return F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long")


def n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(f"{WORD}+")).cast("long")


def n_lines(text: Column) -> Column:
    return F.size(lines(text)).cast("long")


def n_dup_lines(text: Column) -> Column:
    return let(lines(text), lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def n_letter_words(text: Column) -> Column:
    """Words that hold a letter: each is matched once, from its first letter on."""
    return F.regexp_count(text, F.lit(f"\\p{{L}}{WORD}*")).cast("long")


def n_shouted(text: Column) -> Column:
    """Runs of two and more capital letters."""
    return F.regexp_count(text, F.lit("\\p{Lu}{2,}")).cast("long")


def n_repeat_words(text: Column, size: int = 3) -> Column:
    """Words covered by windows of ``size`` words that the text holds at least twice.

    Windows that all hash differently are all different; else they are sorted
    as text, so a clash of hashes costs time and changes nothing.
    """

    def hashed(w: Column, i: Column) -> Column:
        return F.xxhash64(*[F.get(w, i + k) for k in range(size)])

    def window(w: Column, i: Column) -> Column:
        # words hold no space, so window and place can be told apart, and equal windows sort together
        return F.concat_ws(" ", *[F.get(w, i + k) for k in range(size)], F.lpad(i.cast("string"), PLACE, "0"))

    def covered(places: Column) -> Column:
        reach = F.transform(places, lambda p, i: F.least(F.lit(size), F.coalesce(F.get(places, i + 1), p + size) - p))
        return F.aggregate(reach, F.lit(0).cast("long"), lambda total, x: total + x)

    def repeated(ordered: Column, keys: Column) -> Column:
        twice = F.filter(
            F.transform(
                ordered,
                lambda x, i: F.when(
                    F.get(keys, i).eqNullSafe(F.get(keys, i - 1)) | F.get(keys, i).eqNullSafe(F.get(keys, i + 1)),
                    F.right(x, F.lit(PLACE)).cast("long"),
                ),
            ),
            lambda place: place.isNotNull(),
        )
        return let(F.sort_array(twice), covered)

    def of_words(w: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(w) - size)
        hashes = F.transform(places, lambda i: hashed(w, i))
        differ = let(hashes, lambda h: F.size(F.array_distinct(h)) == F.size(h))
        windows = F.sort_array(F.transform(places, lambda i: window(w, i)))
        key = lambda x: F.substr(x, F.lit(1), F.char_length(x) - (PLACE + 1))
        found = let(windows, lambda ordered: let(F.transform(ordered, key), lambda keys: repeated(ordered, keys)))
        return F.when((F.size(w) <= size) | differ, F.lit(0).cast("long")).otherwise(found)

    return let(words(text), of_words)


METRICS: dict[str, Callable[[Column], Column]] = {
    "n_words": n_words,
    "word_chars": word_chars,
    "n_symbols": n_symbols,
    "n_dup_lines": n_dup_lines,
    "n_repeat_words": n_repeat_words,
    "n_lines": n_lines,
    "n_letter_words": n_letter_words,
    "n_shouted": n_shouted,
}
BASE_METRICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    """``rejects`` gets the metrics in ``needs``; whole numbers only, so nothing is rounded."""

    name: str
    needs: tuple[str, ...]
    rejects: Callable[..., Column]

    def on(self, metric: Callable[[str], Column]) -> Column:
        """The condition, each metric being the column that ``metric`` gives for its name."""
        return self.rejects(*[metric(m) for m in self.needs])


RULES = (
    Rule("few_words", ("n_words",), lambda n: n < MIN_WORDS),
    Rule("repeated_words", ("n_words", "n_repeat_words"), lambda n, repeat: repeat * 100 > n * 50),
    Rule("symbols", ("n_words", "n_symbols"), lambda n, symbols: symbols * 10 > n),
    Rule("repeated_lines", ("n_lines", "n_dup_lines"), lambda n, dup: (dup >= MIN_DUP_LINES) & (dup * 100 > n * 30)),
    Rule("short_words", ("n_words", "word_chars"), lambda n, chars: chars < n * 3),
    Rule("long_words", ("n_words", "word_chars"), lambda n, chars: chars > n * 10),
    Rule("no_letters", ("n_words", "n_letter_words"), lambda n, letters: letters * 100 < n * 80),
    Rule("shouting", ("n_words", "n_shouted"), lambda n, shouted: shouted * 2 > n),
)
BASE_RULES = RULES[:2]


@dataclass(frozen=True)
class Measured:
    """What the sample tells: seconds per rule and, per set of rejecting rules, the number of texts."""

    seconds: dict[str, float]
    together: dict[frozenset[str], int]


def _text_of(docs: DataFrame, text_col: str) -> Column:
    return F.coalesce(docs[text_col].cast("string"), F.lit(""))


def measure(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text", sample: int = SAMPLE, seed: int = 11) -> Measured:
    """Cost and rejections of every rule on a bounded sample of ``docs``.

    The sample is written once; a job per rule sums its rejections, and what a
    job over the bare texts takes is taken off its time.  One more job counts
    which rules reject together (at most one row per set of rules comes back).
    """
    total = docs.count()
    if total == 0 or not rules:
        return Measured({r.name: 0.0 for r in rules}, {})
    texts = docs.select(_text_of(docs, text_col).alias("text"))
    if total > sample:
        texts = texts.sample(fraction=sample / total, seed=seed).limit(2 * sample)
    texts = save(texts.coalesce(4), "quality-sample")

    def seconds(condition: Column) -> float:
        began = time.perf_counter()
        texts.agg(F.sum(condition.cast("int"))).collect()
        return time.perf_counter() - began

    on_text = lambda name: METRICS[name](F.col("text"))
    bare = F.length("text") < 0
    seconds(bare)  # the first job also loads classes
    floor = min(seconds(bare) for _ in range(2))
    spent = {r.name: max(seconds(r.on(on_text)) - floor, 1e-4) for r in rules}
    found = texts.select(F.array_compact(F.array(*[F.when(r.on(on_text), F.lit(r.name)) for r in rules])).alias("names"))
    rows = found.groupBy("names").count().collect()  # at most 2 ** len(rules) rows
    return Measured(spent, {frozenset(r["names"]): r["count"] for r in rows})


def cascade_order(rules: tuple[Rule, ...], measured: Measured) -> tuple[Rule, ...]:
    """Rules by rejections per second among the texts that the rules before them leave; ties as given."""
    left, rest, order = dict(measured.together), list(rules), []
    while rest:
        gain = {
            r.name: sum(n for names, n in left.items() if r.name in names) / max(measured.seconds.get(r.name, 0.0), 1e-4)
            for r in rest
        }
        # among rules that reject nothing more, the cheap ones first
        best = max(rest, key=lambda r: (gain[r.name], -measured.seconds.get(r.name, 0.0)))
        order.append(best)
        rest.remove(best)
        left = {names: n for names, n in left.items() if best.name not in names}
    return tuple(order)


def kept(rules: tuple[Rule, ...], metric: Callable[[str], Column]) -> Column:
    """Whether no rule rejects; one CASE, left at the first rejection."""
    if not rules:
        return F.lit(True)
    cascade = F.when(rules[0].on(metric), F.lit(False))
    for rule in rules[1:]:
        cascade = cascade.when(rule.on(metric), F.lit(False))
    return cascade.otherwise(F.lit(True))


def quality_table(
    docs: DataFrame,
    rules: tuple[Rule, ...] = RULES,
    id_col: str = "doc_id",
    text_col: str = "text",
    sample: int = SAMPLE,
) -> DataFrame:
    """doc_id, the base metrics, base_failed and kept of every row.

    The metrics that are returned anyway are computed once and read by the
    cascade; the others run only where the cascade gets to them.
    """
    order = cascade_order(rules, measure(docs, rules, text_col, sample))
    rows = docs.select(docs[id_col].alias("doc_id"), _text_of(docs, text_col).alias("text"))
    rows = rows.select("doc_id", "text", *[METRICS[m](F.col("text")).alias(m) for m in BASE_METRICS])
    metric = lambda m: F.col(m) if m in BASE_METRICS else METRICS[m](F.col("text"))
    failed = BASE_RULES[0].on(F.col) | BASE_RULES[1].on(F.col)
    return rows.select("doc_id", *BASE_METRICS, failed.alias("base_failed"), (~failed & kept(order, metric)).alias("kept"))


def keep_quality(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text", sample: int = SAMPLE) -> DataFrame:
    """The rows whose text no rule rejects, all columns."""
    order = cascade_order(rules, measure(docs, rules, text_col, sample))
    text = _text_of(docs, text_col)
    return docs.where(kept(order, lambda m: METRICS[m](text)))
