"""Quality rules as a short-circuit cascade, in DataFrame functions only.

Every rule rejects texts by a condition on measures of the text. On a written sample, each rule is
run by itself to time it, and its verdicts are counted; rules are then asked in the order of
rejection per cost, and the first that rejects decides. A measure is taken just before the first rule
that needs it, and only of rows that no earlier rule rejected. The order saves work; it never
changes what is kept, only which of several rejecting rules is named.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.settings import forget, settle

# Rows sampled for the order of the rules; files of the sample; runs of which the fastest is a rule's time.
SAMPLE_ROWS, SAMPLE_FILES, RUNS = 2000, 4, 2
# Words of a repeated window; ASCII white space; the symbols that are counted (fixed values).
WINDOW, BLANKS, SYMBOLS = 8, " \t\n\x0b\x0c\r", "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once per row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def without(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, r"[\x09-\x0D\x20]+"), "")


def repeated_words(words: Column, size: int = WINDOW) -> Column:
    """Words in windows of ``size`` words that occur twice or more in the list.

    Windows are compared by hash; only lists with a repeated hash are sorted, by two hashes.
    """
    count = F.size(words)

    def covered(places: Column) -> Column:
        steps = F.transform(places, lambda p, k: F.least(F.coalesce(F.get(places, k + 1) - p, F.lit(size)), F.lit(size)))
        return F.aggregate(steps, F.lit(0), lambda total, s: total + s)

    def repeated(order: Column) -> Column:
        def same(x: Column, k: Column) -> Column:
            other = F.get(order, k)
            return F.coalesce((other["a"] == x["a"]) & (other["b"] == x["b"]), F.lit(False))

        marked = F.transform(
            order,
            lambda x, k: F.when(F.when(k > 0, same(x, k - 1)).otherwise(F.lit(False)) | same(x, k + 1), x["at"]),
        )
        return let(F.sort_array(F.filter(marked, lambda p: p.isNotNull())), covered)

    def by_hash(hashes: Column) -> Column:
        def deep() -> Column:
            both = F.transform(
                hashes,
                lambda h, k: F.struct(
                    h.alias("a"), F.xxhash64(F.lit(size), F.slice(words, k + 1, F.lit(size))).alias("b"), k.alias("at")
                ),
            )
            return let(F.sort_array(both), repeated)

        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0).otherwise(deep())

    hashes = F.transform(F.sequence(F.lit(1), count - (size - 1)), lambda i: F.xxhash64(F.slice(words, i, F.lit(size))))
    return F.when(count < size, 0).otherwise(let(hashes, by_hash))


def lines_of(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda line: F.length(F.translate(line, BLANKS, "")) > 0)


def _text(text: Column) -> Column:
    return text


# Every measure: what the text is cut into, and the number taken from that.
Measure = tuple[Callable[[Column], Column], Callable[[Column], Column]]
MEASURES: dict[str, Measure] = {
    "n_words": (words_of, F.size),
    "word_chars": (_text, lambda text: F.length(F.translate(text, BLANKS, ""))),
    "n_symbols": (_text, lambda text: without(text, SYMBOLS)),
    "n_lines": (lines_of, F.size),
    "n_dup_lines": (lines_of, lambda lines: F.size(lines) - F.size(F.array_distinct(lines))),
    "n_repeat_words": (words_of, repeated_words),
}
MORE: dict[str, Measure] = {"n_text_chars": (_text, F.length), "n_capitals": (_text, lambda text: without(text, CAPITALS))}


def take(
    docs: DataFrame, names: Sequence[str], text_col: str = "text", where: Column | None = None, own: Mapping[str, Measure] | None = None
) -> DataFrame:
    """``docs`` with the named measures (long), null in rows where ``where`` does not hold.

    Measures of the same cut share it. Null texts count as empty. Names that ``docs`` has already are replaced.
    """
    known = {**MEASURES, **MORE, **(own or {})}
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    cuts: dict[Callable, list[str]] = {}
    for name in names:
        cuts.setdefault(known[name][0], []).append(name)
    made, read = {}, {}

    def numbers(group: list[str]) -> Callable[[Column], Column]:
        return lambda part: F.struct(*(known[m][1](part).cast("long").alias(m) for m in group))

    for i, (cut, group) in enumerate(cuts.items()):
        found = let(cut(text), numbers(group))
        made[f"_cut{i}"] = found if where is None else F.when(where, found)
        read |= {m: F.col(f"_cut{i}.{m}") for m in group}
    return docs.withColumns(made).withColumns({m: read[m] for m in names}).drop(*made) if made else docs


def measures(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words (long).

    A null text counts as empty: all are 0. Names that ``docs`` has already are replaced.
    """
    return take(docs, list(MEASURES), text_col)


@dataclass(frozen=True)
class Rule:
    """``reject`` is true for texts that go; ``work`` is about how many steps one test takes.

    ``needs`` names the measures that both read; ``own`` defines those that ``MEASURES`` and ``MORE`` lack.
    """

    name: str
    reject: Column
    work: Column
    needs: tuple[str, ...] = ()
    own: Mapping[str, Measure] | None = None


def default_rules() -> list[Rule]:
    """Rules over the measures."""
    words, chars, symbols, lines, again, repeated, length, capitals = (F.col(m) for m in (*MEASURES, *MORE))
    return [
        Rule("few words", words < 20, words, ("n_words",)),
        Rule("repeated words", 100 * repeated > 30 * words, words * (WINDOW + 4), ("n_words", "n_repeat_words")),
        Rule("repeated lines", 2 * again > lines, length + lines, ("n_text_chars", "n_lines", "n_dup_lines")),
        Rule("symbols", 5 * symbols > words, length, ("n_text_chars", "n_words", "n_symbols")),
        Rule("word length", (chars > 20 * words) | (chars < 2 * words), length + words, ("n_text_chars", "n_words", "word_chars")),
        Rule("shouting", 2 * capitals > chars, 2 * length, ("n_text_chars", "word_chars", "n_capitals")),
    ]


def _seconds(frame: DataFrame, *asked: Column) -> tuple[float, list]:
    """Time of the fastest of ``RUNS`` aggregations of ``frame``, and their row."""
    times, row = [], None
    for _ in range(RUNS):
        start = time.perf_counter()
        row = frame.agg(*asked).first()
        times.append(time.perf_counter() - start)
    return min(times), row


def time_rules(sample: DataFrame, rules: list[Rule], text_col: str = "text") -> dict[str, float]:
    """Seconds per step of ``work`` of every rule, run by itself on ``sample`` (a small table).

    The time of reading the texts alone is taken off; at least a hundredth of it stays.
    """
    empty, _ = _seconds(sample, F.sum(F.length(F.col(text_col).cast("string"))))
    rates = {}
    for rule in rules:
        frame = take(sample, rule.needs, text_col, own=rule.own)
        took, row = _seconds(frame, F.count_if(rule.reject), F.sum(rule.work.cast("double")))
        rates[rule.name] = max(took - empty, 0.01 * empty) / max(row[1] or 0.0, 1.0)
    return rates


def order_rules(
    docs: DataFrame, rules: list[Rule], sample_rows: int | None = SAMPLE_ROWS, rates: Mapping[str, float] | None = None
) -> list[Rule]:
    """Greedy order by rejection per cost, both from a sample of about ``sample_rows`` rows (None: all of ``docs``).

    ``docs`` has the measures. A rule's cost is its work on the rows that earlier rules left, times its rate (1 if not given).
    """
    total = docs.count() if sample_rows else 0
    if sample_rows and not total:
        return rules
    sample = docs.sample(fraction=min(1.0, sample_rows / total), seed=17) if sample_rows else docs
    flags = [F.coalesce(r.reject, F.lit(False)).alias(f"r{i}") for i, r in enumerate(rules)]
    costs = [F.coalesce(r.work, F.lit(0)).cast("double").alias(f"w{i}") for i, r in enumerate(rules)]
    names = [f"r{i}" for i in range(len(rules))]
    # One row per combination of verdicts: at most 2**rules rows.
    seen = sample.select(*flags, *costs).groupBy(*names).agg(
        F.count(F.lit(1)).alias("n"), *(F.sum(f"w{i}").alias(f"w{i}") for i in range(len(rules)))
    ).collect()
    rate = [(rates or {}).get(r.name, 1.0) for r in rules]
    least = min(rate)
    rest, left, order = [r.asDict() for r in seen], list(range(len(rules))), []
    while left:
        def gain(i: int) -> tuple[float, int]:
            hit = sum(r["n"] for r in rest if r[f"r{i}"])
            cost = sum(r[f"w{i}"] for r in rest) * rate[i] / least
            return hit / (cost + 1.0), -i

        best = max(left, key=gain)
        order.append(best)
        left.remove(best)
        rest = [r for r in rest if not r[f"r{best}"]]
    return [rules[i] for i in order]


def cascade(docs: DataFrame, rules: list[Rule], text_col: str = "text", have: Sequence[str] | None = None) -> DataFrame:
    """``docs`` with ``rejected_by`` (the first rule that rejects, else null) and ``kept``.

    Rules are asked in the given order; a rule whose condition is null does not reject. Measures that
    ``have`` does not name (None: the columns of ``docs``) are taken just before the first rule that needs
    them, of the rows still undecided, and are null in the others.
    """
    have = list(docs.columns if have is None else have)
    docs = docs.withColumn("rejected_by", F.lit(None).cast("string"))
    for rule in rules:
        new = [m for m in rule.needs if m not in have]
        open_ = F.col("rejected_by").isNull()
        docs = take(docs, new, text_col, where=open_, own=rule.own)
        docs = docs.withColumn("rejected_by", F.coalesce(F.col("rejected_by"), F.when(rule.reject, F.lit(rule.name))))
        have += new
    return docs.withColumn("kept", F.col("rejected_by").isNull())


def apply_rules(
    docs: DataFrame, rules: list[Rule] | None = None, text_col: str = "text", full: Sequence[str] = tuple(MEASURES)
) -> DataFrame:
    """Order and cascade: ``docs`` with measures, ``rejected_by`` and ``kept``.

    The measures in ``full`` are taken of every row; ``full=()`` takes none but of rows that a rule still
    asks about. Other measures are dropped again. Null and empty texts have measures 0 and are rejected
    for few words; repeated rows and null ids are rows like others; an empty table stays empty with the
    new columns. Columns of ``docs`` with the names of new columns are replaced, all others stay.
    """
    rules = default_rules() if rules is None else rules
    asked = dict.fromkeys(m for r in rules for m in r.needs)
    own = {name: m for r in rules for name, m in (r.own or {}).items()}
    out = [*full, "rejected_by", "kept"]
    names = [c for c in docs.columns if c not in out]
    # Columns of the input go by numbers, so that none is taken for a measure.
    docs = docs.select(F.col(text_col).cast("string").alias("_text"), *(F.col(c).alias(f"_in{i}") for i, c in enumerate(names)))
    total = docs.count()
    if total:
        share = min(1.0, SAMPLE_ROWS / total)
        sample = settle(docs.select("_text").sample(fraction=share, seed=5).repartition(SAMPLE_FILES), "sample")
        rates = time_rules(sample, rules, "_text")
        rules = order_rules(take(sample, list(asked), "_text", own=own), rules, None, rates)
        forget(sample)
    first = take(docs, list(full), "_text", own=own)
    return cascade(first, rules, "_text", full).select(*(F.col(f"_in{i}").alias(c) for i, c in enumerate(names)), *out)
