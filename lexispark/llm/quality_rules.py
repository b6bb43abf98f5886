"""Quality rules: a table of thresholds compiled into one projection of built-in expressions.

``Rule`` rows compare two measures of a text: ``100 * left <= percent * right`` (or ``>=``).
``apply_rules`` compiles measures and rules to Spark SQL; no user function runs, the work
is done row by row in one scan, and no row moves.

Defined cases: a null text has no words and fails the base rule; so does an empty one. Rows
that repeat are judged each on its own. Windows of eight words are compared by 64-bit hashes
within one text. Columns of the input other than doc_id and text are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = r"[\\x20\\x09-\\x0D]"
WINDOW = 8

# Frequent function words of English, French, German and Spanish, without accents.
STOP_WORDS = (
    "the of and to a in is that it for on was with as be by this are at from he or an not which "
    "de la le les et des en un une du que est pour qui dans au sur ne se il ce avec pas par "
    "der die und das den von zu mit sich des auf ist im dem nicht ein eine auch es "
    "el los las y del por con una su lo como para al no"
).split()


@dataclass(frozen=True)
class Rule:
    """Holds where 100 * left <= percent * right; with at_least, where it is >=."""

    name: str
    left: str
    percent: int
    right: str
    at_least: bool = False

    def sql(self) -> str:
        return f"(100 * {self.left} {'>=' if self.at_least else '<='} {self.percent} * {self.right})"


#: A text that breaks one of these is not worth a further look.
BASE_RULES = (
    Rule("long_enough", "n_words", 2000, "one", at_least=True),
    Rule("few_repeats", "n_repeat_words", 30, "n_words"),
)
RULES = (
    Rule("word_length_low", "word_chars", 200, "n_words", at_least=True),
    Rule("word_length_high", "word_chars", 1400, "n_words"),
    Rule("few_symbols", "n_symbols", 6, "word_chars"),
    Rule("stop_words", "n_stop_words", 4, "n_words", at_least=True),
    Rule("few_repeated_lines", "n_dup_lines", 30, "n_lines"),
    Rule("few_loud_words", "n_loud_words", 30, "n_words"),
)


def bound(name: str, value: str, body: str) -> str:
    """SQL for body with value computed once a row under the name, also for use inside lambdas."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def repeated_words(words: str) -> str:
    """SQL: words of an array that lie in windows of eight words found twice or more in it."""
    # Windows in hash order; those with an equal neighbour, in text order; the words they cover.
    covered = (
        "aggregate(sort_array(transform(filter(o, (s, k) -> coalesce(get(o, k - 1).h = s.h, false) or coalesce(get(o, k + 1).h = s.h, false)), s -> s.i)), "
        f"struct(0L as total, 0L as upto), (acc, p) -> struct(acc.total + p + {WINDOW} - greatest(p, acc.upto) as total, p + {WINDOW} as upto), acc -> acc.total)"
    )
    ordered = bound("o", "sort_array(transform(v, (h, i) -> struct(h as h, cast(i as bigint) as i)))", covered)
    some = f"if(size(array_distinct(v)) = size(v), 0L, {ordered})"
    windows = bound("v", f"transform(sequence(1, size(x) - {WINDOW - 1}), i -> xxhash64(slice(x, i, {WINDOW})))", some)
    return f"if(size({words}) < {WINDOW}, 0L, {bound('x', f'transform({words}, w -> xxhash64(w))', windows)})"


def measures() -> str:
    """SQL for a struct of the measures of ``text``."""
    stop = ", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS))
    body = f"""named_struct(
        'one', 1L, 'n_words', cast(size(w) as bigint),
        'word_chars', cast(length(array_join(w, '')) as bigint),
        'n_symbols', cast(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '')) as bigint),
        'n_lines', cast(size(l) as bigint), 'n_dup_lines', cast(size(l) - size(array_distinct(l)) as bigint),
        'n_repeat_words', {repeated_words("w")},
        'n_stop_words', cast(size(filter(w, v -> lower(v) in ({stop}))) as bigint),
        'n_loud_words', cast(size(filter(w, v -> endswith(v, '!!'))) as bigint))"""
    lines = bound("l", rf"filter(split(t, '\n'), v -> v rlike '[^\\x20\\x09-\\x0D]')", body)
    return bound("t", "coalesce(text, '')", bound("w", f"array_remove(split(t, '{SPACE}+'), '')", lines))


def apply_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES, base: tuple[Rule, ...] = BASE_RULES) -> DataFrame:
    """doc_id, the measures, base_failed, kept, and the names of the broken rules."""
    measured = docs.select("doc_id", F.expr(measures()).alias("m")).select("doc_id", "m.*")
    broken = ", ".join(f"if({r.sql()}, null, '{r.name}')" for r in (*base, *rules))
    base_failed = " or ".join(f"not {r.sql()}" for r in base) or "false"
    verdict = " and ".join(r.sql() for r in (*base, *rules)) or "true"
    return measured.selectExpr("*", f"({base_failed}) as base_failed", f"({verdict}) as kept", f"array_compact(cast(array({broken}) as array<string>)) as broken").drop("one")
