"""Functions of a text as Spark columns: facts, tags, normal forms, passages and ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexispark.functions import values as V


#: Java's classes, borders of words and cases follow Unicode, as the texts have accents.
UNICODE = "(?U)"


def found(text: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(text, F.lit(UNICODE + pattern), F.lit(group))


def holds(text: Column, pattern: str) -> Column:
    return text.rlike(UNICODE + pattern)


def found_where(trigger: str, text: Column, pattern: str, group: int = 0) -> Column:
    """found(), where the text holds a trigger that every match has; other texts are spared the pattern."""
    return F.when(holds(text, trigger), found(text, pattern, group)).otherwise(F.array().cast("array<string>"))


def once(value: Column, body) -> Column:
    """body(value) with value computed once a row, also where body uses it inside a lambda for each element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def strip(text: Column) -> Column:
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def words(text: Column) -> Column:
    return found(text, r"\S+")


def word_count(text: Column) -> Column:
    return F.size(words(text))


def tokens(text: Column) -> Column:
    """Search terms in order, with repeats, stop words left out."""
    return F.filter(found(F.lower(text), V.TOKEN), lambda x: (F.length(x) >= 2) & ~x.isin(V.SEARCH_STOP_WORDS))


def dates(text: Column) -> Column:
    return found_where(V.HAS_DATE, text, V.DATE)


def money(text: Column) -> Column:
    return found_where(V.HAS_MONEY, text, V.MONEY)


def numbers(text: Column, dates_of: Column) -> Column:
    """Percentages, then numbers that are not one of the dates written without - and /."""
    plain = F.transform(dates_of, lambda d: F.replace(F.replace(d, F.lit("-"), F.lit("")), F.lit("/"), F.lit("")))
    others = once(plain, lambda known: F.filter(found(text, V.NUMBER), lambda n: ~F.array_contains(known, n)))
    return F.when(holds(text, V.HAS_DIGIT), F.concat(found(text, V.PERCENTAGE), others)).otherwise(F.array().cast("array<string>"))


def emails(text: Column) -> Column:
    return found_where(V.HAS_EMAIL, text, V.EMAIL)


def phones(text: Column) -> Column:
    return found_where(V.HAS_PHONE, text, V.PHONE)


def urls(text: Column) -> Column:
    return found_where(V.HAS_URL, text, V.URL)


def defined_terms(text: Column) -> Column:
    terms = F.filter(F.transform(found_where(V.HAS_TERM, text, V.DEFINED_TERM, 1), strip), lambda t: F.length(t) > 2)
    return F.concat(terms, found_where(V.HAS_ABBREVIATION, text, V.ABBREVIATION, 1))


def key_nouns(text: Column) -> Column:
    """Distinct capitalised phrases."""
    return F.array_distinct(F.filter(found(text, V.KEY_NOUN, 1), lambda n: F.length(n) > 3))


def plain_nouns(text: Column) -> Column:
    """Distinct capitalised single words: whole words of the pattern WORD that PLAIN_NOUN matches, found in one pass."""
    return F.array_distinct(found(text, rf"(?<!{V.WORD[:-1]}){V.PLAIN_NOUN[1:-1]}+(?!{V.WORD[:-1]})"))


def normalised(text: Column) -> Column:
    flat = F.regexp_replace(F.regexp_replace(F.lower(text), r"[\n\r\t]+", " "), r"[^\p{L}\p{N}_\s]", " ")
    return strip(F.regexp_replace(flat, r"\s+", " "))


def truncated(text: Column, size: int, marks: str = ".!?") -> Column:
    """At most ``size`` characters, cut after the last sentence mark beyond the middle."""
    cut = F.left(text, F.lit(size))
    after = [F.when(F.instr(F.reverse(cut), m) > 0, F.length(cut) - F.instr(F.reverse(cut), m) + 1).otherwise(0) for m in marks]
    last = F.greatest(*after) if len(after) > 1 else after[0]
    return F.when(F.length(text) <= size, text).when(last - 1 > size // 2, F.left(text, last)).otherwise(cut)


def boilerplate_hits(text: Column) -> Column:
    low = F.lower(text)
    return sum((F.contains(low, F.lit(m)).cast("int") for m in V.BOILERPLATE[1:]), F.contains(low, F.lit(V.BOILERPLATE[0])).cast("int"))


def is_boilerplate(text: Column, n_words: Column) -> Column:
    hits = boilerplate_hits(text)
    return (hits >= 2) | ((n_words < 20) & (hits >= 1))


def contents_lines(text: Column) -> Column:
    return F.filter(F.transform(F.split(text, "\n"), strip), lambda x: F.length(x) > 0)


def share(array: Column, holds) -> Column:
    """Share of an array's elements for which ``holds``; 0 for an empty one."""
    return F.when(F.size(array) == 0, 0.0).otherwise(F.size(F.filter(array, holds)) / F.greatest(F.size(array), F.lit(1)))


def is_contents_table(text: Column) -> Column:
    lines = contents_lines(text)
    return (F.size(lines) >= 2) & (share(lines, lambda x: x.rlike(r"\d+$")) > 0.3) & (share(lines, lambda x: F.length(x) < 80) > 0.6)


def chunks(context: Column) -> Column:
    """Runs of four words of a normalised text, two words apart."""

    def cut(w: Column) -> Column:
        runs = F.transform(F.sequence(F.lit(1), F.greatest(F.size(w) - 3, F.lit(1)), F.lit(2)), lambda i: F.array_join(F.slice(w, i, F.lit(4)), " "))
        return F.when(F.size(w) < 4, F.array().cast("array<string>")).otherwise(runs)

    return once(F.array_remove(F.split(context, " "), ""), cut)


def word_pairs(text: Column) -> Column:
    """Distinct neighbouring words of a normalised text."""
    pairs = lambda w: F.zip_with(w, F.slice(w, F.lit(2), F.greatest(F.size(w) - 1, F.lit(0))), lambda a, b: F.concat_ws(" ", a, b))
    return F.array_distinct(once(F.array_remove(F.split(text, " "), ""), pairs))


def match_ratio(chunks_of: Column, context: Column, document: Column) -> Column:
    """Share of a context's chunks that a normalised document contains; whole containment for short ones."""

    def ratio(d: Column) -> Column:
        short = F.when((context != "") & F.contains(d, context), 1.0).otherwise(0.0)
        return F.when(F.size(chunks_of) == 0, short).otherwise(share(chunks_of, lambda c: F.contains(d, c)))

    return once(document, ratio)


def grounding_ratio(answer: Column, passage: Column) -> Column:
    """Share of an answer's words of four letters or more that the normalised passage contains."""

    def ratio(p: Column, a: Column) -> Column:
        long = F.filter(F.split(a, " "), lambda x: F.length(x) >= 4)
        whole = F.when((a != "") & F.contains(p, a), 1.0).otherwise(0.0)
        return F.when(F.size(long) == 0, whole).otherwise(share(long, lambda w: F.contains(p, w)))

    return once(passage, lambda p: once(answer, lambda a: ratio(p, a)))


def topic_words(question: Column) -> Column:
    flat = F.regexp_replace(F.lower(question), r"[^\p{L}\p{N}_\s]", " ")
    return F.filter(found(flat, r"\S+"), lambda w: (F.length(w) >= 6) & ~w.isin(V.TOPIC_STOP_WORDS))


def basename(path: Column) -> Column:
    return F.lower(F.substring_index(F.replace(path, F.lit("\\"), F.lit("/")), "/", -1))


def title_of(name: Column) -> Column:
    return F.initcap(F.replace(name, F.lit("_"), F.lit(" ")))


def shortened(text: Column, size: int) -> Column:
    return F.when(F.length(text) > size, F.concat(F.left(text, F.lit(size)), F.lit("…"))).otherwise(text)
