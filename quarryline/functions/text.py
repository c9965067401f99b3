"""Text as columns: tokens, cleaning, slugs, classes. Nothing here leaves generated code."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words that say nothing about what a query asks for. Fixed values.
STOPWORDS = (
    "a", "an", "and", "are", "as", "at", "available", "be", "by", "can", "do", "does", "feature", "features", "for", "how", "in", "is", "it", "kinds", "language", "of", "on", "or",
    "programming", "rust", "support", "supports", "techniques", "that", "the", "to", "what", "when", "where", "which", "why", "with",
)
#: What parts sentences: white space after an end mark and before what can begin a sentence. A fixed value.
SENTENCE_GAP = r"(?<=[.!?])\s+(?=[A-Z0-9(`\[])"
#: Statement types by the first pattern that is found, with their confidence. Fixed values.
STATEMENT_TYPES = (
    ("constraint", r"(?i)\b(must|shall|required|cannot|must not|only|never|forbidden)\b", 0.88),
    ("definition", r"(?i)\b(is|are|means|refers to|called|denotes|defined as)\b", 0.76),
    ("behavior", "", 0.68),
)
#: What cleaning takes out of Markdown, in this order. Fixed values.
MARKUP = (r"(?s)```.*?```", r"(?s)<!--.*?-->", r"\[![A-Z]+\]", r"\[\^[^\]]+\]", r"\br\[[^\]]+\]", "`")


def raw_tokens(text: Column | str) -> Column:
    """All tokens in order: runs of a-z, 0-9 and _ in lower case."""
    return F.regexp_extract_all(F.lower(F.col(text) if isinstance(text, str) else text), F.lit("[a-z0-9_]+"), F.lit(0))


def tokens(text: Column | str, stopwords: Sequence[str] = STOPWORDS) -> Column:
    """The distinct tokens that are no stopwords."""
    return F.array_except(raw_tokens(text), F.array(*[F.lit(w) for w in stopwords]))


def query_tokens(text: Column | str) -> Column:
    """The distinct tokens without stopwords or, where none is left, all of them."""
    kept = tokens(text)
    return F.when(F.size(kept) > 0, kept).otherwise(F.array_distinct(raw_tokens(text)))


def singular(token: Column) -> Column:
    """A token of more than four letters without its final s, unless it ends in ss."""
    return F.when((F.length(token) > 4) & token.endswith("s") & ~token.endswith("ss"), F.substring(token, F.lit(1), F.length(token) - 1)).otherwise(token)


def clean_markup(text: Column | str) -> Column:
    """Text without fences, comments, tags, footnote marks, rule marks and backticks, white space as single spaces."""
    out = F.col(text) if isinstance(text, str) else text
    for pattern in MARKUP:
        out = F.regexp_replace(out, pattern, " ")
    return F.trim(F.regexp_replace(out, r"\s+", " "))


def sentences(text: Column | str) -> Column:
    """The sentences of cleaned text, without blanks."""
    return F.filter(F.transform(F.split(text, SENTENCE_GAP), lambda s: F.trim(s)), lambda s: F.length(s) > 0)


def statement_type(text: Column | str) -> tuple[Column, Column]:
    """The type of a statement and the confidence in it."""
    kind, sure = F.lit(STATEMENT_TYPES[-1][0]), F.lit(STATEMENT_TYPES[-1][2])
    col = F.col(text) if isinstance(text, str) else text
    for name, pattern, confidence in reversed(STATEMENT_TYPES[:-1]):
        kind, sure = F.when(col.rlike(pattern), name).otherwise(kind), F.when(col.rlike(pattern), confidence).otherwise(sure)
    return kind, sure


#: A fenced block: from a line that begins with three backticks to the next such line, or to the end.
FENCE = r"(?ms)^[ \t]*```.*?(?:\n[ \t]*```[^\n]*|\z)"


def fenced_blocks(text: Column | str) -> Column:
    """The blocks of a text (F6): what blank lines part, but each fenced block whole and by itself, with its own blank lines."""
    col = F.col(text) if isinstance(text, str) else text
    fences, between = F.regexp_extract_all(col, F.lit(FENCE), F.lit(0)), F.split(col, FENCE)
    parts = F.transform(F.sequence(F.lit(0), F.size(fences)), lambda i: F.concat(F.split(F.coalesce(F.get(between, i), F.lit("")), r"\n[ \t\r]*\n"), F.array_compact(F.array(F.get(fences, i)))))
    return F.filter(F.transform(F.flatten(parts), lambda b: F.btrim(b, F.lit(" \t\r\n"))), lambda b: b != "")


#: The root that topics leave out, and the page that stands for its folder. Fixed values.
TOPIC_ROOT, TOPIC_INDEX = "^coding-guidelines/", "/index$"


def topic(docname: Column | str, category: Column | str) -> Column:
    """A document's name as a topic (F12): its path in lower case without the common root and a closing index, each step cut down to letters, digits, _ and -.

    A document without a name has its category's, cut down in the same way, or else general.
    """
    low = lambda c: F.lower(F.trim(F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))))
    name = F.btrim(F.regexp_replace(F.btrim(F.regexp_replace(F.translate(low(docname), "\\", "/"), TOPIC_ROOT, ""), F.lit("/")), TOPIC_INDEX, ""), F.lit("/"))
    steps = F.transform(F.split(name, "/"), lambda s: F.coalesce(F.nullif(F.btrim(F.regexp_replace(s, "[^a-z0-9_-]+", "-"), F.lit("-")), F.lit("")), F.lit("misc")))
    other = F.coalesce(F.nullif(low(category), F.lit("")), F.lit("general"))
    other = F.coalesce(F.nullif(F.btrim(F.regexp_replace(other, "[^a-z0-9/_-]+", "-"), F.lit("-/")), F.lit("")), F.lit("general"))
    return F.when(name == "", other).otherwise(F.array_join(steps, "/"))


def slug(text: Column | str) -> Column:
    """Lower case, runs of anything but letters and digits as one hyphen; ``section`` where nothing is left."""
    s = F.btrim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "-"), F.lit("-"))
    return F.when(s == "", "section").otherwise(s)


def ngrams(items: Column, n: int) -> Column:
    """The distinct runs of n items, joined by spaces; empty if there are fewer."""
    return F.when(F.size(items) >= n, F.array_distinct(F.transform(F.sequence(F.lit(1), F.size(items) - n + 1), lambda i: F.array_join(F.slice(items, i, n), " ")))).otherwise(F.array().cast("array<string>"))


def ordered_coverage(needle: Column, haystack: Column) -> Column:
    """The share of needle's items that are met, one after another, going once through haystack."""
    start = F.struct(F.lit(0).alias("hit"))
    walked = F.aggregate(haystack, start, lambda s, h: F.when((s["hit"] < F.size(needle)) & (F.try_element_at(needle, s["hit"] + 1) == h), F.struct((s["hit"] + 1).alias("hit"))).otherwise(s))
    return F.when(F.size(needle) > 0, walked["hit"] / F.size(needle)).otherwise(0.0)


def jaccard(a: Column, b: Column) -> Column:
    """Shared over all items of two sets; 0 if both are empty."""
    either = F.size(F.array_union(a, b))
    return F.when(either > 0, F.size(F.array_intersect(a, b)) / either).otherwise(0.0)


def fold_accents(text: Column) -> Column:
    """Latin letters without their accents, after Unicode's compatibility forms are left alone."""
    return F.translate(text, "àáâãäåçèéêëìíîïñòóôõöøùúûüýÿāăąćčďđēĕėęěğģīįķĺļľłńņňōőŕřśşšţťūůűųźżž", "aaaaaaceeeeiiiinoooooouuuuyyaaaccddeeeeeggiikllllnnnoorrsssttuuuuzzz")
