"""Row-wise text functions as Columns; every one stays inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillspark.functions import patterns as P


def strip(x: Column) -> Column:
    """Without Unicode white space at both ends."""
    return F.regexp_replace(x, P.EDGES, "")


def words(x: Column) -> Column:
    """The stretches between Unicode white space."""
    return F.filter(F.split(x, P.WS + "+"), lambda w: w != "")


def word_count(x: Column) -> Column:
    """Number of words; 0 for an empty text, null for null."""
    return F.when(x.isNotNull(), F.size(words(x)))


def unwrap(x: Column) -> Column:
    """All white space runs as one space, none at the ends."""
    return F.trim(F.regexp_replace(x, P.WS + "+", " "))


def normalize_whitespace(x: Column) -> Column:
    """Dashes of two and more hyphens and em dashes count as white space too."""
    return unwrap(F.regexp_replace(x, "-{2,}|—", " "))


def collapse_blank_lines(x: Column, max_blank: int = 2) -> Column:
    """No more than ``max_blank`` blank lines in a row."""
    return F.regexp_replace(x, f"\n{{{max_blank + 2},}}", "\n" * (max_blank + 1))


def lines(x: Column) -> Column:
    """The lines of a text, without an empty one after the last line end."""
    parts = F.split(x, P.LINE_END)
    return F.when(F.element_at(parts, -1) == "", F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)


_FLAT = r"[^\[\]]*"
_NESTED = rf"(?:{_FLAT}|\[(?:{_FLAT}|\[{_FLAT}\])*\])*"
ILLUSTRATION = rf"(?i)\[illustration(?:{_FLAT}(?:\[{_FLAT}(?:\[{_FLAT}\]{_FLAT})*\]{_FLAT})*)(?:\]|$)"


#: A block that ILLUSTRATION does not match as a whole: nested deeper, or open inside.
_DEEPER = ILLUSTRATION.replace(r"\[illustration", r"\[illustration(?!", 1) + ")"


def _strip_counted(x: Column) -> Column:
    """Without ``[Illustration ...]`` blocks, by counting brackets over the pieces that begin with one."""
    pieces = F.split(x, r"(?=[\[\]])")

    def step(acc: Column, p: Column) -> Column:
        inside = acc["open"] > 0
        opens = F.lower(F.substring(p, 1, 13)) == "[illustration"
        change = F.when(p.startswith("["), 1).when(p.startswith("]"), -1).otherwise(0)
        left = F.when(inside, acc["open"] + change).otherwise(F.when(opens, 1).otherwise(0))
        first = F.when(inside, acc["first"]).otherwise(acc["at"])
        blocks = F.when(inside & (left == 0), F.array_append(acc["blocks"], F.struct(first.alias("a"), acc["at"].alias("b")))).otherwise(acc["blocks"])
        return F.struct((acc["at"] + 1).alias("at"), left.alias("open"), first.alias("first"), blocks.alias("blocks"))

    zero = F.struct(F.lit(0).alias("at"), F.lit(0).alias("open"), F.lit(0).alias("first"), F.array().cast("array<struct<a:int,b:int>>").alias("blocks"))
    end = lambda a: F.when(a["open"] > 0, F.array_append(a["blocks"], F.struct(a["first"].alias("a"), F.lit(2**31 - 1).alias("b")))).otherwise(a["blocks"])
    blocks = F.aggregate(pieces, zero, step, end)
    # of the piece that closes a block only the bracket goes
    kept = lambda p, i: F.when(F.exists(blocks, lambda b: b["b"] == i), F.substr(p, F.lit(2))).when(F.exists(blocks, lambda b: (b["a"] <= i) & (i < b["b"])), "").otherwise(p)
    return F.array_join(F.transform(pieces, kept), "")


def strip_illustrations(x: Column) -> Column:
    """Without ``[Illustration ...]`` blocks; an open block ends with the text.

    The pattern knows brackets nested to three levels; texts with a deeper block are folded over their brackets.
    """
    return F.when(x.rlike(_DEEPER), _strip_counted(x)).otherwise(F.regexp_replace(x, ILLUSTRATION, ""))


def fingerprint(x: Column) -> Column:
    """A word's letters and digits in lower case."""
    return F.lower(F.regexp_replace(x, P.NOT_W, ""))


def name_tokens(x: Column) -> Column:
    """The distinct lower-case tokens of a name, without periods at their ends."""
    return F.array_distinct(F.transform(words(x), lambda t: F.lower(F.regexp_replace(t, r"^\.+|\.+$", ""))))


def name_quality(x: Column) -> Column:
    """How much a string looks like a proper name: capitals count up, small letters and possessives down."""
    score = lambda t: F.when(t.rlike(r"^\p{Lu}"), 1).when(t.rlike(r"^\p{L}"), -1).otherwise(0)
    return F.aggregate(words(x), F.lit(0), lambda a, t: a + score(t)) - F.when(x.rlike(rf"[’']s($|{P.NOT_W})"), 2).otherwise(0)


def is_placeholder(x: Column) -> Column:
    """Whether a name is what a model says when there is no name."""
    return x.rlike(P.PLACEHOLDER)


def is_heading(x: Column) -> Column:
    """Whether a line, stripped, announces a chapter."""
    return strip(x).rlike(P.HEADING)


def heading_kind(x: Column) -> Column:
    """``back``, ``front`` or ``body``."""
    s = strip(x)
    return F.when(s.rlike(P.BACK), "back").when(s.rlike(P.FRONT), "front").otherwise("body")


def is_contents_line(x: Column) -> Column:
    """Whether a line belongs to a table of contents."""
    s = strip(x)
    return s.rlike(P.CONTENTS_LINE) | s.rlike(P.HEADING) | x.rlike(P.CONTENTS_NUMERAL)


def count_of(x: Column, ch: str) -> Column:
    return F.length(x) - F.length(F.replace(x, F.lit(ch), F.lit("")))


def quote_style(x: Column) -> Column:
    """The dominant quotation marks of a text: ``curly``, ``straight``, ``single`` or null."""
    return F.when(count_of(x, "“") >= 2, "curly").when(count_of(x, '"') >= 2, "straight").when(count_of(x, "‘") >= 2, "single")


def paragraphs(x: Column) -> Column:
    """Paragraphs between blank lines, unwrapped, without blank ones."""
    return F.filter(F.transform(F.split(strip(x), "\n\n+"), unwrap), lambda p: p != "")


def sentences(x: Column) -> Column:
    """Sentences, conservatively: an abbreviation, an initial or a small letter after it vetoes a break."""
    parts = F.split(F.regexp_replace(x, P.SENTENCE_END, "$1$2\x01"), "\x01")
    return F.filter(F.transform(F.split(_joined(parts), "\x02"), strip), lambda s: s != "")


def _joined(parts: Column) -> Column:
    def mark(p: Column, i: Column) -> Column:
        held = p.rlike(P.HELD_PERIOD)
        small = F.coalesce(F.get(parts, i + 1), F.lit("")).rlike(r"^\p{Ll}")
        return F.concat(p, F.when(small | held, "").otherwise("\x02"))

    return F.array_join(F.transform(parts, mark), "")


def tag_sentences(x: Column) -> Column:
    """Sentences of an attribution tag: a break after . ! ? unless a title with period stands before it."""
    held = F.regexp_replace(strip(x), P.TITLE_PERIOD, "$1\x01$2")
    parts = F.split(F.regexp_replace(held, rf"([.!?]){P.WS}+", "$1\x02"), "\x02")
    return F.filter(F.transform(parts, lambda s: F.replace(s, F.lit("\x01"), F.lit(""))), lambda s: s != "")


def leads_with_speech(x: Column) -> Column:
    """A verb of speech among the first six words, and no reported speech."""
    lead = F.array_join(F.slice(words(x), 1, 6), " ")
    return lead.rlike(P.SPEECH_VERB) & ~x.rlike(P.REPORTED_THAT)


def is_tag(kind: Column, x: Column) -> Column:
    """Whether a segment is narration that tags a speech."""
    return (kind == "narration") & (word_count(x) <= 20) & F.exists(tag_sentences(x), leads_with_speech)


def speaker_options(names: Column) -> Column:
    """The distinct names in their order, and ``Unknown`` at the end."""
    d = F.array_distinct(names)
    return F.when(F.array_contains(d, "Unknown"), d).otherwise(F.array_append(d, F.lit("Unknown")))


def strip_fences(x: Column) -> Column:
    """Without the fence lines that models put around JSON."""
    return strip(F.regexp_replace(F.regexp_replace(strip(x), "^```[^\n]*\n", ""), "\n?```$", ""))


def pattern_quoted(x: Column) -> Column:
    """A string as a pattern that matches it."""
    return F.regexp_replace(x, r"([\\.\[\]{}()*+?^$|\-])", r"\\$1")


def mentions(text: Column, alias: Column) -> Column:
    """Whether the lower-cased text holds the alias between word boundaries."""
    left = F.when(alias.rlike("^" + P.W), F.lit(f"(^|{P.NOT_W})")).otherwise(F.lit(P.W))
    right = F.when(alias.rlike(P.W + "$"), F.lit(f"($|{P.NOT_W})")).otherwise(F.lit(P.W))
    return F.regexp_count(F.lower(text), F.concat(left, pattern_quoted(alias), right)) > 0
