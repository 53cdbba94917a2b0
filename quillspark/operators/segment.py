"""Narration and dialogue: every character of a text in exactly one segment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quillspark.functions import text as T

LONGEST_NARRATION = 400
CONTINUES = "quote-continues"
_APOSTROPHE = "\x03"  # stands for an apostrophe between two letters while single quotes are cut

# One token per quotation or stretch between quotations, by style.
_TOKENS = {"curly": "(“[^”]*(?:”|$)|[^“]+)", "straight": '("[^"]*(?:"|$)|[^"]+)', "single": "(‘[^’]*(?:’|$)|[^‘]+)"}
_OPEN = {"curly": "“", "straight": '"', "single": "‘"}
_CLOSE = {"curly": "”", "straight": '"', "single": "’"}


def _by_style(style: Column, of: dict) -> Column:
    return F.when(style == "curly", of["curly"]).when(style == "straight", of["straight"]).otherwise(of["single"])


def paragraph_spans(para: Column, style: Column) -> Column:
    """The spans of one paragraph: array of (seg_type, text, notes).

    Each paragraph begins outside a quotation; one that ends inside has a note that it goes on.
    """
    guarded = para
    for _ in range(2):  # twice, for letters that stand between two apostrophes
        guarded = F.regexp_replace(guarded, r"(\p{L})’(\p{L})", f"$1{_APOSTROPHE}$2")
    source = F.when(style == "single", guarded).otherwise(para)
    tokens = F.when(style == "curly", F.regexp_extract_all(source, F.lit(_TOKENS["curly"]), 1)).when(style == "straight", F.regexp_extract_all(source, F.lit(_TOKENS["straight"]), 1)).when(style == "single", F.regexp_extract_all(source, F.lit(_TOKENS["single"]), 1)).otherwise(F.array(para))

    def span(t: Column) -> Column:
        clean = T.strip(F.replace(t, F.lit(_APOSTROPHE), F.lit("’")))
        quoted = style.isNotNull() & t.startswith(_by_style(style, _OPEN))
        open_ = quoted & (~t.endswith(_by_style(style, _CLOSE)) | (F.length(t) == 1))
        return F.struct(F.when(quoted, "dialogue").otherwise("narration").alias("seg_type"), clean.alias("text"), F.when(open_, CONTINUES).alias("notes"))

    return F.filter(F.transform(tokens, span), lambda s: s["text"] != "")


def narration_chunks(x: Column, limit: int = LONGEST_NARRATION) -> Column:
    """Sentences packed one after the other up to ``limit`` characters; a longer sentence stays whole."""

    def step(acc: Column, s: Column) -> Column:
        full = (acc["cur"] != "") & (F.length(acc["cur"]) + 1 + F.length(s) > limit)
        return F.struct(
            F.when(full | (acc["cur"] == ""), s).otherwise(F.concat(acc["cur"], F.lit(" "), s)).alias("cur"),
            F.when(full, F.array_append(acc["out"], acc["cur"])).otherwise(acc["out"]).alias("out"),
        )

    done = F.aggregate(T.sentences(x), F.struct(F.lit("").alias("cur"), F.array().cast("array<string>").alias("out")), step, lambda a: F.when(a["cur"] == "", a["out"]).otherwise(F.array_append(a["out"], a["cur"])))
    return F.when(F.length(x) <= limit, F.array(x)).otherwise(done)


def segments(texts: DataFrame, key: str, text: str = "text", limit: int = LONGEST_NARRATION) -> DataFrame:
    """(key, seg_idx, para, seg_type, text, notes) of each text, by its dominant quotation marks. No shuffle."""
    styled = texts.where(F.col(text).isNotNull()).select(key, T.quote_style(F.col(text)).alias("style"), T.paragraphs(F.col(text)).alias("paras"))
    spans = F.flatten(F.transform("paras", lambda p, i: F.transform(paragraph_spans(p, F.col("style")), lambda s: F.struct(i.alias("para"), s["seg_type"].alias("seg_type"), s["text"].alias("text"), s["notes"].alias("notes")))))
    split = F.flatten(F.transform(spans, lambda s: F.when((s["seg_type"] == "narration") & (F.length(s["text"]) > limit), F.transform(narration_chunks(s["text"], limit), lambda c: F.struct(s["para"].alias("para"), s["seg_type"].alias("seg_type"), c.alias("text"), s["notes"].alias("notes")))).otherwise(F.array(s))))
    return styled.select(key, F.posexplode(split).alias("seg_idx", "s")).select(key, "seg_idx", "s.para", "s.seg_type", "s.text", "s.notes")


def coverage(texts: DataFrame, segs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """(key, covered): whether the segments, joined by spaces, are the text, white space runs and dashes aside."""
    rebuilt = segs.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seg_idx", "text"))), lambda s: s["text"]), " ").alias("rebuilt"))
    both = texts.where(F.col(text).isNotNull()).join(rebuilt, key, "left")
    return both.select(key, (T.normalize_whitespace(F.col(text)) == T.normalize_whitespace(F.coalesce("rebuilt", F.lit("")))).alias("covered"))


def coverage_differences(original: str, rebuilt: str) -> list[str]:
    """What a text lacks, has in excess or has otherwise, word by word; for the few texts that are not covered."""
    import difflib

    a, b = rebuilt.split(), original.split()
    out = []
    for tag, i1, i2, j1, j2 in difflib.SequenceMatcher(None, a, b, autojunk=False).get_opcodes():
        mine, theirs = " ".join(a[i1:i2]), " ".join(b[j1:j2])
        if tag == "delete":
            out.append(f"excess: {mine[:100]}")
        elif tag == "insert":
            out.append(f"missing: {theirs[:100]}")
        elif tag == "replace":
            out.append(f"altered: {theirs[:80]} -> {mine[:80]}")
    return out


def with_neighbours(segs: DataFrame, key: list[str]) -> DataFrame:
    """Segments with a mark where the paragraph changes."""
    w = Window.partitionBy(*key).orderBy("seg_idx")
    return segs.withColumn("new_para", F.col("para") != F.lag("para").over(w))


def repaired(original: str, parts: list[str], gap: int = 30) -> list[tuple[str, bool]]:
    """Segment texts put back to the original's words: (text, was missing) in order.

    Words are aligned by their letters and digits, with up to a tenth of a word's letters wrong;
    original words that no segment has come out as pieces of their own.
    """
    from quillspark.operators.roster import edit_distance

    print_of = lambda w: "".join(c for c in w if c.isalnum() or c == "_").lower()
    same = lambda a, b: a == b or edit_distance(a, b) <= min(2, max(1, len(a) // 10))
    source = original.split()
    codes = [print_of(w) for w in source]
    at, out = 0, []
    for text in parts:
        want = [c for c in map(print_of, text.split()) if c]
        if not want:
            continue
        start = next((i for i in range(at, min(len(codes), at + gap + 1)) if same(codes[i], want[0])), None)
        if start is None:
            continue
        end, k = start, 0
        while end < len(codes) and k < len(want):
            if codes[end] and same(codes[end], want[k]):
                k += 1
            elif codes[end] and k + 1 < len(want) and same(codes[end], want[k + 1]):
                k += 2
            end += 1
        if start > at:
            out.append((" ".join(source[at:start]), True))
        out.append((" ".join(source[start:end]), False))
        at = end
    if at < len(source):
        out.append((" ".join(source[at:]), True))
    return out
