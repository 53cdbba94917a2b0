"""Book structure: lines, body, headings, chapters.

Everything is keyed by a book column (``key``) and ordered by ``line_idx``. A book's lines
meet in one shuffle on the key; all window functions below share it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quillspark.functions import patterns as P
from quillspark.functions import text as T

CONTENTS_GAP, CONTENTS_RUN, LONGEST_HEADING = 4, 3, 2


def explode_lines(texts: DataFrame, key: str, text: str = "text") -> DataFrame:
    """(key, line_idx, line) of texts, numbered from 0."""
    return texts.select(key, F.posexplode(T.lines(F.col(text))).alias("line_idx", "line"))


def body_bounds(lines: DataFrame, key: str) -> DataFrame:
    """(key, body_start, body_end), half-open: after the first start mark, before the last end mark."""
    return lines.groupBy(key).agg(
        F.coalesce(F.min(F.when(F.col("line").rlike(P.BODY_START), F.col("line_idx"))) + 1, F.lit(0)).cast("int").alias("body_start"),
        F.coalesce(F.max(F.when(F.col("line").rlike(P.BODY_END), F.col("line_idx"))), F.max("line_idx") + 1).cast("int").alias("body_end"),
    )


def body_lines(lines: DataFrame, key: str) -> DataFrame:
    """The lines inside the body with ``at``, their number in the body from 0, and the bounds."""
    w = Window.partitionBy(key)
    start = F.coalesce(F.min(F.when(F.col("line").rlike(P.BODY_START), F.col("line_idx"))).over(w) + 1, F.lit(0))
    end = F.coalesce(F.max(F.when(F.col("line").rlike(P.BODY_END), F.col("line_idx"))).over(w), F.max("line_idx").over(w) + 1)
    return lines.withColumn("body_start", start).withColumn("body_end", end).where("line_idx >= body_start and line_idx < body_end").withColumn("at", F.col("line_idx") - F.col("body_start"))


def preamble_metadata(preamble: Column) -> list[Column]:
    """Title, author, language, release date and credits of a preamble; what is missing is null, the language ``en``."""
    field = lambda name: F.nullif(T.strip(F.regexp_extract(preamble, rf"(?im)^{name}:{P.WS}*([^\n]+)$", 1)), F.lit(""))
    release = F.nullif(T.strip(F.regexp_extract(preamble, rf"(?m)^Release [Dd]ate:{P.WS}*([^\n]+?)(?:{P.WS}*\[|$)", 1)), F.lit(""))
    credits = F.nullif(F.replace(T.strip(F.regexp_extract(preamble, rf"(?is)(?:Produced by|Credits?:){P.WS}*(.+?)(?:\n\n|\z)", 1)), F.lit("\n"), F.lit(" ")), F.lit(""))
    return [field("Title").alias("title"), field("Author").alias("author"), F.coalesce(field("Language"), F.lit("en")).alias("language"), release.alias("release_date"), credits.alias("credits")]


def block_lengths(lines: DataFrame, key: str) -> DataFrame:
    """``lines`` with block_len: how many lines from here to the next blank one."""
    ahead = Window.partitionBy(key).orderBy("line_idx").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    blank = T.strip(F.col("line")) == ""
    stop = F.coalesce(F.min(F.when(blank, F.col("line_idx"))).over(ahead), F.max("line_idx").over(ahead) + 1)
    return lines.withColumn("block_len", (stop - F.col("line_idx")).cast("int"))


def headings(body: DataFrame, key: str) -> DataFrame:
    """Heading lines of the body, without those of contents lists and of paragraphs.

    ``body`` has at, line and block_len. Runs of three and more headings with gaps of at most
    four lines are a contents list; when nothing else is left they stay.
    """
    found = body.where(T.is_heading(F.col("line")))
    order = Window.partitionBy(key).orderBy("at")
    island = F.sum(F.when(F.col("at") - F.lag("at").over(order) <= CONTENTS_GAP, 0).otherwise(1)).over(order)
    marked = found.withColumn("island", island).withColumn("run", F.count("*").over(Window.partitionBy(key, "island")))
    some = F.max(F.when(F.col("run") < CONTENTS_RUN, 1).otherwise(0)).over(Window.partitionBy(key))
    kept = marked.withColumn("some", some).where((F.col("run") < CONTENTS_RUN) | (F.col("some") == 0)).where(F.col("block_len") <= LONGEST_HEADING)
    return kept.withColumn("number", F.row_number().over(order)).drop("island", "run", "some")


def chapters(lines: DataFrame, key: str, keep_back_matter: bool = False) -> DataFrame:
    """(key, number, title, kind, start_line, end_line), lines from 1 in the file, both included.

    A chapter ends before the next one; the last ends with the body, or before the first
    heading of back matter after its own, which with ``keep_back_matter`` becomes a chapter.
    """
    body = block_lengths(body_lines(lines, key), key)
    heads = headings(body, key).select(key, "number", T.strip(F.col("line")).alias("title"), "at", "body_start", "body_end")
    order = Window.partitionBy(key).orderBy("number")
    ends = heads.withColumn("next_at", F.lead("at").over(order))
    last = ends.where("next_at is null").select(key, F.col("at").alias("last_at"))
    back = body.where(T.heading_kind(F.col("line")) == "back").join(last, key).where("at > last_at").groupBy(key).agg(F.min("at").alias("back_at"), F.min_by(T.strip(F.col("line")), "at").alias("back_title"), F.count("*").alias("n"))
    out = ends.join(back, key, "left").select(
        key, "number", "title", T.heading_kind(F.col("title")).alias("kind"),
        (F.col("body_start") + F.col("at") + 1).cast("int").alias("start_line"),
        (F.col("body_start") + F.coalesce("next_at", "back_at", F.col("body_end") - F.col("body_start"))).cast("int").alias("end_line"),
    )
    if keep_back_matter:
        extra = ends.where("next_at is null").join(back, key).select(key, (F.col("number") + 1).alias("number"), F.col("back_title").alias("title"), F.lit("back").alias("kind"), (F.col("body_start") + F.col("back_at") + 1).cast("int").alias("start_line"), F.col("body_end").cast("int").alias("end_line"))
        out = out.unionByName(extra)
    return out


def chapter_texts(lines: DataFrame, chaps: DataFrame, key: str) -> DataFrame:
    """(key, number, text, word_count): each chapter's lines joined, without illustrations and long gaps.

    Lines find their chapter by an equi-join on the key and the line range; a line is in one chapter at most.
    """
    inside = lines.join(chaps.select(key, "number", "start_line", "end_line"), key).where("line_idx + 1 between start_line and end_line")
    joined = inside.groupBy(key, "number").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_idx", "line"))), lambda x: x["line"]), "\n").alias("raw"))
    plain = T.strip_illustrations(F.col("raw"))
    return joined.select(key, "number", T.strip(T.collapse_blank_lines(plain)).alias("text"), T.word_count(plain).alias("word_count"))


def illustration_lines(lines: DataFrame, key: str, at: str = "at") -> DataFrame:
    """``lines`` with in_illustration: from an ``[illustration`` line to its closing bracket.

    A fold over each book's lines with brackets, which are few, gives the blocks; every line
    is then compared with its book's blocks.
    """
    marked = lines.where(F.col("line").rlike(r"[\[\]]")).groupBy(key).agg(F.array_sort(F.collect_list(F.struct(F.col(at).cast("int").alias("at"), "line"))).alias("ls"))
    depth = lambda s: T.count_of(s, "[") - T.count_of(s, "]")

    def step(acc: Column, x: Column) -> Column:
        inside = acc["open"] > 0
        opens = F.lower(T.strip(x["line"])).startswith("[illustration")
        left = F.when(inside | opens, F.greatest(F.lit(0), acc["open"] + depth(x["line"]))).otherwise(0)
        first = F.when(inside, acc["first"]).otherwise(x["at"])
        done = (inside | opens) & (left == 0)
        return F.struct(left.alias("open"), first.alias("first"), F.when(done, F.array_append(acc["blocks"], F.struct(first.alias("a"), x["at"].alias("b")))).otherwise(acc["blocks"]).alias("blocks"))

    zero = F.struct(F.lit(0).alias("open"), F.lit(0).alias("first"), F.array().cast("array<struct<a:int,b:int>>").alias("blocks"))
    end = lambda a: F.when(a["open"] > 0, F.array_append(a["blocks"], F.struct(a["first"].alias("a"), F.lit(2**31 - 1).alias("b")))).otherwise(a["blocks"])
    blocks = marked.select(key, F.aggregate("ls", zero, step, end).alias("blocks"))
    return lines.join(blocks, key, "left").select(*lines.columns, F.coalesce(F.exists("blocks", lambda x: F.col(at).between(x["a"], x["b"])), F.lit(False)).alias("in_illustration"))


LEAST_PROSE = 50


def unlabeled_first_chapter(lines: DataFrame, key: str, least_words: int = LEAST_PROSE) -> DataFrame:
    """(key, start_line, words) of books with a first chapter that has no heading.

    The prose before the first heading counts from the last contents-like line before its end;
    front or back matter headings in it, or fewer than ``least_words`` words, make it no chapter.
    """
    body = block_lengths(body_lines(lines, key), key)
    first = headings(body, key).groupBy(key).agg(F.min("at").alias("first_at"))
    marked = illustration_lines(body.select(key, "at", "line"), key)
    region = marked.join(first, key, "left").where((F.col("at") < F.col("first_at")) | F.col("first_at").isNull()).where(~F.col("in_illustration") & (T.strip(F.col("line")) != ""))
    region = region.withColumn("listed", T.is_contents_line(F.col("line")))
    prose = region.where(~F.col("listed")).groupBy(key).agg(F.max("at").alias("last_prose"))
    stop = region.join(prose, key).where("listed and at < last_prose").groupBy(key).agg(F.max("at").alias("stop"))
    inside = region.where(~F.col("listed")).join(stop, key, "left").where(F.col("at") > F.coalesce("stop", F.lit(-1)))
    found = inside.groupBy(key).agg(F.min("at").alias("block_start"), F.sum(T.word_count(F.col("line"))).alias("words"), F.max(F.when(T.heading_kind(F.col("line")) != "body", 1).otherwise(0)).alias("matter"))
    return found.where((F.col("words") >= least_words) & (F.col("matter") == 0)).select(key, (F.col("block_start") + 1).cast("int").alias("start_line"), F.col("words").cast("bigint").alias("words"))


def with_first_chapter(heads: DataFrame, first: DataFrame, key: str) -> DataFrame:
    """Headings (key, number, title, start_line) with the unlabeled first chapter before them, renumbered."""
    extra = first.select(key, F.lit(0).alias("number"), F.lit("Chapter I").alias("title"), "start_line")
    both = heads.select(key, "number", "title", "start_line").unionByName(extra)
    return both.withColumn("number", F.row_number().over(Window.partitionBy(key).orderBy("number")))


def validated_chapters(proposed: DataFrame, key: str, line_count: Column, front: bool = False, back: bool = False) -> DataFrame:
    """Proposed chapters (key, ord, title, start_line as string or number) that can be right, sorted and renumbered.

    Starts that are no integers or lie outside the text fall out, then unwanted matter, then repeated starts (the first stays).
    """
    start = F.expr("try_cast(start_line as int)")
    kind = T.heading_kind(F.coalesce("title", F.lit("")))
    kept = proposed.withColumn("start", start).withColumn("kind", kind).where((F.col("start") >= 1) & (F.col("start") <= line_count))
    kept = kept.where((F.col("kind") == "body") | (F.lit(front) & (F.col("kind") == "front")) | (F.lit(back) & (F.col("kind") == "back")))
    kept = kept.withColumn("nth", F.row_number().over(Window.partitionBy(key, "start").orderBy("ord"))).where("nth = 1")
    return kept.withColumn("number", F.row_number().over(Window.partitionBy(key).orderBy("start", "ord"))).select(key, "number", "title", F.col("start").alias("start_line"), "kind")


def degenerate_books(chaps: DataFrame, key: str, least_words: int = 20) -> DataFrame:
    """(key, chapters, short) of books in which a fifth of the chapters or more have almost no words."""
    n = chaps.groupBy(key).agg(F.count("*").alias("chapters"), F.count_if(F.coalesce("word_count", F.lit(0)) < least_words).alias("short"))
    return n.where("short * 5 >= chapters and short > 0")


def size_outliers(chaps: DataFrame, key: str, high: float = 2.5, low: float = 0.2) -> DataFrame:
    """(key, chapter_number, word_count, median) of chapters far from their book's exact median size."""
    m = chaps.groupBy(key).agg(F.median("word_count").alias("median"), F.count("*").alias("n")).where("n >= 3 and median <> 0")
    return chaps.join(m, key).where((F.col("word_count") / F.col("median") > high) | (F.col("word_count") / F.col("median") < low)).select(key, "chapter_number", "word_count", "median")


def unique_numbers(chaps: DataFrame, key: str) -> DataFrame:
    """Chapters (key, ord, number) whose repeated numbers become one more than the largest seen so far.

    A fold: what is given to one chapter counts for the next.
    """
    per_book = chaps.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("ord", "number"))).alias("cs"))

    def step(acc: Column, x: Column) -> Column:
        n = F.when(F.array_contains(acc["seen"], x["number"]), F.array_max(acc["seen"]) + 1).otherwise(x["number"])
        return F.struct(F.array_append(acc["seen"], n).alias("seen"))

    seen = F.aggregate("cs", F.struct(F.array().cast("array<int>").alias("seen")), step)["seen"]
    return per_book.select(key, F.explode(F.arrays_zip("cs", seen.alias("n"))).alias("z")).select(key, F.col("z.cs.ord").alias("ord"), F.col("z.n").alias("number"))
