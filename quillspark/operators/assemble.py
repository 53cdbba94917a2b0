"""The finished book: speakers brought to the roster, statistics, one document per book."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


VERSION = "1.0.0"


def _json(x: Column | str) -> Column:
    """JSON with its nulls, which readers of the documents expect."""
    return F.to_json(x, {"ignoreNullFields": "false"})


def remapped_speakers(segs: DataFrame, aliases: DataFrame, key: str) -> DataFrame:
    """``segs`` with speakers as the roster's names; a speaker it does not know is ``Unknown``.

    The alias table joins by Catalyst's choice: broadcast while it is small, else on (book, alias).
    """
    a = aliases.select(key, F.col("alias").alias("low"), "canonical")
    joined = segs.withColumn("low", F.lower("speaker")).join(a, [key, "low"], "left")
    free = F.coalesce("speaker", F.lit("")).isin("", "Unknown", "Narrator")
    return joined.withColumn("speaker", F.when(free, F.col("speaker")).otherwise(F.coalesce("canonical", F.lit("Unknown")))).drop("low", "canonical")


def attribution_counts(segs: DataFrame, key: list[str]) -> DataFrame:
    """(key, dialogue, named, unknown): how much of the dialogue has a speaker."""
    talk = F.col("seg_type") == "dialogue"
    none = F.coalesce("speaker", F.lit("")).isin("", "Unknown")
    return segs.groupBy(*key).agg(F.count_if(talk).alias("dialogue"), F.count_if(talk & ~none).alias("named"), F.count_if(talk & none).alias("unknown"))


def statistics(segs: DataFrame, chapter_words: DataFrame, roster: DataFrame, qualities: DataFrame | None, key: str) -> DataFrame:
    """Totals per book; the quality is 1.0 where no critic judged."""
    s = segs.groupBy(key).agg(F.count("*").alias("total_segments"))
    c = chapter_words.groupBy(key).agg(F.count("*").alias("total_chapters"), F.coalesce(F.sum("word_count"), F.lit(0)).alias("total_words"))
    r = roster.groupBy(key).agg(F.count("*").alias("total_characters"))
    out = c.join(s, key, "left").join(r, key, "left")
    if qualities is not None:
        out = out.join(qualities.groupBy(key).agg(F.avg("quality").alias("avg"), F.min("quality").alias("min")), key, "left")
    else:
        out = out.withColumn("avg", F.lit(None).cast("double")).withColumn("min", F.lit(None).cast("double"))
    zero = lambda x: F.coalesce(x, F.lit(0)).alias(x)
    return out.select(key, "total_chapters", "total_words", zero("total_segments"), zero("total_characters"), F.coalesce("avg", F.lit(1.0)).alias("avg_confidence"), F.coalesce("min", F.lit(1.0)).alias("min_confidence"))


def documents(books: DataFrame, chaps: DataFrame, segs: DataFrame, roster: DataFrame, stats: DataFrame, key: str, config: dict | None = None) -> DataFrame:
    """(key, document): one JSON document per book.

    Segments are gathered per chapter and chapters per book, so no single row is built twice;
    the document of a book has the size of the book, which the output demands.
    """
    seg = F.struct(F.col("seg_type").alias("type"), "text", "speaker", F.coalesce("pronunciation_hints", F.array().cast("array<string>")).alias("pronunciation_hints"), "notes")
    per_chapter = segs.groupBy(key, "chapter_number").agg(F.transform(F.array_sort(F.collect_list(F.struct("seg_idx", seg.alias("s")))), lambda x: x["s"]).alias("segments"))
    title = F.coalesce("start_marker", "title")
    # a chapter without segments stays, with none
    chapter = chaps.join(per_chapter, [key, "chapter_number"], "left").withColumn("segments", F.coalesce("segments", F.array().cast(per_chapter.schema["segments"].dataType))).select(
        key, "chapter_number",
        F.struct(
            F.struct(F.col("chapter_number").alias("number"), "title", F.lit("").alias("text"), "word_count", title.alias("start_marker")).alias("chapter"),
            F.struct("chapter_number", F.col("title").alias("chapter_title"), "segments", "word_count", F.lit(False).alias("is_segment"), F.lit(1).alias("total_segments")).alias("processed"),
        ).alias("c"),
    )
    chapters = chapter.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("chapter_number", _json("c").alias("j")))), lambda x: x["j"]).alias("chapters"))
    people = roster.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", F.struct("name", "aliases", "pronunciation_hints", "first_appearance_chapter").alias("p")))), lambda x: _json(x["p"])).alias("characters"))
    b = books.select(key, F.struct("title", "author", F.col("book_lang").alias("language"), "gutenberg_id", "release_date", "credits").alias("metadata"))
    joined = b.join(chapters, key).join(people, key, "left").join(stats, key, "left")
    facts = F.struct("total_chapters", "total_words", "total_segments", "total_characters", F.lit(VERSION).alias("pipeline_version"), F.struct("avg_confidence", "min_confidence").alias("discovery_confidence"))
    conf = _json(F.struct(*[F.lit(v).alias(k) for k, v in (config or {"chunk_size": 1000, "chunk_overlap": 150}).items()]))
    body = F.concat(
        F.lit('{"metadata":'), _json("metadata"), F.lit(',"chapters":['), F.array_join("chapters", ","), F.lit('],"characters":['),
        F.array_join(F.coalesce("characters", F.array().cast("array<string>")), ","), F.lit('],"statistics":'), _json(facts), F.lit(',"processing_config":'), conf, F.lit("}"),
    )
    return joined.select(key, body.alias("document"))


def output_name(book_id: str, chapters: list[int] | None = None, explicit: str | None = None) -> str:
    """The name of a book's document; a run over some chapters gets one of its own, so it never replaces the whole book."""
    if explicit:
        return explicit
    if not chapters:
        return f"{book_id}.json"
    n = sorted(chapters)
    return f"{book_id}-ch{'-'.join(map(str, n)) if len(n) <= 6 else f'{n[0]}_{n[-1]}'}.json"


