"""Queries on paragraphs, quotations, sentences and windows."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.functions import patterns as P
from quillspark.functions import text as T
from quillspark.operators import resolver as R
from quillspark.operators import segment as G
from quillspark.operators import windows as W
from quillspark.plans import sql as Q
from quillspark.plans.registry import query
from quillspark.plans.structure_queries import table

SEGMENT_COLUMNS = ["segment_id", "book_id", "chapter_number", "seg_idx", "para", "seg_type", "text", "speaker", "notes"]
CHAPTER = ["book_id", "chapter_number"]


def docs(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").where("text is not null")


def segments_once(spark: SparkSession, sf: str, *columns: str | Column) -> DataFrame:
    """Redelivered segments once, with segment_id and the columns asked for.

    segment_id is the key, so the fewer columns, the less is shuffled; what a query derives
    from the text it asks for as a column, and the text stays where it is.
    """
    s = table(spark, sf, "segments").withColumn("speaker", F.nullif("speaker", F.lit("")))
    return s.select("segment_id", *(columns or SEGMENT_COLUMNS[1:])).distinct()


def words() -> Column:
    """The words of a segment's text (a function: no Column is built before there is a session)."""
    return T.word_count(F.coalesce("text", F.lit(""))).alias("words")


def doc_segments(spark: SparkSession, sf: str) -> DataFrame:
    return G.segments(docs(spark, sf).select("doc_id", "text"), "doc_id")


@query(f"select doc_id, {Q.style('text')} as style from documents where text is not null")
def quote_style(spark: SparkSession, sf: str) -> DataFrame:
    return docs(spark, sf).select("doc_id", T.quote_style(F.col("text")).alias("style"))


@query(f"with p as (select doc_id, {Q.paragraphs('text')} as ps from documents where text is not null) select doc_id, (unnest(range(len(ps))))::int as para, unnest(ps) as text from p")
def paragraphs(spark: SparkSession, sf: str) -> DataFrame:
    return docs(spark, sf).select("doc_id", F.posexplode(T.paragraphs(F.col("text"))).alias("para", "text"))


@query(f"with {Q.SPANS} select doc_id, seg_type, count(*) as n, sum(length(text))::bigint as chars, count(notes) as continued from typed where text <> '' group by doc_id, seg_type")
def segment_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Narration and dialogue of each document, before long narration is split."""
    s = G.segments(docs(spark, sf).select("doc_id", "text"), "doc_id", limit=1 << 30)
    return s.groupBy("doc_id", "seg_type").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars"), F.count("notes").alias("continued"))


@query(f"with {Q.SPANS} select doc_id, para, (row_number() over (partition by doc_id order by para, k) - 1)::int as seg_idx, seg_type, text, notes from typed where text <> ''")
def quote_segments(spark: SparkSession, sf: str) -> DataFrame:
    return G.segments(docs(spark, sf).select("doc_id", "text"), "doc_id", limit=1 << 30)


@query(f"with {Q.SEGS}, s as (select segment_id, {Q.sentences(Q.unwrap('text'))} as ss from segs where text is not null) select segment_id, (unnest(range(len(ss))))::int as sent_no, unnest(ss) as sentence from s")
def narration_sentences(spark: SparkSession, sf: str) -> DataFrame:
    s = segments_once(spark, sf, "text").where("text is not null")
    return s.select("segment_id", F.posexplode(T.sentences(T.unwrap(F.col("text")))).alias("sent_no", "sentence"))


@query(f"""with recursive {Q.SEGS},
s as (select segment_id, {Q.sentences(Q.unwrap('text'))} as ss from segs where seg_type = 'narration' and length({Q.unwrap('text')}) > 400),
fold as (select segment_id, ss, 1 as i, '' as cur, []::varchar[] as done from s
 union all select segment_id, ss, i + 1, case when cur = '' or length(cur) + 1 + length(ss[i]) > 400 then ss[i] else cur || ' ' || ss[i] end, case when cur <> '' and length(cur) + 1 + length(ss[i]) > 400 then done || [cur] else done end from fold where i <= len(ss)),
ends as (select segment_id, case when cur = '' then done else done || [cur] end as cs from fold where i = len(ss) + 1)
select segment_id, (unnest(range(len(cs))))::int as chunk_no, unnest(cs) as chunk from ends""")
def narration_chunks(spark: SparkSession, sf: str) -> DataFrame:
    s = segments_once(spark, sf, "seg_type", "text").where("seg_type = 'narration'").select("segment_id", T.unwrap(F.col("text")).alias("text")).where("length(text) > 400")
    return s.select("segment_id", F.posexplode(G.narration_chunks(F.col("text"))).alias("chunk_no", "chunk"))


@query(f"""with {Q.SPANS},
r as (select doc_id, string_agg(text, ' ' order by para, k) as rebuilt from typed where text <> '' group by doc_id)
select doc_id, {Q.normalize('text')} = {Q.normalize("coalesce(rebuilt, '')")} as covered from documents left join r using (doc_id) where text is not null""")
def coverage_check(spark: SparkSession, sf: str) -> DataFrame:
    d = docs(spark, sf).select("doc_id", "text")
    return G.coverage(d, G.segments(d, "doc_id", limit=1 << 30), "doc_id")


@query(f"with {Q.SEGS} select segment_id, {Q.tag_sentences('text')} as ss from segs where text is not null and seg_type = 'narration'")
def tag_sentences(spark: SparkSession, sf: str) -> DataFrame:
    return segments_once(spark, sf, "seg_type", "text").where("text is not null and seg_type = 'narration'").select("segment_id", T.tag_sentences(F.col("text")).alias("ss"))


@query(f"with {Q.SEGS} select book_id, chapter_number, count(*) as empty from segs where {Q.strip("coalesce(text, '')")} = '' group by book_id, chapter_number")
def empty_segments(spark: SparkSession, sf: str) -> DataFrame:
    blank = T.strip(F.coalesce("text", F.lit(""))) == ""
    s = segments_once(spark, sf, *CHAPTER, blank.alias("blank")).where("blank")
    return s.groupBy(*CHAPTER).agg(F.count("*").alias("empty"))


_WINDOWS = f"""{Q.SEGS},
w as (select book_id, chapter_number, seg_idx, {Q.word_count("coalesce(text, '')")} as n, row_number() over (partition by book_id, chapter_number order by seg_idx) as i from segs),
fold as (select book_id, chapter_number, seg_idx, i, n as used, 1 as held, 0 as window_id from w where i = 1
 union all select w.book_id, w.chapter_number, w.seg_idx, w.i, case when f.used + w.n > 250 and f.held > 0 then w.n else f.used + w.n end, case when f.used + w.n > 250 and f.held > 0 then 1 else f.held + 1 end, case when f.used + w.n > 250 and f.held > 0 then f.window_id + 1 else f.window_id end
 from fold f join w on w.book_id = f.book_id and w.chapter_number = f.chapter_number and w.i = f.i + 1)"""


@query(f"with recursive {_WINDOWS} select book_id, chapter_number, seg_idx, window_id from fold")
def segment_windows(spark: SparkSession, sf: str) -> DataFrame:
    return W.segment_windows(segments_once(spark, sf, *CHAPTER, "seg_idx", words()), CHAPTER, 250)


@query(f"""with recursive {_WINDOWS},
starts as (select book_id, chapter_number, window_id, min(seg_idx) as first from fold group by all)
select book_id, chapter_number, window_id, seg_idx, false as is_context from fold
union all select s.book_id, s.chapter_number, s.window_id, f.seg_idx, true from fold f join starts s on s.book_id = f.book_id and s.chapter_number = f.chapter_number and f.seg_idx < s.first and f.seg_idx >= s.first - 8""")
def context_windows(spark: SparkSession, sf: str) -> DataFrame:
    return W.with_context(W.segment_windows(segments_once(spark, sf, *CHAPTER, "seg_idx", words()), CHAPTER, 250), CHAPTER)


@query(f"""with recursive d as (select doc_id, text, string_split(text, chr(10) || chr(10)) as ps from documents where text is not null and {Q.word_count('text')} > 100),
w as (select doc_id, ps, (unnest(range(1, len(ps) + 1)))::int as i, unnest(list_transform(ps, lambda p: {Q.word_count('p')})) as n from d),
fold as (select doc_id, i, n as used, 0 as window_id from w where i = 1
 union all select w.doc_id, w.i, case when f.used + w.n > 100 then w.n else f.used + w.n end, case when f.used + w.n > 100 then f.window_id + 1 else f.window_id end from fold f join w on w.doc_id = f.doc_id and w.i = f.i + 1),
packed as (select f.doc_id, f.window_id, string_agg(d.ps[f.i], chr(10) || chr(10) order by f.i) as text from fold f join d using (doc_id) group by f.doc_id, f.window_id)
select doc_id, window_id, text from packed union all select doc_id, 0, text from documents where text is not null and {Q.word_count('text')} <= 100""")
def discovery_windows(spark: SparkSession, sf: str) -> DataFrame:
    return W.discovery_windows(docs(spark, sf).select("doc_id", "text"), "doc_id", budget=100)


@query(f"""with {Q.SEGS},
m as (select *, para <> lag(para) over (partition by book_id, chapter_number order by seg_idx) as new_para from segs where text is not null)
select segment_id, case when coalesce(new_para, false) then chr(10) else '' end || seg_idx || chr(9) || seg_type || chr(9) || concat_ws(',', case when seg_type = 'dialogue' and speaker is null then 'ASKED' end, case when notes = 'quote-continues' then 'OPEN' end)
 || chr(9) || case when seg_type = 'dialogue' and speaker is not null then speaker else '' end || chr(9) || case when length(text) > 300 then left(text, 300) || '…' else text end as line from m""")
def prompt_lines(spark: SparkSession, sf: str) -> DataFrame:
    s = G.with_neighbours(segments_once(spark, sf).where("text is not null"), CHAPTER)
    s = s.withColumn("is_context", F.lit(False)).withColumn("flagged", (F.col("seg_type") == "dialogue") & F.col("speaker").isNull())
    return s.select("segment_id", R.rendered().alias("line"))


@query(f"with w as (select doc_id, lower(regexp_replace(unnest({Q.words('text')}), {Q.lit(P.NOT_W)}, '', 'g')) as print from documents where text is not null) select print, count(*) as n, count(distinct doc_id) as docs from w group by print")
def word_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    """How often each fingerprint of a word occurs, and in how many documents."""
    w = docs(spark, sf).select("doc_id", F.explode(T.words(F.col("text"))).alias("w")).select("doc_id", T.fingerprint(F.col("w")).alias("print"))
    return w.groupBy("print").agg(F.count("*").alias("n"), F.countDistinct("doc_id").alias("docs"))


@query()
def overlapping_chunks(spark: SparkSession, sf: str) -> DataFrame:
    """Paragraphs of each document in chunks of 100 words with 20 in common."""

    @F.pandas_udf("array<string>")
    def chunks(texts: pd.Series) -> pd.Series:
        return texts.map(lambda ps: W.overlapping_chunks(list(ps), 100, 20))

    d = docs(spark, sf).select("doc_id", T.paragraphs(F.col("text")).alias("ps"))
    return d.select("doc_id", F.posexplode(chunks("ps")).alias("chunk_no", "chunk"))
