"""Queries on lines, headings and chapters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quillspark.functions import patterns as P
from quillspark.functions import text as T
from quillspark.operators import roster as O
from quillspark.operators import structure as S
from quillspark.plans import sql as Q
from quillspark.plans.manuscript import SQL_LINES, manuscript_lines, manuscript_texts
from quillspark.plans.registry import query

CHAPTER_COLUMNS = ["book_id", "chapter_number", "title", "start_line", "end_line", "word_count", "start_marker", "kind"]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def chapters_once(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "chapters").select(*CHAPTER_COLUMNS).distinct()


@query(f"""
with t as (select doc_id, string_split_regex(text, {Q.lit(P.LINE_END)}) as ls from documents where text is not null),
c as (select doc_id, case when ls[-1] = '' then ls[:-2] else ls end as ls from t)
select doc_id, (unnest(range(len(ls))))::int as line_idx, unnest(ls) as line from c""")
def line_explode(spark: SparkSession, sf: str) -> DataFrame:
    return S.explode_lines(table(spark, sf, "documents").where("text is not null"), "doc_id")


@query(f"select doc_id, {Q.word_count('text')}::int as words from documents where text is not null")
def doc_word_counts(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").where("text is not null").select("doc_id", T.word_count(F.col("text")).alias("words"))


@query(f"select doc_id, {Q.normalize('text')} as norm from documents where text is not null")
def doc_whitespace_norm(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").where("text is not null").select("doc_id", T.normalize_whitespace(F.col("text")).alias("norm"))


@query(f"select doc_id, regexp_replace(regexp_replace(text, {Q.lit(T.ILLUSTRATION)}, '', 'g'), '\\n{{4,}}', chr(10) || chr(10) || chr(10), 'g') as plain from documents where text is not null")
def illustrations_stripped(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").where("text is not null").select("doc_id", T.collapse_blank_lines(T.strip_illustrations(F.col("text"))).alias("plain"))


_BODY = f"""{SQL_LINES},
bounds as (select doc_id, coalesce(min(line_idx) filter (regexp_matches(line, {Q.lit(P.BODY_START)})) + 1, 0)::int as body_start, coalesce(max(line_idx) filter (regexp_matches(line, {Q.lit(P.BODY_END)})), max(line_idx) + 1)::int as body_end from mlines group by doc_id)"""


@query(f"with {_BODY} select doc_id, body_start, body_end from bounds")
def body_bounds(spark: SparkSession, sf: str) -> DataFrame:
    return S.body_bounds(manuscript_lines(spark, sf), "doc_id")


def _sql_field(pattern: str) -> str:
    return f"nullif({Q.strip(f'regexp_extract(pre, {Q.lit(pattern)}, 1)')}, '')"


@query(f"""with {_BODY},
pre as (select doc_id, string_agg(line, chr(10) order by line_idx) as pre from mlines join bounds using (doc_id) where line_idx < body_start group by doc_id)
select doc_id, {_sql_field(rf"(?im)^Title:{P.WS}*([^\n]+)$")} as title, {_sql_field(rf"(?im)^Author:{P.WS}*([^\n]+)$")} as author, coalesce({_sql_field(rf"(?im)^Language:{P.WS}*([^\n]+)$")}, 'en') as language,
  {_sql_field(rf"(?m)^Release [Dd]ate:{P.WS}*([^\n]+?)(?:{P.WS}*\[|$)")} as release_date, replace({_sql_field(rf"(?is)(?:Produced by|Credits?:){P.WS}*(.+?)(?:\n\n|\z)")}, chr(10), ' ') as credits from pre""")
def preamble_metadata(spark: SparkSession, sf: str) -> DataFrame:
    lines = manuscript_lines(spark, sf)
    pre = lines.join(S.body_bounds(lines, "doc_id"), "doc_id").where("line_idx < body_start").groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_idx", "line"))), lambda x: x["line"]), "\n").alias("pre"))
    return pre.select("doc_id", *S.preamble_metadata(F.col("pre")))


@query(f"""with {Q.CHAPTERS}, {SQL_LINES},
given as (select distinct title as line from chaps where title is not null union select distinct start_marker from chaps where start_marker is not null union select distinct line from mlines)
select line, {Q.kind('line')} as kind, {Q.heading('line')} as is_heading, {Q.contents_line('line')} as is_contents from given""")
def heading_classes(spark: SparkSession, sf: str) -> DataFrame:
    c = chapters_once(spark, sf)
    given = c.select(F.col("title").alias("line")).union(c.select("start_marker")).union(manuscript_lines(spark, sf).select("line")).where("line is not null").distinct()
    x = F.col("line")
    return given.select("line", T.heading_kind(x).alias("kind"), T.is_heading(x).alias("is_heading"), T.is_contents_line(x).alias("is_contents"))


_HEADS = f"""{_BODY},
body as (select m.doc_id, line_idx, line, line_idx - body_start as at_line, body_start, body_end from mlines m join bounds b on b.doc_id = m.doc_id where line_idx >= body_start and line_idx < body_end),
blocks as (select *, (coalesce(min(case when {Q.strip('line')} = '' then line_idx end) over ahead, max(line_idx) over ahead + 1) - line_idx)::int as block_len from body window ahead as (partition by doc_id order by line_idx rows between current row and unbounded following)),
hs as (select *, lag(at_line) over (partition by doc_id order by at_line) as prev from blocks where {Q.heading('line')}),
isl as (select *, sum(case when at_line - prev <= 4 then 0 else 1 end) over (partition by doc_id order by at_line) as island from hs),
runs as (select *, count(*) over (partition by doc_id, island) as run from isl),
heads as (select *, row_number() over (partition by doc_id order by at_line)::int as number from (select *, max(case when run < 3 then 1 else 0 end) over (partition by doc_id) as sparse from runs) where (run < 3 or sparse = 0) and block_len <= 2)"""


@query(f"with {_HEADS} select doc_id, number, {Q.strip('line')} as title, line_idx, block_len from heads")
def chapter_headings(spark: SparkSession, sf: str) -> DataFrame:
    body = S.block_lengths(S.body_lines(manuscript_lines(spark, sf), "doc_id"), "doc_id")
    return S.headings(body, "doc_id").select("doc_id", "number", T.strip(F.col("line")).alias("title"), "line_idx", "block_len")


@query(f"with {_HEADS} select doc_id, max(block_len) as longest, sum(block_len)::bigint as total, count(*) as n from blocks group by doc_id")
def block_lengths(spark: SparkSession, sf: str) -> DataFrame:
    body = S.block_lengths(S.body_lines(manuscript_lines(spark, sf), "doc_id"), "doc_id")
    return body.groupBy("doc_id").agg(F.max("block_len").alias("longest"), F.sum("block_len").alias("total"), F.count("*").alias("n"))


_CHAPS = f"""{_HEADS},
nexts as (select *, lead(at_line) over (partition by doc_id order by number) as next_at from heads),
lasts as (select doc_id, at_line as last_at from nexts where next_at is null),
backs as (select b.doc_id, min(b.at_line) as back_at from blocks b join lasts l on l.doc_id = b.doc_id where b.at_line > l.last_at and {Q.kind('b.line')} = 'back' group by b.doc_id),
mchaps as (select n.doc_id, number, {Q.strip('line')} as title, {Q.kind('line')} as kind, (body_start + at_line + 1)::int as start_line, (body_start + coalesce(next_at, back_at, body_end - body_start))::int as end_line from nexts n left join backs using (doc_id))"""


@query(f"with {_CHAPS} select * from mchaps")
def chapter_bounds(spark: SparkSession, sf: str) -> DataFrame:
    return S.chapters(manuscript_lines(spark, sf), "doc_id")


@query(f"""with {_CHAPS},
txt as (select c.doc_id, c.number, regexp_replace(string_agg(m.line, chr(10) order by m.line_idx), {Q.lit(T.ILLUSTRATION)}, '', 'g') as t from mchaps c join mlines m on m.doc_id = c.doc_id and m.line_idx + 1 between c.start_line and c.end_line group by c.doc_id, c.number)
select doc_id, number, {Q.word_count('t')}::int as word_count, {Q.strip("regexp_replace(t, '\\n{4,}', chr(10) || chr(10) || chr(10), 'g')")} as text from txt""")
def chapter_texts(spark: SparkSession, sf: str) -> DataFrame:
    lines = manuscript_lines(spark, sf)
    return S.chapter_texts(lines, S.chapters(lines, "doc_id"), "doc_id")


_DOC_LINES = f"""t as (select doc_id, string_split_regex(text, {Q.lit(P.LINE_END)}) as ls from documents where text is not null),
u as (select doc_id, case when ls[-1] = '' then ls[:-2] else ls end as ls from t),
mlines as (select doc_id, unnest(range(len(ls)))::int as line_idx, unnest(ls) as line from u)"""


@query(f"""with {_HEADS.replace(SQL_LINES, _DOC_LINES)},
firsts as (select doc_id, min(at_line) as first_at from heads group by doc_id),
region as (select b.doc_id, b.at_line, b.line, {Q.contents_line('b.line')} as listed from blocks b left join firsts f using (doc_id) where (f.first_at is null or b.at_line < f.first_at) and {Q.strip('b.line')} <> '' and not contains(lower(b.line), '[illustration')),
prose as (select doc_id, max(at_line) as last_prose from region where not listed group by doc_id),
stops as (select r.doc_id, max(at_line) as stop from region r join prose p using (doc_id) where listed and at_line < last_prose group by r.doc_id),
found as (select r.doc_id, min(at_line) as block_start, sum({Q.word_count('line')})::bigint as words, max(case when {Q.kind('line')} <> 'body' then 1 else 0 end) as matter from region r left join stops s using (doc_id) where not listed and at_line > coalesce(stop, -1) group by r.doc_id)
select doc_id, (block_start + 1)::int as start_line, words from found where words >= 50 and matter = 0""")
def first_chapter_promotion(spark: SparkSession, sf: str) -> DataFrame:
    """Documents that begin with a chapter without a heading."""
    return S.unlabeled_first_chapter(S.explode_lines(table(spark, sf, "documents").where("text is not null"), "doc_id"), "doc_id")


@query(f"""with {Q.CHAPTERS},
body as (select book_id, body_end_line - body_start_line as body from (select *, row_number() over (partition by book_id order by ingested_at desc) as nth from books) where nth = 1),
lines as (select c.book_id, coalesce(max(b.body), max(c.end_line)) as line_count from chaps c left join body b on b.book_id = c.book_id group by c.book_id),
k as (select c.book_id, chapter_number, title, start_line, {Q.kind("coalesce(title, '')")} as kind from chaps c join lines l on l.book_id = c.book_id where start_line >= 1 and start_line <= line_count),
f as (select *, row_number() over (partition by book_id, start_line order by chapter_number) as nth from k where kind = 'body')
select book_id, row_number() over (partition by book_id order by start_line, chapter_number)::int as number, title, start_line, kind from f where nth = 1""")
def validated_chapters(spark: SparkSession, sf: str) -> DataFrame:
    """Each book is bounded by the lines of its own body; where books does not tell them, by its chapters' largest end."""
    c = chapters_once(spark, sf)
    body = O.latest(table(spark, sf, "books"), "book_id", "ingested_at").select("book_id", (F.col("body_end_line") - F.col("body_start_line")).alias("body"))
    lines = c.groupBy("book_id").agg(F.max("end_line").alias("ends")).join(body, "book_id", "left").select("book_id", F.coalesce("body", "ends").alias("line_count"))
    proposed = c.select("book_id", F.col("chapter_number").alias("ord"), "title", F.col("start_line").cast("string").alias("start_line")).join(lines, "book_id")
    return S.validated_chapters(proposed, "book_id", F.col("line_count"))


@query(f"with {Q.CHAPTERS} select book_id, chapter_number, title, {Q.kind("coalesce(title, '')")} as heading_kind, end_line < start_line as is_empty from chaps where chapter_number in (1, 2, 3, 5)")
def selected_chapters(spark: SparkSession, sf: str) -> DataFrame:
    c = chapters_once(spark, sf).where(F.col("chapter_number").isin(1, 2, 3, 5))
    return c.select("book_id", "chapter_number", "title", T.heading_kind(F.coalesce("title", F.lit(""))).alias("heading_kind"), (F.col("end_line") < F.col("start_line")).alias("is_empty"))


@query(f"with {Q.CHAPTERS} select book_id, count(*) as chapters, count(*) filter (coalesce(word_count, 0) < 20) as short from chaps group by book_id having count(*) filter (coalesce(word_count, 0) < 20) * 5 >= count(*)")
def degenerate_books(spark: SparkSession, sf: str) -> DataFrame:
    return S.degenerate_books(chapters_once(spark, sf), "book_id")


@query(f"""with {Q.CHAPTERS}, m as (select book_id, median(word_count) as med from chaps group by book_id having count(*) >= 3 and median(word_count) <> 0)
select c.book_id, chapter_number, word_count, med as median from chaps c join m using (book_id) where word_count / med > 2.5 or word_count / med < 0.2""")
def size_outliers(spark: SparkSession, sf: str) -> DataFrame:
    return S.size_outliers(chapters_once(spark, sf), "book_id")


@query()
def unique_chapter_numbers(spark: SparkSession, sf: str) -> DataFrame:
    """Chapter numbers made to repeat, and made unique again by the fold."""
    c = chapters_once(spark, sf).select("book_id", F.col("chapter_number").alias("ord"), (F.col("chapter_number") / 2).cast("int").alias("number"))
    return S.unique_numbers(c, "book_id")


@query(f"""with {Q.CHAPTERS} select book_id, chapter_number, coalesce({Q.strip("string_split(title, chr(10))[1]")}, 'Chapter ' || chapter_number) as shown, coalesce(start_marker, title) as marker,
 coalesce(end_line - lead(start_line) over (partition by book_id order by chapter_number) + 1, 0)::int as overlap_lines from chaps""")
def chapter_titles(spark: SparkSession, sf: str) -> DataFrame:
    c = chapters_once(spark, sf)
    w = Window.partitionBy("book_id").orderBy("chapter_number")
    shown = F.coalesce(T.strip(F.get(F.split("title", "\n"), 0)), F.concat(F.lit("Chapter "), F.col("chapter_number")))
    return c.select("book_id", "chapter_number", shown.alias("shown"), F.coalesce("start_marker", "title").alias("marker"), F.coalesce(F.col("end_line") - F.lead("start_line").over(w) + 1, F.lit(0)).cast("int").alias("overlap_lines"))


@query()
def manuscript_books(spark: SparkSession, sf: str) -> DataFrame:
    """One joined text per manuscript, as a book source delivers it."""
    return manuscript_texts(spark, sf).select("doc_id", F.array_join("lines", "\n").alias("text"))
