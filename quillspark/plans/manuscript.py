"""Book-shaped text out of the table of documents.

Every document becomes one manuscript: preamble, body marks, a contents list, a
dedication, chapters, quotations with tags, footnotes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The speakers of the manuscripts' tags.
SPEAKERS = ["Lucy", "Mr. Bennet", "Captain Ahab", "Miss Bartlett", "Mrs. Long"]

_HEAD = """array(concat('Title: Document ', doc_id), concat('Author: ', source), concat('Language: ', lang),
  concat('Release date: January 1, 2024 [eBook #', doc_id, ']'), '', 'Produced by the fixture', '',
  concat('*** START OF THE PROJECT ARCHIVE EBOOK ', doc_id, ' ***'), '', 'CHAPTER 1', 'CHAPTER 2', 'CHAPTER 3', '',
  'DEDICATION', '', 'To someone dear.', '')"""
_NAME = "element_at(array('Lucy', 'Mr. Bennet', 'Captain Ahab', 'Miss Bartlett', 'Mrs. Long'), cast((doc_id + i) % 5 + 1 as int))"
_EXPANDED = f"""flatten(transform(ls, (t, i) -> concat(
  if(i = 0, {_HEAD}, array()),
  if(i % 5 = 0, array(concat('CHAPTER ', cast(i div 5 + 1 as string)), ''), array()),
  if(trim(t) = '', array(), array(case i % 4 when 0 then t when 1 then concat('“', t, '” said ', {_NAME}, ',')
     when 2 then concat('“', t, '” replied ', {_NAME}, '.') else concat({_NAME}, ' continued: “', t) end, '')),
  if(i = size(ls) - 1, array('FOOTNOTES:', '', concat('1. ', source), concat('*** END OF THE PROJECT ARCHIVE EBOOK ', doc_id, ' ***')), array()))))"""


def manuscript_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, book_id, lines): one row per document with text."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("text is not null")
    plain = docs.select("doc_id", "book_id", F.coalesce("source", F.lit("")).alias("source"), F.coalesce("lang", F.lit("")).alias("lang"), F.split(F.regexp_replace("text", "\r\n?", "\n"), "\n").alias("ls"))
    return plain.select("doc_id", "book_id", F.expr(_EXPANDED).alias("lines"))


def manuscript_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, line_idx, line): line numbers from 0. No shuffle."""
    return manuscript_texts(spark, sf_dir).select("doc_id", F.posexplode("lines").alias("line_idx", "line"))


_SQL_NAME = "(['Lucy', 'Mr. Bennet', 'Captain Ahab', 'Miss Bartlett', 'Mrs. Long'])[cast((doc_id + i - 1) % 5 + 1 as int)]"
SQL_LINES = f"""
plain as (select doc_id, book_id, coalesce(source, '') as source, coalesce(lang, '') as lang, string_split(replace(replace(text, chr(13) || chr(10), chr(10)), chr(13), chr(10)), chr(10)) as ls from documents where text is not null),
manuscript as (select doc_id, book_id, flatten(list_transform(ls, lambda t, i:
  case when i = 1 then ['Title: Document ' || doc_id, 'Author: ' || source, 'Language: ' || lang, 'Release date: January 1, 2024 [eBook #' || doc_id || ']', '', 'Produced by the fixture', '',
    '*** START OF THE PROJECT ARCHIVE EBOOK ' || doc_id || ' ***', '', 'CHAPTER 1', 'CHAPTER 2', 'CHAPTER 3', '', 'DEDICATION', '', 'To someone dear.', ''] else [] end
  || case when (i - 1) % 5 = 0 then ['CHAPTER ' || cast((i - 1) // 5 + 1 as varchar), ''] else [] end
  || case when trim(t) = '' then [] else [case (i - 1) % 4 when 0 then t when 1 then '“' || t || '” said ' || {_SQL_NAME} || ',' when 2 then '“' || t || '” replied ' || {_SQL_NAME} || '.' else {_SQL_NAME} || ' continued: “' || t end, ''] end
  || case when i = len(ls) then ['FOOTNOTES:', '', '1. ' || source, '*** END OF THE PROJECT ARCHIVE EBOOK ' || doc_id || ' ***'] else [] end)) as lines from plain),
mlines as (select doc_id, unnest(range(len(lines)))::int as line_idx, unnest(lines) as line from manuscript)
"""
