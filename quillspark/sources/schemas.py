"""The records of a book as Spark types, and their JSON forms.

Readers are lenient: key fields are required, everything else has a default.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fields by record, in the order of their JSON form.
SEGMENT = "type string, text string, speaker string, pronunciation_hints array<string>, notes string"
CHAPTER_INFO = "number int, title string, start_line int, end_line int, word_count int, start_marker string, kind string"
CHARACTER = "name string, aliases array<string>, pronunciation_hints array<string>, first_appearance_chapter int"
METADATA = "title string, author string, language string, gutenberg_id string, release_date string, credits string"
CRITIC_REPORT = "chapter_number int, missing_text array<string>, attribution_issues array<string>, name_inconsistencies array<string>, overall_quality double, needs_reprocessing boolean, fixed_segments array<struct<index:int,speaker:string>>"
PROCESSED_CHAPTER = f"chapter_number int, chapter_title string, segments array<struct<{SEGMENT.replace(' ', ':').replace(',:', ',')}>>, discovered_characters array<struct<{CHARACTER.replace(' ', ':').replace(',:', ',')}>>, word_count int, is_segment boolean, segment_index int, total_segments int"
DISCOVERY = f"metadata struct<{METADATA.replace(' ', ':').replace(',:', ',')}>, chapters array<struct<{CHAPTER_INFO.replace(' ', ':').replace(',:', ',')}>>, body_start_line int, body_end_line int"

_NO_STRINGS = "cast(array() as array<string>)"
DEFAULTS = {
    SEGMENT: {"pronunciation_hints": _NO_STRINGS},
    CHAPTER_INFO: {"word_count": "0", "start_marker": "''", "kind": "'body'"},
    CHARACTER: {"aliases": _NO_STRINGS, "pronunciation_hints": _NO_STRINGS, "first_appearance_chapter": "1"},
    METADATA: {"title": "''", "author": "''", "language": "'en'", "gutenberg_id": "''", "release_date": "''", "credits": "''"},
    CRITIC_REPORT: {"missing_text": _NO_STRINGS, "attribution_issues": _NO_STRINGS, "name_inconsistencies": _NO_STRINGS, "overall_quality": "double(1.0)", "needs_reprocessing": "false"},
    PROCESSED_CHAPTER: {"is_segment": "false", "total_segments": "1", "word_count": "0"},
    DISCOVERY: {},
}


def to_json(record: Column) -> Column:
    """A record's JSON form, nulls included."""
    return F.to_json(record, {"ignoreNullFields": "false"})


def from_json(text: Column, ddl: str) -> Column:
    """A record out of its JSON form, missing fields with their defaults; null where it is no JSON."""
    r = F.from_json(text, ddl)
    for field, default in DEFAULTS[ddl].items():
        r = r.withField(field, F.coalesce(r[field], F.expr(default)))
    return F.when(F.from_json(text, ddl).isNotNull(), r)
