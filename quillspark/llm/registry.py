"""The queries of this subpackage, and their SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quillspark.llm import canonical, encoding, leaks, names, packing, pieces, sentences, subjects


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "p1_found": sentences.p1_found,
        "p2_containers": packing.p2_containers,
        "p2_fill": packing.p2_fill,
        "p3_found": pieces.p3_found,
        "p3_pieces": pieces.p3_pieces,
        "p4_found": names.p4_found,
        "p4_entities": names.p4_entities,
        "p5_found": canonical.p5_found,
        "p5_classes": canonical.p5_classes,
        "p5_forms": canonical.p5_forms,
        "p6_ids": encoding.p6_ids,
        "p6_decoded": encoding.p6_decoded,
        "p7_found": leaks.p7_found,
        "p8_found": subjects.p8_found,
        "p8_mixtures": subjects.p8_mixtures,
    }


#: A stretch between Unicode white space.
WORD = r"[^\s\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"


def oracle_sql() -> dict[str, str]:
    return {
        "p3_found": f"""
            select distinct s.segment_id
            from segments s left join run_configs c on c.config_id = s.config_id
            where case when coalesce(c.size_unit, 'word') = 'char' then length(s.text) else len(regexp_extract_all(s.text, '{WORD}')) end > coalesce(c.chunk_size, 1000)
        """,
        "p6_decoded": "select doc_id, coalesce(text, '') as text from documents",
    }
