"""Problem 3: cutting oversized texts at natural boundaries, with overlap.

A text is a sequence of units (words between white space, or code points). The
offsets of the units are prefix sums, and the natural boundaries (paragraph,
sentence, clause and word ends) are sorted arrays of unit numbers. A piece ends
at the last boundary within the limit, found by binary search at the strongest
kind that leaves at least half a piece; where no boundary is left it ends
hard at the limit. The next piece starts ``chunk_overlap`` units earlier.

Defined results: null and empty texts have no piece; a text within the limit
is one piece. A null chunk_size or chunk_overlap is 1000 or 150, a null unit is
``word``, a chunk_size below 1 is 1, a negative overlap is 0, and an overlap of
chunk_size or more is chunk_size - 1, the most that still moves on. Segments
without a row of run_configs get the defaults. The pieces cover the whole text,
white space included; in words, space between two pieces belongs to the former.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.llm.sentences import plain_sentences
from quillspark.llm.tables import slices, table

DEFAULT_SIZE, DEFAULT_OVERLAP, DEFAULT_UNIT = 1000, 150, "word"
_PARAGRAPH = re.compile(r"(?:\r\n|\r|\n)[^\S\r\n]*(?:\r\n|\r|\n)\s*")
_CLAUSE = re.compile(r"[,;:，、；：،؛][”’»\")\]」』]*\s*|\s[—–-]\s|(?:\r\n|\r|\n)\s*")
_WORD = re.compile(r"\S+")
_SPACE = re.compile(r"\s+")


def _boundaries(text: str, offsets: np.ndarray, unit: str) -> list[list[int]]:
    """Unit numbers before which a piece may end, strongest kind first."""
    kinds = [
        [m.end() for m in _PARAGRAPH.finditer(text)],
        [s for s, _ in plain_sentences(text)[1:]],
        [m.end() for m in _CLAUSE.finditer(text)],
    ]
    if unit == "char":
        kinds.append([m.end() for m in _SPACE.finditer(text)])
    # a cut at a text position is a cut before the first unit at or after it
    return [sorted({int(x) for x in np.searchsorted(offsets, np.array(k, np.int64))}) if k else [] for k in kinds]


def cut_units(n: int, limit: int, overlap: int, kinds: list[list[int]]) -> list[tuple[int, int]]:
    """The pieces [from, to) of ``n`` units."""
    out, start = [], 0
    while n - start > limit:
        end = 0
        for least in (max(overlap + 1, limit // 2), overlap + 1):
            for k in kinds:
                i = bisect_right(k, start + limit)
                if i and k[i - 1] >= start + least:
                    end = k[i - 1]
                    break
            if end:
                break
        end = end or start + limit
        out.append((start, end))
        start = end - overlap
    out.append((start, n))
    return out


def cut(text: str, limit: int, overlap: int, unit: str) -> list[tuple[int, int, int]]:
    """The pieces of one text: start, end (code points) and size in units."""
    limit = max(1, limit)
    overlap = max(0, min(overlap, limit - 1))
    if unit == "char":
        n = len(text)
        if n <= limit:
            return [(0, n, n)]
        offsets = np.arange(n)
    else:
        if len(text) < 2 * limit or len(text.split()) <= limit:
            return [(0, len(text), len(text.split()))]
        offsets = np.array([m.start() for m in _WORD.finditer(text)], np.int64)
        n = len(offsets)
    out = []
    for a, b in cut_units(n, limit, overlap, _boundaries(text, offsets, unit)):
        out.append((0 if a == 0 else int(offsets[a]), len(text) if b == n else int(offsets[b]), b - a))
    return out


def with_sizes(segments: DataFrame, configs: DataFrame) -> DataFrame:
    """``segments`` with chunk_size, chunk_overlap and size_unit of their configuration.

    A repeated config_id counts once. Catalyst decides how to join by the size of ``configs``.
    """
    c = configs.where("config_id is not null").groupBy("config_id").agg(F.first(F.struct("chunk_size", "chunk_overlap", "size_unit")).alias("_sizes"))
    joined = segments.drop("chunk_size", "chunk_overlap", "size_unit", "_sizes").join(c, "config_id", "left")
    return joined.select(
        "*",
        F.coalesce("_sizes.chunk_size", F.lit(DEFAULT_SIZE)).cast("int").alias("chunk_size"),
        F.coalesce("_sizes.chunk_overlap", F.lit(DEFAULT_OVERLAP)).cast("int").alias("chunk_overlap"),
        F.coalesce("_sizes.size_unit", F.lit(DEFAULT_UNIT)).alias("size_unit"),
    ).drop("_sizes")


def _cut_batches(batches: Iterator[pa.RecordBatch], with_text: bool, only_cut: bool) -> Iterator[pa.RecordBatch]:
    for b in slices(batches):
        cols: tuple[list, ...] = ([], [], [], [], [], [])
        for seg, text, limit, overlap, unit in zip(*(c.to_pylist() for c in b.columns)):
            if not text or only_cut and len(text) <= limit:
                continue
            pieces = cut(text, limit, overlap, unit)
            if only_cut and len(pieces) == 1:
                continue
            for i, (s, e, n) in enumerate(pieces):
                for c, v in zip(cols, (seg, i, s, e, n, text[s:e] if with_text else None)):
                    c.append(v)
        types = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], ["segment_id", "piece_no", "start_pos", "end_pos", "size", "piece"])


def pieces(segments: DataFrame, configs: DataFrame, with_text: bool = True, only_cut: bool = False) -> DataFrame:
    """One row per piece: segment_id, piece_no, start_pos, end_pos, size, piece.

    Row by row, no shuffle; a redelivered segment repeats its pieces, so
    callers that count segments drop repeats by (segment_id, piece_no).
    """
    sized = with_sizes(segments.select("segment_id", "text", "config_id"), configs).select("segment_id", "text", "chunk_size", "chunk_overlap", "size_unit")
    return sized.mapInArrow(lambda it: _cut_batches(it, with_text, only_cut), "segment_id bigint, piece_no int, start_pos int, end_pos int, size int, piece string")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The segments that are cut, as the cutting operator cuts them."""
    cut_ones = pieces(table(spark, sf_dir, "segments"), table(spark, sf_dir, "run_configs"), with_text=False, only_cut=True)
    return cut_ones.where("piece_no = 1").select("segment_id").distinct()


def p3_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every segment that is cut, redelivered segments once."""
    cut_ones = pieces(table(spark, sf_dir, "segments"), table(spark, sf_dir, "run_configs"), only_cut=True)
    known = cut_ones.where("segment_id is not null").dropDuplicates(["segment_id", "piece_no"])
    return known.unionByName(cut_ones.where("segment_id is null"))  # rows without an id are segments of their own
