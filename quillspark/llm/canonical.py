"""Problem 5: one consistent form for texts that read the same.

Texts are exploded to positioned code points, joined with broadcast tables
(decompositions, look-alikes, invisible characters), combining marks are put
in the order of their classes, and everything is recomposed and rebuilt.

The exploded relation never leaves the task: within an Arrow batch it is a set
of flat column vectors (row, position, code point), and the joins are lookups
in dense tables that every task builds once from the Unicode character data.
These tables have one entry per code point, so their size is fixed. Rows
whose texts hold plain ASCII only are already in the form and are not exploded.

Defined results: null stays null; empty and blank texts keep their length;
repeated rows give repeated results; other columns are passed through.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.llm.tables import slices, table
from quillspark.storage import materialize

# Letters of other scripts that look like a Latin letter.
LOOK_ALIKES = {
    # Cyrillic
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "Х": "X",
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x",
    "Ѕ": "S", "І": "I", "Ј": "J", "ѕ": "s", "і": "i", "ј": "j", "һ": "h", "ԁ": "d", "ԛ": "q", "ԝ": "w", "Ү": "Y", "ү": "y",
    # Greek
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X",
    "ν": "v", "ο": "o", "ϳ": "j",
}

#: Compatibility tags whose characters read as their plain ones.
PLAIN_TAGS = ("<wide>", "<narrow>", "<isolated>", "<initial>", "<medial>", "<final>")
#: Joined Latin, Armenian and Hebrew letters, and the two-letter forms.
JOINED = [*range(0xFB00, 0xFB07), *range(0xFB13, 0xFB18), 0xFB4F, 0x132, 0x133, *range(0x1C4, 0x1CD), 0x1F1, 0x1F2, 0x1F3]
#: Members of a class above which its pairs are made in parts.
GROUP_PART = 10_000
LINE_BREAKS = "\r\x0b\x0c\x85\u2028\u2029"
_SIZE = sys.maxunicode + 1
_FAR = 0xF0000  # stands for a row's end; private, and never in the tables


@lru_cache(maxsize=1)
def tables() -> dict[str, np.ndarray]:
    """The mapping tables, built from the character data by the rules above."""
    start = np.zeros(_SIZE, np.int32)
    length = np.ones(_SIZE, np.uint8)
    ccc = np.zeros(_SIZE, np.uint8)
    special = np.zeros(_SIZE, bool)
    flat: list[int] = [0]  # a start of 0 means: no mapping
    pairs: dict[tuple[int, int], int] = {}

    def plain(cp: int) -> list[int]:
        ch = chr(cp)
        if unicodedata.category(ch) == "Zs" or ch == "\t":
            return [32]
        if ch in LINE_BREAKS:
            return [10]
        d = unicodedata.decomposition(ch).split()
        if d and (d[0][0] != "<" or d[0] in PLAIN_TAGS or cp in JOINED):
            return [y for x in d if x[0] != "<" for y in plain(int(x, 16))]
        return [ord(LOOK_ALIKES.get(ch, ch))]

    # the blocks between these ranges are ideographs and private characters, which map to themselves
    for cp in (*range(0x3400), *range(0xA000, 0xAC00), *range(0xF900, 0x20000), *range(0x2F800, 0x2FA20), *range(0xE0000, 0xE0200)):
        ch = chr(cp)
        ccc[cp] = unicodedata.combining(ch)
        kind = unicodedata.category(ch)
        if kind == "Cf" or kind == "Cc" and ch not in "\t\n" + LINE_BREAKS or cp in (0x34F, 0x115F, 0x1160, 0x3164, 0xFFA0) or 0xFE00 <= cp < 0xFE10 or 0x180B <= cp < 0x180E:
            length[cp], special[cp] = 0, True
            continue
        to = plain(cp)
        if to != [cp]:
            start[cp], length[cp], special[cp] = len(flat), len(to), True
            flat += to
        d = unicodedata.decomposition(ch).split()
        if len(d) == 2 and d[0][0] != "<" and unicodedata.normalize("NFC", ch) == ch:
            a, b = int(d[0], 16), int(d[1], 16)
            pairs.setdefault((ord(LOOK_ALIKES.get(chr(a), chr(a))), b), cp)
            if chr(a) not in LOOK_ALIKES:
                pairs[a, b] = cp
    special |= ccc > 0
    special[0x1100:0x1200] = True
    keys = np.array([(a << 21) | b for a, b in pairs], np.int64)
    order = np.argsort(keys)
    return {
        "start": start, "length": length, "ccc": ccc, "special": special, "flat": np.array(flat, np.uint32),
        "pair_keys": keys[order], "pair_to": np.array(list(pairs.values()), np.uint32)[order],
    }


def _compose(a: np.ndarray, b: np.ndarray, t: dict[str, np.ndarray]) -> np.ndarray:
    """The composed code point of each pair, 0 where there is none."""
    key = (a.astype(np.int64) << 21) | b
    at = np.minimum(np.searchsorted(t["pair_keys"], key), len(t["pair_keys"]) - 1)
    return np.where(t["pair_keys"][at] == key, t["pair_to"][at], 0)


def _order_and_recompose(cp: np.ndarray, t: dict[str, np.ndarray]) -> np.ndarray:
    ccc = t["ccc"][cp]
    if ccc.any():
        run = np.cumsum(ccc == 0)
        if ((ccc[1:] > 0) & (ccc[:-1] > ccc[1:])).any():
            order = np.lexsort((np.arange(len(cp)), ccc, run))
            cp, ccc = cp[order], ccc[order]
        mark = np.flatnonzero(ccc > 0)
        base = run[mark]  # the run's number; its starter is the run's first position
        first = np.searchsorted(run, base)
        rank = mark - first
        keep = np.ones(len(cp), bool)
        last = np.zeros(len(cp), np.uint8)  # class of the last mark that stayed, at the starter
        cp = cp.copy()
        k = 1
        while True:
            here = rank == k
            if not here.any():
                break
            m, s = mark[here], first[here]
            to = _compose(cp[s], cp[m], t)
            ok = (to > 0) & (ccc[m] > last[s]) & (ccc[s] == 0)
            cp[s[ok]] = to[ok]
            keep[m[ok]] = False
            last[s[~ok]] = ccc[m[~ok]]
            k += 1
        cp = cp[keep]
    lead = (cp >= 0x1100) & (cp < 0x1113)
    if lead.any():
        nxt = np.append(cp[1:], 0)
        at = np.flatnonzero(lead & (nxt >= 0x1161) & (nxt < 0x1176))
        cp = cp.copy()
        cp[at] = 0xAC00 + ((cp[at] - 0x1100) * 21 + (cp[at + 1] - 0x1161)) * 28
        cp = np.delete(cp, at + 1)
    tail = (cp > 0x11A7) & (cp < 0x11C3)
    if tail.any():
        at = np.flatnonzero(tail)
        at = at[at > 0]
        prev = cp[at - 1]
        at = at[(prev >= 0xAC00) & (prev < 0xD7A4) & ((prev - 0xAC00) % 28 == 0)]
        cp = cp.copy()
        cp[at - 1] += cp[at] - 0x11A7
        cp = np.delete(cp, at)
    return cp


def canonical_texts(texts: list[str | None]) -> list[str | None]:
    """The consistent form of each text."""
    out = list(texts)
    todo = []
    for i, x in enumerate(texts):
        if x:
            if chr(_FAR) in x:
                out[i] = chr(_FAR).join(canonical_texts(x.split(chr(_FAR))))
            elif not x.isascii():
                todo.append(i)
            elif not x.isprintable():
                out[i] = _plain_ascii(x)
    if not todo:
        return out
    t = tables()
    # one flat vector of code points; the end mark keeps each row's place
    cp = np.frombuffer((chr(_FAR).join([texts[i] for i in todo]) + chr(_FAR)).encode("utf-32-le", "surrogatepass"), np.uint32)
    # rows with no character of the tables are in the form already
    ends = np.flatnonzero(cp == _FAR)
    cut = np.concatenate(([0], ends[:-1] + 1))
    touched = np.add.reduceat(t["special"][cp], cut) > 0
    crlf = (cp == 10) & (np.concatenate(([0], cp[:-1])) == 13)
    if not touched.all():
        row = np.zeros(len(cp), np.int32)
        row[ends[:-1] + 1] = 1
        keep = touched[np.cumsum(row)]
        cp, crlf = cp[keep], crlf[keep]
        todo = [i for i, k in zip(todo, touched) if k]
    if not todo:
        return out
    cp = cp[~crlf]  # CR LF is one line break, and CR becomes LF
    n = t["length"][cp].astype(np.int64)
    if t["special"][cp].any():
        src = np.repeat(np.arange(len(cp)), n)
        off = np.arange(len(src)) - np.repeat(np.cumsum(n) - n, n)
        old = cp[src]
        begin = t["start"][old]
        cp = np.where(begin > 0, t["flat"][begin + off], old).astype(np.uint32)
    cp = _order_and_recompose(cp, t)
    done = cp.tobytes().decode("utf-32-le", "surrogatepass").split(chr(_FAR))
    for i, x in zip(todo, done):
        out[i] = x
    return out


_ASCII = {i: None for i in range(32)} | {9: " ", 10: "\n", 11: "\n", 12: "\n", 13: "\n", 127: None}


def _plain_ascii(x: str) -> str:
    return x.replace("\r\n", "\n").translate(_ASCII)


def _map_form(batches: Iterator[pa.RecordBatch], column: str, to: str) -> Iterator[pa.RecordBatch]:
    for b in slices(batches, 4000):
        form = pa.array(canonical_texts(b.column(b.schema.get_field_index(column)).to_pylist()), pa.string())
        yield pa.RecordBatch.from_arrays([*b.columns, form], [*b.schema.names, to])


def canonical_form(df: DataFrame, text: str = "text", to: str = "form") -> DataFrame:
    """``df`` with the consistent form of ``text`` in the column ``to``.

    A column named like ``to`` is replaced. The work is done row by row in
    Arrow batches: no shuffle.
    """
    df = df.drop(to)
    schema = df.select("*", F.lit("").cast("string").alias(to)).schema
    schema[to].nullable = True
    return df.mapInArrow(lambda it: _map_form(it, text, to), schema)


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """segment_id, book_id, digest of the form (two longs), digest of the stored text."""
    for b in slices(batches, 4000):
        raw = b.column(2).to_pylist()
        forms = canonical_texts(raw)
        keep = np.array([bool(x) and not x.isspace() and f is not None and bool(f.strip()) for x, f in zip(raw, forms)], bool)
        if not keep.any():
            continue
        kept = [(x, f) for x, f, k in zip(raw, forms, keep) if k]
        d = [xxhash.xxh3_128_digest(f.encode("utf-8", "surrogatepass")) for _, f in kept]
        two = np.frombuffer(b"".join(d), ">i8").astype(np.int64).reshape(-1, 2)
        stored = np.array([xxhash.xxh3_64_intdigest(x.encode("utf-8", "surrogatepass")) for x, _ in kept], np.uint64).view(np.int64)
        mask = pa.array(keep)
        yield pa.RecordBatch.from_arrays(
            [b.column(0).filter(mask), b.column(1).filter(mask), pa.array(two[:, 0].copy()), pa.array(two[:, 1].copy()), pa.array(stored)],
            ["segment_id", "book_id", "k1", "k2", "stored"],
        )


def same_reading_members(segments: DataFrame) -> DataFrame:
    """(book_id, k1, k2, segment_id, stored, parts): members of classes of one form with different stored texts.

    Needs segment_id, book_id, text. Redelivered rows count once; null and
    blank texts never count; a null book_id belongs to no book.

    Texts are read once and shrink to digests (128 bits of the form, 64 of the
    stored text). Groups are first reduced to their stored forms, so a group
    of a million copies is one row in the shuffle; only groups with two forms
    or more are looked at again, and a pair joins different forms only.
    """
    rows = segments.where(F.col("text").isNotNull() & F.col("book_id").isNotNull()).select("segment_id", "book_id", "text")
    keyed = materialize(rows.mapInArrow(_keys, "segment_id bigint, book_id string, k1 bigint, k2 bigint, stored bigint"), "p5-keys")
    group = ["book_id", "k1", "k2"]
    several = keyed.groupBy(*group).agg(F.min("stored").alias("lo"), F.max("stored").alias("hi"), F.count("*").alias("n")).where("lo <> hi")
    parts = several.select(*group, F.ceil(F.col("n") / GROUP_PART).alias("parts"))
    return keyed.join(parts, group).distinct()


def same_reading_pairs(segments: DataFrame) -> DataFrame:
    """The pairs segment_id_a < segment_id_b of the members of a class that are stored differently.

    A large class is split: each of its parts meets copies of the whole class.
    """
    members = same_reading_members(segments)
    on = ["book_id", "k1", "k2", "part"]
    a = members.withColumn("part", F.pmod(F.xxhash64("segment_id"), F.col("parts"))).select(*on, F.col("segment_id").alias("segment_id_a"), F.col("stored").alias("stored_a"))
    b = members.withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1))).select(*on, F.col("segment_id").alias("segment_id_b"), F.col("stored").alias("stored_b"))
    return a.join(b, on).where("segment_id_a < segment_id_b and stored_a <> stored_b").select("segment_id_a", "segment_id_b").distinct()


def same_reading_classes(segments: DataFrame) -> DataFrame:
    """(segment_id, book_id, class, members, forms, links): classes of segments that read the same and are not all stored alike.

    ``class`` is the least segment_id; a member's links are the members less those of its own form.
    """
    members = same_reading_members(segments)
    group = ["book_id", "k1", "k2"]
    forms = members.groupBy(*group, "stored").agg(F.count("*").alias("of_form"), F.min("segment_id").alias("least"))
    classes = forms.groupBy(*group).agg(F.min("least").alias("class"), F.sum("of_form").alias("members"), F.count("*").alias("forms"))
    return members.join(forms.drop("least"), [*group, "stored"]).join(classes, group).select("segment_id", "book_id", "class", "members", "forms", (F.col("members") - F.col("of_form")).alias("links"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments of a book that are stored differently and read the same."""
    return same_reading_pairs(table(spark, sf_dir, "segments"))


def p5_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as classes, one row per segment."""
    return same_reading_classes(table(spark, sf_dir, "segments"))


def p5_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The consistent form of every segment; redelivered rows count once, rows without an id are segments of their own."""
    df = canonical_form(table(spark, sf_dir, "segments").select("segment_id", "text"))
    return df.where("segment_id is not null").groupBy("segment_id").agg(F.any_value("form").alias("form")).unionByName(df.where("segment_id is null").select("segment_id", "form"))
