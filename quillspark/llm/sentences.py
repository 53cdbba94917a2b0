"""Problem 1: sentence boundaries across languages and scripts.

Document-centred disambiguation. One pass over the texts finds every place
where a sentence may end. Most places decide themselves (``!``, a period after
an ordinary word before a lower-case word, the terminators of scripts with
their own, blank lines). A period before a capital or a digit does not: its
token may be an abbreviation and the next word a name. Such places carry both
words, and the same pass gathers unambiguous evidence of each book (the
document): words with a capital in mid-sentence are names, words that open a
sentence after an unambiguous end and are no names are common words.

An abbreviation that belongs to what follows (a title, an initial, ``No.``)
is one that common words hardly ever follow. That is counted for each token in
its book; where the book is silent, in the corpus; where the corpus is silent,
the token's shape decides. All of this is grouping and joining of short rows:
no text is shuffled.

Defined results: null and blank texts, and rows without a segment_id, have no
sentences; a redelivered segment counts once; a text without any end mark is one
sentence.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.llm.canonical import LOOK_ALIKES
from quillspark.llm.tables import slices, table
from quillspark.storage import materialize

# The last resort, for tokens that neither book nor corpus shows often enough.
KNOWN_ABBREVIATIONS = {
    "mr", "mrs", "ms", "dr", "st", "mme", "mlle", "prof", "rev", "capt", "gen", "lieut", "lt", "col", "sgt", "maj", "hon", "sr", "sra", "hr", "fr",
    "no", "nos", "vol", "fig", "p", "pp", "cf", "vs", "viz", "e.g", "i.e", "bd", "nr", "vgl", "ca", "bzw", "pág", "núm", "ул", "им", "стр", "см",
}
# Abbreviations that close a list, a name or a time of day. They belong to what stands before them, so a capital after them opens a sentence.
CLOSING_ABBREVIATIONS = {"etc", "a.m", "p.m", "ltd", "inc", "co", "corp", "usw", "u.s.w", "jr", "esq", "т. д", "т. п", "и др", "др", "b.c", "a.d"}
#: Below these counts a book's, and the corpus's, evidence on a token is not used.
BOOK_LEAST, CORPUS_LEAST = 4, 8
#: Share of common words among what follows from which a token ends sentences, in its book and in the corpus.
BOOK_SHARE, CORPUS_SHARE = 0.25, 0.08
#: Share of what follows a token that must be known as a name or a common word for its evidence to count.
TOLD_SHARE = 0.3

#: Letters of a lower-case word from which it is no abbreviation: a rule of the scripts with small letters, not a bound.
WORD_LETTERS = 7
INVISIBLE = "\u00ad\u200b-\u200f\u2060-\u2064\ufeff"
_DROP_INVISIBLE = dict.fromkeys([0xAD, *range(0x200B, 0x2010), *range(0x2060, 0x2065), 0xFEFF])
_FOLD = str.maketrans(LOOK_ALIKES) | _DROP_INVISIBLE
_OPEN = "“‘«„‚‹([{（「『【〈《〔¿¡\"'*_"
_DASH = "—–-"
_CLOSE = "”’»\"')\\]}）」』】〉》〕›"
_HAN_END = "。！？｡"
_CANDIDATE = re.compile(
    rf"(?:[.!?…。！？｡؟।॥۔‼⁇⁈⁉．]|(?<=[Ͱ-Ͽἀ-\u1fffA-Za-ź])[;;])[.!?…。！？｡؟।॥‼⁇⁈⁉．{INVISIBLE}]*"
    rf"(?:[{INVISIBLE}]*(?:[{_CLOSE}]|[ \u00a0\u202f]»|“(?=[\s{_CLOSE},;:.]|$)))*[{INVISIBLE}]*"
)
_BLANK_LINE = re.compile(r"(?:\r\n|\r|\n)[^\S\r\n]*(?:(?:\r\n|\r|\n)[^\S\r\n]*)+")
_HEADING = re.compile(r"\s*(?:chapter|part|book|section|canto|act|scene|letter|kapitel|chapitre|capítulo|глава)\s+[\divxlcdm]+\b[^\r\n]*\s*", re.I)
_THAI = re.compile(r"[\u0e00-\u0e7f]")
_THAI_GAP = re.compile(rf"(?<=[\u0e00-\u0e7f{INVISIBLE}”’»\")\]])\s+(?=[“‘«(\[{INVISIBLE}]*[\u0e00-\u0e7f])")
_GREEK = re.compile(r"[α-ωά-ώἀ-\u1fff]")
_MID_CAPITAL = re.compile(r"(?<=[a-zà-öø-ÿа-яёα-ω,;] )[A-ZÀ-ÖØ-ÞА-ЯΑ-Ω]\w+(?![\w.])")
_WORD = re.compile(r"\w+(?:[.’']\w+)*")

# How a speech tag after a closing quotation mark goes on, in scripts without capitals.
_TAG_HAN = re.compile(r"[^，。！？、“”「」：\s]{1,16}?(?:说|說|问|問|道|答|喊|叫|曰|讲)(?:着|了)?[，。！？,：]")
_TAG_JA = re.compile(r"(?:と|って|など|の|は|が|を|に|も)")
_TAG_KO = re.compile(r"(?:하고|하며|라고|라며|이라고|고|며|라는)(?![가-힣]*[.!?])")
_TAG_HI = re.compile(r"(?:[^\s।!?“”]+\s+){0,5}(?:कहा|पूछा|बोला|बोली|बोले|चिल्लाया)")
_TAG_AR = re.compile(r"(?:قال|قالت|سأل|سألت|أجاب|أجابت|صاح|صاحت|همس|همست)(?:\s|$)")
_TAG_TH = re.compile(r"[\u0e00-\u0e7f]{0,24}?(?:กล่าว|ถาม|พูด|ตอบ|ตะโกน)")
#: What ends the stretch that a tag is looked for in.
_REST = re.compile(r"[^.!?…。！？।॥؟\r\n]*[.!?…。！？।॥؟\r\n]?")
_STOPS = re.compile(r"[\s“”‘«»„(\[{「『—,;:!?]+")
_QUOTES = {"”": "“", "»": "«", "」": "「", "』": "『", '"': '"', "’": "‘", "“": "„"}


def _script(ch: str) -> str:
    o = ord(ch)
    if 0x0900 <= o < 0x0980:
        return "hi"
    if 0x0600 <= o < 0x0780 or 0xFB50 <= o < 0xFF00 and o >= 0xFB50 and (o < 0xFE00 or 0xFE70 <= o < 0xFF00):
        return "ar"
    if 0x0E00 <= o < 0x0E80:
        return "th"
    if 0x3040 <= o < 0x3100 or 0xFF66 <= o < 0xFFA0:
        return "ja"
    if 0x3400 <= o < 0xA000 or 0xF900 <= o < 0xFB00 or 0x20000 <= o < 0x30000:
        return "han"
    if 0xAC00 <= o < 0xD7B0 or 0x1100 <= o < 0x1200:
        return "ko"
    return ""


class _Places:
    """Where the marks of a text are, found once when they are first asked for, so that looking back takes no longer in long texts."""

    def __init__(self, text: str):
        self.text = text
        self.opens: dict[str, list[int]] = {}
        self.stops: list[tuple[int, int]] | None = None

    def last_open(self, mark: str, before: int) -> int:
        """The last ``mark`` before a position, or -1."""
        if mark not in self.opens:
            self.opens[mark] = [m.start() for m in re.finditer(re.escape(mark), self.text)]
        k = bisect_left(self.opens[mark], before)
        return self.opens[mark][k - 1] if k else -1

    def token(self, low: int, end: int) -> str:
        """The token that ends at ``end``, with a single initial before it."""
        if self.stops is None:
            self.stops = [m.span() for m in _STOPS.finditer(self.text)]
        k = bisect_left(self.stops, (end,))
        start = max(low, self.stops[k - 1][1] if k else 0)
        found = self.text[start:end]
        if k and found and start > low and self.stops[k - 1][1] - self.stops[k - 1][0] == 1 and self.text[start - 1].isspace():
            i = start - 3  # an initial with its period, and no letter before it
            if i >= low and self.text[i + 1] == "." and self.text[i].isalpha() and not (i > low and self.text[i - 1].isalpha()):
                return self.text[i:end]
        return found


def _is_tag(text: str, j: int, script: str, closers: str, at: int, places: _Places) -> bool:
    """Whether a speech tag, or the rest of the sentence around it, follows a closed quotation at ``j``."""
    close = next((c for c in reversed(closers) if c in _CLOSE or c == "“"), "")
    if not close:
        return False
    # what follows up to the next end mark, however its characters are stored
    rest = unicodedata.normalize("NFC", _REST.match(text, j).group().translate(_DROP_INVISIBLE))
    if script in ("han", "ja"):
        if _TAG_JA.match(rest):
            return True
        if script == "ja":
            return False
    if close in _QUOTES:
        opened = places.last_open(_QUOTES[close], at)
        before = text[max(0, opened - 3) : opened].rstrip() if opened > 0 else ""
        if before and before[-1] in ":：,，،、":
            return False
    if script == "han":
        return bool(_TAG_HAN.match(rest))
    if script == "ko":
        return bool(_TAG_KO.match(rest))
    if script == "hi":
        return bool(_TAG_HI.match(rest))
    if script == "ar":
        return bool(_TAG_AR.match(rest))
    return script == "th" and bool(_TAG_TH.match(rest))


def _plain(word: str) -> str:
    return unicodedata.normalize("NFKC", word).translate(_FOLD) if not word.isascii() else word


def scan(text: str) -> tuple[list[int], list[int], list[tuple[int, str, str]], list[str]]:
    """Sentence starts and ends if every open place is an end; the open places.

    The third part has, for each open place, the number of the sentence that
    would end there, the token before the period and the word after it. The
    last part is the words that open a sentence after an unambiguous end.
    """
    starts: list[int] = []
    ends: list[int] = []
    open_: list[tuple[int, str, str]] = []
    openers: list[str] = []
    at = 0
    marks = _Places(text)
    blocks = []
    if "\n" in text or "\r" in text:
        for m in _BLANK_LINE.finditer(text):
            blocks.append((at, m.start()))
            at = m.end()
    blocks.append((at, len(text)))
    thai = not text.isascii() and _THAI.search(text) is not None
    greek = not text.isascii() and (";" in text or ";" in text) and _GREEK.search(text) is not None
    for lo, hi in blocks:
        while lo < hi and text[lo].isspace():
            lo += 1
        while hi > lo and text[hi - 1].isspace():
            hi -= 1
        if lo == hi:
            continue
        begin = lo
        if len(blocks) > 1 and _HEADING.fullmatch(text, lo, hi):
            starts.append(lo)
            ends.append(hi)
            continue
        places = [(m.start(), m.end()) for m in _CANDIDATE.finditer(text, lo, hi)]
        if thai:
            inside = [p[0] for p in places]
            for m in _THAI_GAP.finditer(text, lo, hi):
                k = bisect_left(inside, m.start())
                if not (k and places[k - 1][1] >= m.start()):
                    places.append((-1, m.start()))
            places.sort(key=lambda p: p[1])
        for s, e in places:
            j = e
            while j < hi and text[j].isspace():
                j += 1
            if j >= hi:
                continue
            if s < 0:  # the space of a script without end marks
                starts.append(begin)
                ends.append(e)
                begin = j
                continue
            mark = text[s]
            if mark in ";;":
                if not greek or not _GREEK.search(text, max(lo, s - 4), s):
                    continue
            gap = j > e
            k = j
            while k < hi and (text[k] in _OPEN or text[k] in _DASH or text[k].isspace() or ord(text[k]) in _DROP_INVISIBLE):
                k += 1
            nxt = text[k] if k < hi else ""
            quoted = e > s + 1
            if not nxt:
                continue
            if nxt.islower():
                continue
            script = _script(nxt)
            dot = mark in ".．"
            ellipsis = mark == "…" or text.startswith("..", s)
            if not gap and mark not in _HAN_END:
                # no space: only where the two sides cannot be one word
                p = s - 1
                while p > lo and ord(text[p]) in _DROP_INVISIBLE:
                    p -= 1
                prev = text[p] if p >= lo else ""
                if script in ("han", "ja"):
                    if dot and not ellipsis or not (prev and _script(prev) or mark in "!?"):
                        continue
                elif dot and not ellipsis:
                    if not (prev.islower() and p > lo and text[p - 1].isalpha() and nxt.isupper()):
                        continue
                    if "." in marks.token(lo, s):
                        continue
                elif script in ("hi", "ar", "ko", "th"):
                    pass
                elif not nxt.isupper():
                    continue
            if nxt in ",;:،、，；：.!?…。！？)]}）」』】”’»":
                continue
            if script:
                if quoted and _is_tag(text, k, script, text[s + 1 : e], s, marks):
                    continue
                if dot and not ellipsis and script == "hi":
                    p = s - 1
                    while p > lo and ord(text[p]) in _DROP_INVISIBLE:
                        p -= 1
                    if _script(text[p]) == "hi" or unicodedata.category(text[p])[0] == "M":
                        continue  # the script has an end mark of its own: this is an abbreviation's
            elif not (nxt.isupper() or nxt.isdigit() or nxt.isalpha() or nxt in "£$€§&#"):
                continue
            certain = True
            if dot and not ellipsis and not quoted:
                if not script:
                    token = _plain(marks.token(lo, s)).strip("_*'\"")
                    if token and token[-1].isalpha():
                        w = _WORD.match(text, k)
                        word = _plain(w.group()) if w else nxt
                        if len(word) == 1 and text.startswith(".", w.end() if w else k + 1):
                            word += "."  # an initial, which is no common word
                        certain = len(token) >= WORD_LETTERS and token.isalpha() and token[0].islower()
                        if not certain:
                            open_.append((len(ends), re.sub(r"\s+", " ", token), "#" if word[0].isdigit() else word))
            if certain and nxt.isupper():
                w = _WORD.match(text, k)
                if w and not (w.end() - k == 1 and text.startswith(".", w.end())):
                    openers.append(_plain(w.group()))
            starts.append(begin)
            ends.append(e)
            begin = j
        starts.append(begin)
        ends.append(hi)
    return starts, ends, open_, openers


_ROW = pa.schema([
    ("segment_id", pa.int64()), ("book_id", pa.string()), ("starts", pa.list_(pa.int32())), ("ends", pa.list_(pa.int32())), ("at", pa.list_(pa.int32())), ("tokens", pa.list_(pa.string())), ("nexts", pa.list_(pa.string())),
    ("word", pa.string()), ("mid", pa.int64()), ("opens", pa.int64()),
])
_ROW_DDL = "segment_id bigint, book_id string, starts array<int>, ends array<int>, at array<int>, tokens array<string>, nexts array<string>, word string, mid bigint, opens bigint"
#: Words counted in a task before their counts are handed on.
_FLUSH = 200_000


def _evidence_rows(mid: Counter, opens: Counter) -> pa.RecordBatch:
    keys = list(mid.keys() | opens.keys())
    n = len(keys)
    cols = {
        "segment_id": pa.nulls(n, pa.int64()), "book_id": pa.array([k[0] for k in keys], pa.string()), "word": pa.array([k[1] for k in keys], pa.string()),
        "mid": pa.array([mid[k] for k in keys], pa.int64()), "opens": pa.array([opens[k] for k in keys], pa.int64()),
    }
    return pa.RecordBatch.from_arrays([cols[f.name] if f.name in cols else pa.nulls(n, f.type) for f in _ROW], schema=_ROW)


def _scan_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    mid: Counter = Counter()
    opens: Counter = Counter()
    for b in slices(batches):
        ids, books, out = [], [], [[], [], [], [], []]
        for seg, book, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
            if not text or text.isspace():
                continue
            starts, ends, open_, first = scan(text)
            if not starts:
                continue
            ids.append(seg)
            books.append(book)
            out[0].append(starts)
            out[1].append(ends)
            out[2].append([x[0] for x in open_])
            out[3].append([x[1] for x in open_])
            out[4].append([x[2] for x in open_])
            for w in _MID_CAPITAL.findall(text):
                mid[book, _plain(w)] += 1
            for w in first:
                opens[book, w] += 1
        n = len(ids)
        if n:
            arrays = [pa.array(ids, pa.int64()), pa.array(books, pa.string()), *(pa.array(o, f.type) for o, f in zip(out, list(_ROW)[2:7])), pa.nulls(n, pa.string()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, schema=_ROW)
        if len(mid) + len(opens) > _FLUSH:
            yield _evidence_rows(mid, opens)
            mid.clear()
            opens.clear()
    if mid or opens:
        yield _evidence_rows(mid, opens)


def sentences(segments: DataFrame) -> DataFrame:
    """One row per sentence: segment_id, sent_no, start_pos, end_pos.

    Needs segment_id, book_id and text. Positions count code points from 0.
    """
    rows = segments.where(F.col("text").isNotNull()).select("segment_id", "book_id", "text")
    scanned = materialize(rows.mapInArrow(_scan_batches, _ROW_DDL), "p1-scan")

    # names and common words, by book and in the corpus
    words = scanned.where("word is not null").groupBy("book_id", "word").agg(F.sum("mid").alias("mid"), F.sum("opens").alias("opens"))
    common = lambda m, o: (F.col(o) > 0) & (F.col(m) <= 0.1 * F.col(o))
    in_book = words.select("book_id", F.col("word").alias("nxt"), "mid", "opens")
    in_corpus = words.groupBy(F.col("word").alias("nxt")).agg(F.sum("mid").alias("all_mid"), F.sum("opens").alias("all_opens"))

    # what follows each token, by book and in the corpus
    segs = scanned.where("segment_id is not null").groupBy("segment_id").agg(F.first(F.struct("book_id", "starts", "ends", "at", "tokens", "nexts")).alias("s")).select("segment_id", "s.*")
    places = segs.where(F.size("at") > 0).select("segment_id", "book_id", F.posexplode(F.arrays_zip("at", "tokens", "nexts")).alias("k", "p")).select("segment_id", "book_id", F.col("p.at").alias("at"), F.col("p.tokens").alias("token"), F.col("p.nexts").alias("nxt"))
    seen = places.groupBy("book_id", "token", "nxt").agg(F.count("*").alias("n"))
    judged = (
        seen.join(in_corpus, "nxt", "left").join(in_book, ["book_id", "nxt"], "left")
        .withColumn("common", F.when(F.coalesce(F.col("mid") + F.col("opens"), F.lit(0)) >= 3, common("mid", "opens")).otherwise(F.coalesce(common("all_mid", "all_opens"), F.lit(False))))
        .withColumn("told", F.col("common") | (F.coalesce("all_mid", F.lit(0)) > 0) | (F.col("nxt") == "#") | F.col("nxt").endswith("."))
    )
    by_book = judged.groupBy("book_id", "token").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("common"), F.col("n")).otherwise(0)).alias("c"), F.sum(F.when(F.col("told"), F.col("n")).otherwise(0)).alias("t"))
    by_corpus = by_book.groupBy("token").agg(F.sum("n").alias("all_n"), F.sum("c").alias("all_c"), F.sum("t").alias("all_t"))
    by_corpus = by_corpus.join(in_corpus.select(F.col("nxt").alias("token"), F.col("all_mid").alias("bare")), "token", "left")
    last = F.regexp_extract("token", r"([^ ]*)$", 1)
    shape_ends = ~(F.lower(last).isin(*sorted(map(_plain, KNOWN_ABBREVIATIONS))) | last.rlike(r"^\p{L}$") | last.rlike(r"^[\p{L}.]*\.\p{L}$") | F.lower(last).rlike(r"^(?:(?![aeiouyàâéèêôöüäаеёиоуыэюяα-ωά-ώ])\p{L}){2,4}$"))
    verdict = by_book.join(by_corpus, "token").select(
        "book_id", "token",
        F.when(F.lower("token").isin(*sorted(map(_plain, CLOSING_ABBREVIATIONS))), True)
        .when(F.coalesce("bare", F.lit(0)) >= F.col("all_n"), True)  # a name that also stands without a period
        .when((F.col("n") >= BOOK_LEAST) & (F.col("t") >= TOLD_SHARE * F.col("n")) & (F.col("all_n") < 5 * F.col("n")), F.col("c") >= BOOK_SHARE * F.col("n"))
        .when((F.col("all_n") >= CORPUS_LEAST) & (F.col("all_t") >= TOLD_SHARE * F.col("all_n")), F.col("all_c") >= CORPUS_SHARE * F.col("all_n"))
        .otherwise(shape_ends).alias("ends"),
    )
    glued = places.join(verdict.where(~F.col("ends")), [places.book_id.eqNullSafe(verdict.book_id), places.token == verdict.token], "left_semi").groupBy("segment_id").agg(F.collect_set("at").alias("glue"))

    # a glued place joins its sentence with the next one
    fixed = segs.select("segment_id", "starts", "ends").join(glued, "segment_id", "left")
    drop = F.coalesce(F.col("glue"), F.expr("cast(array() as array<int>)"))
    keep_end = F.filter(F.col("ends"), lambda x, i: ~F.array_contains(F.col("g"), i))
    keep_start = F.filter(F.col("starts"), lambda x, i: ~F.array_contains(F.col("g"), i - 1))
    return (
        fixed.withColumn("g", drop)
        .select("segment_id", F.posexplode(F.arrays_zip(keep_start.alias("s"), keep_end.alias("e"))).alias("sent_no", "p"))
        .select("segment_id", "sent_no", F.col("p.s").alias("start_pos"), F.col("p.e").alias("end_pos"))
    )


def plain_sentences(text: str) -> list[tuple[int, int]]:
    """The sentences of one text by its marks and token shapes alone, for callers that only count them."""
    starts, ends, open_, _ = scan(text)
    glue = {i for i, token, _ in open_ if token.lower() not in CLOSING_ABBREVIATIONS and ((t := token.rpartition(" ")[2].lower()) in KNOWN_ABBREVIATIONS or len(t) == 1)}
    return list(zip([s for i, s in enumerate(starts) if i - 1 not in glue], [e for i, e in enumerate(ends) if i not in glue]))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every sentence of every segment, with its place in the text."""
    return sentences(table(spark, sf_dir, "segments")).select("segment_id", "start_pos", "end_pos")
