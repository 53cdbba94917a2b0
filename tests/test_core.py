"""Small cases of the core operators."""

import random
import re

import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillspark.functions import patterns as P
from quillspark.functions import text as T
from quillspark.operators import assemble, attribution, resolver, roster, segment, structure, windows
from quillspark.plans import cli, registry
from quillspark.plans.config import Config, chapter_list
from quillspark.plans.pipeline import run
from quillspark.sources import books


def values(spark, rows, expr):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, x string")
    return [r.y for r in df.select("i", expr(F.col("x")).alias("y")).orderBy("i").collect()]


@pytest.mark.parametrize(
    "title, kind",
    [
        ("PREFACE", "front"), ("Introduction.", "front"), ("DEDICATION TO A FRIEND", "front"), ("Contents", "front"), ("Translator's Note", "front"), ("FOOTNOTES:", "back"), ("Appendix", "back"),
        ("INDEX", "back"), ("Original Transcriber's Notes:", "back"), ("Notes on the siege", "body"), ("CHAPTER I", "body"), ("The preface of a war", "body"), ("", "body"),
    ],
)
def test_heading_kind(spark, title, kind):
    assert values(spark, [title], T.heading_kind) == [kind]


def test_heading_shape(spark):
    yes = ["CHAPTER I", "Chapter 12", "CHAPTER IV. The Weir", "Chapter 3 The Weir", "PART II", "BOOK I: Of Mills", "I. A SCANDAL AT THE MILL", "CHAPTER 2. “So”"]
    no = ["I.", "Chapter I am late", "M. Fenn, and this day was lost", "chapter one", "I. The weir; II. the mill", "CHAPTER", "The chapter"]
    assert values(spark, yes, T.is_heading) == [True] * len(yes) and values(spark, no, T.is_heading) == [False] * len(no)
    assert values(spark, ["   I.     A Mill", "I. A Mill", "List of Illustrations", "  12  ", "The Mill      12", "The mill"], T.is_contents_line) == [True, False, True, True, True, False]


def test_text_functions(spark):
    assert values(spark, ["a b c", "", "  ", None, "x\x1cy"], T.word_count) == [3, 0, 0, None, 2]
    assert values(spark, ["a--b — c\n d", None], T.normalize_whitespace) == ["a b c d", None]
    assert values(spark, ["a\n\n\n\n\nb", "a\n\nb"], T.collapse_blank_lines) == ["a\n\n\nb", "a\n\nb"]
    assert values(spark, ["x[Illustration: a [b] c]y", "x [illustration y", "[Note]"], T.strip_illustrations) == ["xy", "x ", "[Note]"]
    assert values(spark, ["a\r\nb\rc\x0bd\n", ""], T.lines) == [["a", "b", "c", "d"], []]
    assert values(spark, ["Mrs. Bennet", "Jane's mother", "his wife", "Captain Ahab"], T.name_quality) == [2, -2, -2, 2]
    assert values(spark, ["N/A", "none", "No named characters found", "Nobody", "Anna"], T.is_placeholder) == [True, True, True, True, False]
    assert values(spark, ["“a” “b”", '"a"', "‘a’ ‘b’", "none", "“a"], T.quote_style) == ["curly", "straight", "single", None, None]
    assert values(spark, ["```json\n{}\n```", "{}"], T.strip_fences) == ["{}", "{}"]
    assert values(spark, ["a\n\n b\nc \n\n\n\nd", None], T.paragraphs) == [["a", "b c", "d"], None]


def counted_illustrations(text):
    out, i = [], 0
    while i < len(text):
        if text[i : i + 13].lower() == "[illustration":
            depth, i = 1, i + 1
            while i < len(text) and depth:
                depth += {"[": 1, "]": -1}.get(text[i], 0)
                i += 1
        else:
            out.append(text[i])
            i += 1
    return "".join(out)


def test_deep_illustrations(spark):
    random.seed(3)
    texts = ["x[Illustration: a [b [c [d [e] f] g] h] i]y", "x [illustration a [b", "[a] ]x[Illustration [b [c [d]]]]y]"]
    texts += ["".join(random.choice(["[Illustration", "[", "]", "]", "a", "é\n"]) for _ in range(random.randint(1, 30))) for _ in range(400)]
    assert values(spark, [*texts, None], T.strip_illustrations) == [*map(counted_illustrations, texts), None]


def test_document_keeps_chapters_without_segments(spark):
    chaps = spark.createDataFrame([("b", 1, "One", 3, None), ("b", 2, "Two", 0, None)], "book_id string, chapter_number int, title string, word_count int, start_marker string")
    segs = spark.createDataFrame([("b", 1, 0, "narration", "t", None, None, None)], "book_id string, chapter_number int, seg_idx int, seg_type string, text string, speaker string, pronunciation_hints array<string>, notes string")
    people = spark.createDataFrame([], "book_id string, ord int, name string, aliases array<string>, pronunciation_hints array<string>, first_appearance_chapter int")
    b = spark.createDataFrame([("b", "T", "A", "en", "1", "", "")], "book_id string, title string, author string, book_lang string, gutenberg_id string, release_date string, credits string")
    d = __import__("json").loads(assemble.documents(b, chaps, segs, people, assemble.statistics(segs, chaps, people, None, "book_id"), "book_id").first().document)
    assert [(c["chapter"]["number"], len(c["processed"]["segments"])) for c in d["chapters"]] == [(1, 1), (2, 0)] and d["statistics"]["total_chapters"] == 2


def test_sentences(spark):
    cases = {
        "Mr. Fenn made no answer. Mrs. Oak and Capt. Weir arrived.": 2, "J. Ross Oak sailed. He fell.": 2, "Well... said he. Yes!": 2, "“Stop!” he cried. “Go.” She went.": 3, "one": 1, "": 0,
    }
    assert [len(x) for x in values(spark, list(cases), T.sentences)] == list(cases.values())
    assert values(spark, ["He sat. Mr. Fenn said only,"], T.tag_sentences) == [["He sat.", "Mr. Fenn said only,"]]


def scanned(para, open_, close):
    """The quotation scanner, character by character."""
    out, inside, start = [], False, 0
    for i, c in enumerate(para):
        if not inside and c == open_:
            out.append(("narration", para[start:i]))
            inside, start = True, i
        elif inside and c == close and not (close == "’" and i and para[i - 1].isalpha() and i + 1 < len(para) and para[i + 1].isalpha()):
            out.append(("dialogue", para[start : i + 1]))
            inside, start = False, i + 1
    out.append(("dialogue" if inside else "narration", para[start:]))
    return [(k, t.strip()) for k, t in out if t.strip()]


def test_quote_tokens_match_a_scanner(spark):
    random.seed(2)
    for style, (o, c) in {"curly": "“”", "straight": '""', "single": "‘’"}.items():
        paras = ["".join(random.choice(["a", "b", " ", ".", o, c, "x’y"]) for _ in range(random.randint(1, 25))).strip() or "a" for _ in range(400)]
        paras = [p for p in paras if style == "single" or "’" not in p or True]
        df = spark.createDataFrame([(i, p) for i, p in enumerate(paras)], "i int, x string")
        got = df.select("i", segment.paragraph_spans(F.col("x"), F.lit(style)).alias("s")).orderBy("i").collect()
        for p, r in zip(paras, got):
            assert [(s.seg_type, s.text) for s in r.s] == scanned(p, o, c), (style, p)


def test_segments(spark):
    text = "CHAPTER I\n\n“Come,” said Lucy, “it\nis late.”\n\n“I go\n\nHe left."
    got = segment.segments(spark.createDataFrame([(1, text), (2, None), (3, ""), (4, "no quotes")], "k int, text string"), "k").orderBy("k", "seg_idx").collect()
    assert [(r.seg_type, r.text, r.para) for r in got if r.k == 1] == [("narration", "CHAPTER I", 0), ("dialogue", "“Come,”", 1), ("narration", "said Lucy,", 1), ("dialogue", "“it is late.”", 1), ("dialogue", "“I go", 2), ("narration", "He left.", 3)]
    assert [r.notes for r in got if r.k == 1] == [None] * 4 + ["quote-continues", None]
    assert [r.text for r in got if r.k == 4] == ["no quotes"] and not [r for r in got if r.k in (2, 3)]


def test_long_narration(spark):
    one = "A" * 49 + "."
    long = "B" * 700 + "."
    got = values(spark, [" ".join([one] * 12), long, "short"], segment.narration_chunks)
    assert all(len(c) <= 400 for c in got[0]) and " ".join(got[0]) == " ".join([one] * 12) and len(got[0]) == 2
    assert got[1] == [long] and got[2] == ["short"]


def book_lines(paragraph=60):
    p = "word " * paragraph
    out = ["Title: The Weir", "*** START OF THE PROJECT ARCHIVE EBOOK X ***", "", "DEDICATION", "", "To Ann.", "", "PREFACE", "", p, ""]
    for n in ("I", "II", "III"):
        out += [f"CHAPTER {n}.", "", p, ""]
    return out + ["FOOTNOTES:", "", p, "*** END OF THE PROJECT ARCHIVE EBOOK X ***"]


def as_lines(spark, books_):
    return spark.createDataFrame([(b, i, x) for b, ls in books_.items() for i, x in enumerate(ls)], "book_id string, line_idx int, line string")


def test_chapters(spark):
    ls = book_lines()
    lines = as_lines(spark, {"a": ls, "c": ["CHAPTER 1", "CHAPTER 2", "CHAPTER 3", "", *ls[11:]]})
    got = structure.chapters(lines, "book_id").orderBy("book_id", "number").collect()
    a = [r for r in got if r.book_id == "a"]
    assert [r.title for r in a] == ["CHAPTER I.", "CHAPTER II.", "CHAPTER III."] and [r.start_line for r in a] == [12, 16, 20] and [r.end_line for r in a] == [15, 19, 23]
    back = structure.chapters(lines, "book_id", True).where("kind = 'back'").collect()
    assert {r.title for r in back} == {"FOOTNOTES:"} and len(back) == 2
    txt = structure.chapter_texts(lines, structure.chapters(lines, "book_id"), "book_id").where("book_id = 'a' and number = 1").first()
    assert txt.word_count == 62 and txt.text.startswith("CHAPTER I.")
    assert structure.chapters(lines.limit(0), "book_id").count() == 0


def test_only_a_contents_list_stays(spark):
    lines = as_lines(spark, {"a": ["CHAPTER 1", "", "CHAPTER 2", "", "CHAPTER 3", ""]})
    assert structure.chapters(lines, "book_id").count() == 3


def test_unlabeled_first_chapter(spark):
    prose = "word " * 60
    lines = as_lines(spark, {"a": [prose, "", "CHAPTER II.", "", prose, "", "CHAPTER III.", "", prose], "b": ["Contents", "", prose, "", "CHAPTER II.", "", prose], "c": ["PREFACE", "", prose, "", "CHAPTER I.", "", prose], "d": ["few words", "", "CHAPTER I.", "", prose], "e": ["[Illustration:", prose, "]", "", "CHAPTER I.", prose]})
    got = {r.book_id: r.start_line for r in structure.unlabeled_first_chapter(lines, "book_id").collect()}
    assert got == {"a": 1, "b": 3}
    heads = structure.chapters(lines, "book_id").select("book_id", "number", "title", "start_line")
    first = structure.unlabeled_first_chapter(lines, "book_id")
    both = structure.with_first_chapter(heads, first, "book_id").where("book_id = 'a'").orderBy("number").collect()
    assert [(r.number, r.title) for r in both] == [(1, "Chapter I"), (2, "CHAPTER II."), (3, "CHAPTER III.")]


def test_validated_chapters(spark):
    rows = [("b", i, t, s) for i, (t, s) in enumerate([("Two", "300"), ("One", "5"), ("Zero", "0"), ("Far", "5000"), ("Again", "300"), ("Bad", "not-a-number"), ("PREFACE", "2"), ("INDEX", "900")])]
    df = spark.createDataFrame(rows, "book_id string, ord int, title string, start_line string")
    assert [r.title for r in structure.validated_chapters(df, "book_id", F.lit(1000)).orderBy("number").collect()] == ["One", "Two"]
    assert [r.kind for r in structure.validated_chapters(df, "book_id", F.lit(1000), True, True).orderBy("number").collect()] == ["front", "body", "body", "back"]


def test_validated_chapters_of_long_books(spark, tmp_path):
    ch = [("b", 1, "One", 5, 3999), ("b", 2, "Two", 4000, 8999), ("b", 3, "Three", 9000, 9500), ("b", 4, "Far", 9600, 9700), ("s", 1, "One", 5, 100), ("s", 2, "Far", 200, 300), ("n", 1, "One", 5, 3999), ("n", 2, "Two", 4000, 4100)]
    chapters = spark.createDataFrame(ch, "book_id string, chapter_number int, title string, start_line int, end_line int").selectExpr("*", "1 as word_count", "title as start_marker", "'body' as kind")
    chapters.write.parquet(f"{tmp_path}/chapters.parquet")
    # a re-ingested book counts as it was last delivered
    spark.createDataFrame([("b", 40, 9540, "2024-01-02"), ("b", 40, 3000, "2024-01-01"), ("s", 10, 160, "2024-01-01"), ("n", None, None, "2024-01-01")], "book_id string, body_start_line int, body_end_line int, t string").selectExpr("book_id", "body_start_line", "body_end_line", "timestamp(t) as ingested_at").write.parquet(f"{tmp_path}/books.parquet")
    got = {(r.book_id, r.number, r.title, r.start_line) for r in registry.queries()["validated_chapters"](spark, str(tmp_path)).collect()}
    assert got == {("b", 1, "One", 5), ("b", 2, "Two", 4000), ("b", 3, "Three", 9000), ("s", 1, "One", 5), ("n", 1, "One", 5), ("n", 2, "Two", 4000)}


def test_warnings_and_numbers(spark):
    c = spark.createDataFrame([("a", 1, 5), ("a", 2, 900), ("a", 3, 1000), ("a", 4, 9000), ("b", 1, 500)], "book_id string, chapter_number int, word_count int")
    assert [r.book_id for r in structure.degenerate_books(c, "book_id").collect()] == ["a"]
    assert sorted(r.chapter_number for r in structure.size_outliers(c, "book_id").collect()) == [1, 4]
    n = spark.createDataFrame([("a", i, x) for i, x in enumerate([1, 2, 1, 2, 4])], "book_id string, ord int, number int")
    assert [r.number for r in structure.unique_numbers(n, "book_id").orderBy("ord").collect()] == [1, 2, 3, 4, 5]


def test_tag_speaker(spark):
    amap = F.create_map(F.lit("lucy"), F.lit("Lucy"), F.lit("signora"), F.lit("Signora"), F.lit("miss bartlett"), F.lit("Miss Bartlett"), F.lit("charlotte"), F.lit("Charlotte"))
    cases = {
        "said Lucy, who had been saddened by the Signora’s accent.": "Lucy", "Miss Bartlett continued;": "Miss Bartlett", "They said nothing more.": None, "cried Lydia,": "Lydia",
        "said the elder of them, glancing from Lucy to Charlotte.": None, "she whispered to Lucy.": "Lucy",
    }
    assert values(spark, list(cases), lambda x: attribution.tag_speaker(x, amap)) == list(cases.values())


def test_anchors(spark):
    rows = [(1, i, k, t) for i, (k, t) in enumerate([("dialogue", "“A”"), ("narration", "said Lucy,"), ("dialogue", "“B”"), ("narration", "replied Ann."), ("dialogue", "“C”"), ("narration", "He replied that Lucy was gone."), ("dialogue", "“D”")])]
    segs = spark.createDataFrame(rows, "k int, seg_idx int, seg_type string, text string").withColumn("amap", F.create_map(F.lit("lucy"), F.lit("Lucy")))
    got = {r.seg_idx: r.anchor for r in attribution.anchors(segs, ["k"]).collect() if r.anchor}
    assert got == {0: "Lucy", 2: "Ann"}  # the tag after the speech wins, a closed tag says nothing of the next


def test_passes(spark):
    mk = lambda rows: spark.createDataFrame([(1, i, s, o) for i, s, o in rows], "k int, seg_idx int, speaker string, ord int")
    asked = mk([(i, None, 0) for i in range(6)])
    a, b, c = mk([(0, "x", 0), (1, "x", 0), (3, "x", 0), (5, "x", 0)]), mk([(0, "x", 0), (2, "y", 0), (3, "y", 0), (5, "Unknown", 0)]), mk([(3, "z", 0)])
    got = {r.seg_idx: r.speaker for r in attribution.reconcile(a, b, c, asked, ["k"]).collect()}
    assert got == {0: "x", 1: "x", 2: "y", 3: "z", 4: "Unknown", 5: "Unknown"}
    kept = attribution.kept_answers(mk([(0, "p", 0), (0, "q", 1), (9, "p", 0), (1, "", 0)]), asked, ["k"])
    assert [(r.seg_idx, r.speaker) for r in kept.collect()] == [(0, "q")]
    w = spark.createDataFrame([(1, 0.5, 3), (1, 1.0, 1), (2, 0.4, 0), (2, 0.6, 0), (3, None, 4)], "k int, quality double, dialogue int")
    assert {r.k: round(r.quality, 6) for r in attribution.quality(w, ["k"]).collect()} == {1: 0.625, 2: 0.5, 3: 1.0}


def entry(name, *aliases, chapter=1, hints=()):
    return {"name": name, "aliases": list(aliases), "pronunciation_hints": list(hints), "first_appearance_chapter": chapter}


def names(entries):
    return [e["name"] for e in entries]


def test_duplicates():
    got = roster.merge_duplicates([entry("Lucy", "Lucia"), entry("Lucy Honeychurch", "Lucy", chapter=6)])
    assert names(got) == ["Lucy Honeychurch"] and got[0]["first_appearance_chapter"] == 1 and "Lucia" in got[0]["aliases"]
    assert names(roster.merge_duplicates([entry("Sir Harry Otway"), entry("Sir Harry")])) == ["Sir Harry Otway"]
    assert names(roster.merge_duplicates([entry("Lucy"), entry("Mrs. Honeychurch")])) == ["Lucy", "Mrs. Honeychurch"]
    three = [entry("John"), entry("John Smith"), entry("John Brown")]
    assert names(roster.merge_duplicates(three)) == names(three)
    assert names(roster.merge_duplicates([entry("Jane's mother", "Mrs. Bennet", "his wife")])) == ["Mrs. Bennet"]
    assert names(three) == ["John", "John Smith", "John Brown"]  # the input stays


_NAMES = st.sampled_from(["Ann", "Ann Oak", "Mr. Oak", "Oak", "Captain Weir", "Weir", "ann", "his wife"])
_ENTRIES = st.lists(st.builds(lambda n, a, c: entry(n, *a, chapter=c), _NAMES, st.lists(_NAMES, max_size=3), st.integers(1, 9)), max_size=6)


@settings(max_examples=150, deadline=None)
@given(_ENTRIES)
def test_folds_settle(entries):
    once = roster.merge_duplicates(entries)
    assert len(once) <= len(entries)
    issues = [{"name": "Oak", "verdict": "duplicate", "canonical": "Ann Oak"}, {"name": "Weir", "verdict": "not_a_character"}]
    after = roster.apply_issues(once, issues, {"ann"})
    assert roster.apply_issues(after, issues, {"ann"}) == after
    assert roster.merge_rosters(once, [])  == roster.merge_rosters(roster.merge_rosters(once, []), [])


def test_merge_and_issues():
    r = [entry("Lucy", "Lucia"), entry("Ann", chapter=2)]
    got = roster.merge_rosters(r, [entry("LUCY", "lucia", "Lu", chapter=5), entry("Lucia", "Zed"), entry("Bob", chapter=5)])
    assert names(got) == ["Lucy", "Ann", "Bob"] and got[0]["aliases"] == ["Lucia", "Lu"] and got[0]["first_appearance_chapter"] == 1
    ship = [entry("Pequod"), entry("Peleg", chapter=1), entry("Captain Peleg", chapter=3)]
    issues = [{"name": "Pequod", "verdict": "not_a_character"}, {"name": "Peleg", "verdict": "duplicate", "canonical": "Captain Peleg"}, {"name": "Nobody", "verdict": "ok"}]
    got = roster.apply_issues(ship, issues, set())
    assert names(got) == ["Captain Peleg"] and got[0]["aliases"] == ["Peleg"] and got[0]["first_appearance_chapter"] == 1
    assert names(roster.apply_issues(ship, issues, {"pequod"})) == ["Pequod", "Captain Peleg"]


def test_roster_tables(spark):
    r = spark.createDataFrame([("b", 0, "Lucy", ["Lucia"], [], 2), ("b", 1, "Lucy Oak", ["Lucy"], ["loo"], 1), ("b", 2, "N/A", [], [], 1), ("b", 3, None, None, None, None)], "book_id string, ord int, name string, aliases array<string>, pronunciation_hints array<string>, first_appearance_chapter int")
    got = roster.merged_rosters(r, "book_id").collect()
    assert [(x.name, x.first_appearance_chapter) for x in got] == [("Lucy Oak", 1)]
    assert [(x.ord, x.target) for x in roster.duplicate_candidates(r.where("ord < 2"), "book_id").collect()] == [(0, 1)]
    said = spark.createDataFrame([("b", 1, "Zed"), ("b", 2, "Lucy")], "book_id string, chapter_number int, anchor string")
    roll = roster.rolling_rosters(r.where("ord < 2").withColumn("chapter_number", F.col("first_appearance_chapter")), said, "book_id").orderBy("chapter_number", "ord").collect()
    assert [(x.chapter_number, x.name) for x in roll] == [(1, "Lucy Oak"), (1, "Zed"), (2, "Lucy Oak"), (2, "Zed")] or [(x.chapter_number, x.name) for x in roll][:2] == [(1, "Lucy Oak"), (1, "Zed")]
    near = roster.nearest_names(spark.createDataFrame([("b", "Lucy Oka"), ("b", "Unknown"), ("b", "Zzzz"), ("b", "Lucy")], "book_id string, speaker string"), r, "book_id").collect()
    assert [(x.speaker, x.nearest, x.distance) for x in near] == [("Lucy Oka", "Lucy Oak", 2)]


def test_nearest_names_against_brute_force(spark):
    random.seed(8)
    word = lambda: "".join(random.choice("abcd") for _ in range(random.randint(1, 7)))
    known, lost = sorted({word() for _ in range(60)}), sorted({word() for _ in range(60)})
    r = spark.createDataFrame([("b", i, n) for i, n in enumerate(known)], "book_id string, ord int, name string")
    got = {x.speaker: (x.nearest, x.distance) for x in roster.nearest_names(spark.createDataFrame([("b", s) for s in lost], "book_id string, speaker string"), r, "book_id").collect()}
    want = {}
    for s in set(lost) - set(known):
        d, i = min((roster.edit_distance(s, n), i) for i, n in enumerate(known))
        if d <= 2:
            want[s] = (known[i], d)
    assert got == want


def test_windows(spark):
    segs = spark.createDataFrame([(1, i, "w " * n) for i, n in enumerate([300, 300, 500, 100, 1200, 50])], "k int, seg_idx int, text string")
    ids = windows.segment_windows(segs, ["k"], 1000)
    assert [r.window_id for r in ids.orderBy("seg_idx").collect()] == [0, 0, 1, 1, 2, 3]
    ctx = windows.with_context(ids, ["k"], 2).where("is_context").orderBy("window_id", "seg_idx").collect()
    assert [(r.window_id, r.seg_idx) for r in ctx] == [(1, 0), (1, 1), (2, 2), (2, 3), (3, 3), (3, 4)]
    text = "\n\n".join(["w " * 99 + "w"] * 50)
    d = spark.createDataFrame([(1, text), (2, "w " * 3000), (3, None)], "k int, text string")
    got = windows.discovery_windows(d, "k", budget=1000).orderBy("k", "window_id").collect()
    assert len([r for r in got if r.k == 1]) == 5 and "\n\n".join(r.text for r in got if r.k == 1) == text and len([r for r in got if r.k == 2]) == 1


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 30), max_size=12), st.integers(1, 40), st.integers(0, 50))
def test_overlapping_chunks_end(sizes, size, overlap):
    paras = [f"p{i} " + "w " * (n - 1) for i, n in enumerate(sizes)]
    got = windows.overlapping_chunks(paras, size, overlap)
    assert [p for p in paras if not any(p in c for c in got)] == []


def test_repair_and_differences():
    assert [t for t, _ in segment.repaired("One two, three four five.", ["one two three", "five"])] == ["One two, three", "four", "five."]
    assert segment.coverage_differences("a b c", "a x c") == ["altered: b -> x"]
    assert segment.coverage_differences("a b", "a b") == []


def test_resolver_pieces():
    assert resolver.base_url("http://h:8/") == "http://h:8/v1" and resolver.base_url("http://h/x/") == "http://h/x"
    assert resolver.picked_model(["a-1", "b"], "a") == "a-1" and resolver.picked_model(["a"], None) == "a"
    assert resolver.parsed_answer('```json\n{"a": 1}\n```') == {"a": 1}
    for bad in ("{", "[1]"):
        with pytest.raises(resolver.ResolverError):
            resolver.parsed_answer(bad)
    assert resolver.attribution_schema(["A", "A"])["properties"]["attributions"]["items"]["properties"]["speaker"]["enum"] == ["A", "Unknown"]


class Failing:
    def resolve(self, system, user, schema):
        raise resolver.ResolverError("down")


def test_answers(spark):
    segs = segment.with_neighbours(spark.createDataFrame([("b", 1, i, i, "dialogue", f"“{i}”", None, None) for i in range(4)], "book_id string, chapter_number int, seg_idx int, para int, seg_type string, text string, speaker string, notes string"), ["book_id", "chapter_number"])
    people = spark.createDataFrame([("b", 0, "Ann"), ("b", 1, "Bob")], "book_id string, ord int, name string")
    reqs = resolver.requests(segs, segs.where("seg_idx > 1"), people, ["book_id", "chapter_number"], "attribute", budget=2)
    assert reqs.count() == 1 and "0. [CONTEXT] [DIALOGUE] | “0”" in reqs.first().user
    got = resolver.answered(reqs, resolver.RuleResolver, ["book_id", "chapter_number"])
    assert sorted((r.seg_idx, r.speaker) for r in got.collect()) == [(2, "Ann"), (3, "Bob")]
    assert resolver.answered(reqs, Failing, ["book_id", "chapter_number"]).count() == 0
    parsed = spark.createDataFrame([('```\n{"attributions":[{"index":1,"speaker":"A"}]}\n```',), ("x",)], "c string").select(resolver.parsed(F.col("c"), resolver.ATTRIBUTIONS).alias("p")).collect()
    assert parsed[0].p.attributions[0].speaker == "A" and (parsed[1].p is None or parsed[1].p.attributions is None)


def test_remap(spark):
    people = spark.createDataFrame([("b", 0, "Ann", ["An", None])], "book_id string, ord int, name string, aliases array<string>")
    segs = spark.createDataFrame([("b", s) for s in ["AN", "ann", "Zed", "Unknown", "Narrator", None]], "book_id string, speaker string")
    got = [r.speaker for r in assemble.remapped_speakers(segs, attribution.alias_map(people, "book_id"), "book_id").collect()]
    assert sorted(got, key=str) == sorted(["Ann", "Ann", "Unknown", "Unknown", "Narrator", None], key=str)
    assert assemble.output_name("7", [3, 1]) == "7-ch1-3.json" and assemble.output_name("7", list(range(1, 9))) == "7-ch1_8.json" and assemble.output_name("7") == "7.json"


def test_config_and_cli():
    assert chapter_list("1,3-5") == [1, 3, 4, 5] and chapter_list(None) is None
    with pytest.raises(ValueError):
        chapter_list("x")
    c, source = cli.parsed_arguments(["in", "--chapters", "2", "--overlap", "9", "--model", "m"])
    assert source == "in" and c.chapters_only == [2] and c.chunk_overlap == 9 and c.validation_model == "m" and c.no_critic
    f = Config(force_stage=3)
    assert not f.must_run(2, True) and f.must_run(3, True) and f.must_run(7, True) and Config().must_run(1, False)


class Scripted:
    """A resolver that finds Bob and a ship, and a critic that gives the last speech to Bob."""

    def resolve(self, system, user, schema):
        import json

        if system.startswith("List the characters"):
            return json.dumps({"characters": [{"name": "Bob", "aliases": ["Bobby"]}, {"name": "Pequod"}, {"name": "N/A"}]})
        if system.startswith("Check"):
            index = [int(x) for x in re.findall(r"^(\d+)\tdialogue\t[^\n]*Now", user, re.M)]
            return json.dumps({"corrections": [{"index": i, "speaker": "Bob"} for i in index] + [{"index": 999, "speaker": "Bob"}], "roster_issues": [{"name": "Pequod", "verdict": "not_a_character"}, {"name": "Lucy", "verdict": "not_a_character"}], "overall_quality": 0.5})
        if system.startswith("These are numbered"):
            return "no JSON"
        return resolver.RuleResolver().resolve(system, user, schema)


def test_model_chapters_and_codecs(spark):
    from quillspark.plans.pipeline import discover
    from quillspark.sources import schemas

    class Proposing:
        def resolve(self, system, user, schema):
            return '{"chapters": [{"title": "Two", "start_line": 3}, {"title": "One", "start_line": 1}, {"title": "x", "start_line": "?"}]}' if "a b" in user else "{}"

    texts = spark.createDataFrame([("p", "a b\n\nc d\ne f"), ("q", "z")], "book_id string, text string")
    _, _, heads = discover(texts, Config(), Proposing)
    got = [(r.book_id, r.number, r.title, r.start_line, r.end_line) for r in heads.orderBy("book_id", "number").collect()]
    assert got == [("p", 1, "One", 1, 2), ("p", 2, "Two", 3, 4), ("q", 1, "Chapter 1", 1, 1)]
    for ddl in schemas.DEFAULTS:
        row = spark.createDataFrame([('{"number": 3, "name": "A", "text": "t"}',), ("{",)], "j string").select(schemas.from_json(F.col("j"), ddl).alias("r"), schemas.to_json(schemas.from_json(F.col("j"), ddl)).alias("back")).collect()
        assert row[0].r is not None and spark.createDataFrame([(row[0].back,)], "j string").select(schemas.from_json(F.col("j"), ddl).alias("r")).first().r == row[0].r


def test_sources_and_pipeline(spark, tmp_path):
    prose = "The weir was low that day and nobody came by it at all. " * 8
    text = "\n".join(["Title: The Weir", "Author: A. Oak", "", "*** START OF THE PROJECT ARCHIVE EBOOK X ***", "", "CHAPTER I", "", "“Come,” said Lucy, “it is late.”", "", prose, "", "CHAPTER II", "", "“Go,” cried Ann. “Now.”", "", prose, "*** END OF THE PROJECT ARCHIVE EBOOK X ***"])
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "41.txt").write_bytes(text.replace("\n", "\r\n").encode())
    (tmp_path / "in" / "42.txt").write_bytes("caf\xe9".encode("latin-1"))
    read = books.read_books(spark, str(tmp_path / "in"))
    assert {r.book_id: r.text for r in read.collect()} == {"41": text, "42": "café"}
    config = Config(cache_dir=str(tmp_path / "cache"))
    out = run(read, config)
    books.write_documents(out, str(tmp_path / "out"))
    docs = {d["metadata"]["title"]: d for d in map(__import__("json").loads, (r.value for r in spark.read.text(str(tmp_path / "out")).collect()))}
    d = docs["The Weir"]
    assert d["statistics"]["total_chapters"] == 2 and [c["name"] for c in d["characters"]] == ["Lucy", "Ann"]
    said = [(s["text"], s["speaker"]) for c in d["chapters"] for s in c["processed"]["segments"] if s["type"] == "dialogue"]
    assert said == [("“Come,”", "Lucy"), ("“it is late.”", "Lucy"), ("“Go,”", "Ann"), ("“Now.”", "Unknown")]
    (stage,) = (tmp_path / "cache" / "02-discovery" / "chapters").iterdir()
    assert books.stage_complete(spark, str(stage)) and not books.stage_complete(spark, str(tmp_path / "none"))
    judged = run(read, Config(cache_dir=str(tmp_path / "critic")), Scripted).collect()
    d = {x["metadata"]["title"]: x for x in (__import__("json").loads(r.document) for r in judged)}["The Weir"]
    assert [c["name"] for c in d["characters"]] == ["Bob", "Lucy", "Ann"]  # the ship is struck, a tagged name stays
    assert d["statistics"]["discovery_confidence"] == {"avg_confidence": 0.5, "min_confidence": 0.5}
    said = [(s["text"], s["speaker"]) for c in d["chapters"] for s in c["processed"]["segments"] if s["type"] == "dialogue"]
    assert said == [("“Come,”", "Lucy"), ("“it is late.”", "Lucy"), ("“Go,”", "Ann"), ("“Now.”", "Bob")]
    # a run over some chapters, with another book, on the same cache: its stages are its own
    more = read.where("book_id = '41'").withColumn("text", F.replace("text", F.lit("Lucy"), F.lit("Maud")))
    only = __import__("json").loads(run(more, Config(cache_dir=config.cache_dir, chapters_only=[1])).first().document)
    assert [c["name"] for c in only["characters"]] == ["Maud"] and len(only["chapters"]) == 1
    assert {p.name for p in (tmp_path / "cache" / "05-segments").iterdir()} == {"rosters", "segments", "rosters-chapters-1", "segments-chapters-1"}


class Named:
    """Answers every flagged line, and as a critic says so, under one name; notes what it was asked."""

    def __init__(self, name, log):
        self.name, self.log = name, log

    def resolve(self, system, user, schema):
        kind = next(k for k, v in resolver.SYSTEM.items() if system.startswith(v.split("\n")[0]))
        with open(self.log, "a") as f:
            f.write(f"{self.name} {kind}\n")
        if kind == "discover":
            return '{"characters": [{"name": "Lucy"}, {"name": "Ann"}]}'
        return __import__("json").dumps({"attributions": [{"index": int(i), "speaker": self.name} for i in re.findall(r"^(\d+)\t[^\t\n]*\t[^\t\n]*ASKED", user, re.M)], "overall_quality": 0.25 if self.name == "Ann" else 0.75})


def test_validator_checks(spark, tmp_path, monkeypatch):
    from quillspark.plans import pipeline

    log = str(tmp_path / "log")
    prose = "The weir was low that day and nobody came by it at all. " * 8
    text = "\n".join(["CHAPTER I", "", "“Come.” “Go.”", "", prose])
    texts = spark.createDataFrame([("41", text)], "book_id string, text string")
    config = Config(cache_dir=str(tmp_path / "cache"), processing_model="A", validation_model="B")
    d = __import__("json").loads(run(texts, config, lambda: Named("Lucy", log), lambda: Named("Ann", log)).first().document)
    said = [s["speaker"] for c in d["chapters"] for s in c["processed"]["segments"] if s["type"] == "dialogue"]
    asked = {tuple(x.split()) for x in open(log)}
    assert said == ["Ann", "Ann"] and d["statistics"]["discovery_confidence"]["avg_confidence"] == 0.25
    assert {k for n, k in asked if n == "Ann"} == {"verify", "settle", "critic"} and {k for n, k in asked if n == "Lucy"} == {"chapters", "discover", "attribute"}
    monkeypatch.setattr(resolver, "HttpResolver", lambda url, model, key: model)
    assert [f() for f in pipeline.factories(config)] == ["A", "B"] and [f() for f in pipeline.factories(Config(processing_model="A"))] == ["A", "A"] and pipeline.factories(Config()) == (None, None)


def test_stream(spark, tmp_path):
    from quillspark.streaming.roster import chapter_entries, rolling_roster_stream

    found = spark.createDataFrame([("b", 1, 0, "Lucy", ["Lucia"]), ("b", 3, 0, "Bob", None), ("b", 2, 0, "Lucy Oak", ["Lucy"]), ("c", 1, 0, "Zed", None)], "book_id string, chapter_number int, ord int, name string, aliases array<string>").withColumn("pronunciation_hints", F.lit(None).cast("array<string>"))
    rows = chapter_entries(found)
    src = str(tmp_path / "src")
    for k, chapter in enumerate((3, 1, 2)):
        rows.where(F.col("chapter_number") == chapter).coalesce(1).write.mode("append").parquet(src)
    stream = rolling_roster_stream(spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(src))
    q = stream.writeStream.format("memory").queryName("rolling").outputMode("append").option("checkpointLocation", str(tmp_path / "cp")).start()
    q.processAllAvailable()
    q.stop()
    got = {(r.book_id, r.chapter_number): r.names for r in spark.table("rolling").collect()}
    assert got == {("b", 1): ["Lucy"], ("b", 2): ["Lucy Oak"], ("b", 3): ["Lucy Oak", "Bob"], ("c", 1): ["Zed"]}


def test_rosters_look_forward_only(spark):
    from quillspark.plans.pipeline import rosters_by_chapter

    rolling = spark.createDataFrame([("b", 2, 0, "Lucy"), ("b", 5, 0, "Lucy"), ("b", 5, 1, "Ann"), ("c", 9, 0, "Zed")], "book_id string, chapter_number int, ord int, name string")
    chapters = spark.createDataFrame([("b", k) for k in (1, 2, 3, 5, 6)] + [("c", 8)], "book_id string, chapter_number int")
    got = sorted((r.book_id, r.chapter_number, r.name) for r in rosters_by_chapter(rolling, chapters).collect())
    assert got == [("b", 2, "Lucy"), ("b", 3, "Lucy"), ("b", 5, "Ann"), ("b", 5, "Lucy"), ("b", 6, "Ann"), ("b", 6, "Lucy")]


def test_shared_folder_is_demanded_on_a_cluster():
    from quillspark import storage

    class Cluster:
        applicationId, master = "app-x", "spark://host:7077"
        getConf = lambda self: {}

    fake = type("S", (), {"sparkContext": Cluster(), "conf": type("C", (), {"get": lambda self, k, d: d})()})()
    with pytest.raises(ValueError):
        storage.shared_root(fake)


def test_registry_and_patterns():
    q = registry.queries()
    assert set(registry.oracle_sql()) <= set(q) and len(q) > 50
    assert re.search(P.BODY_START, "*** START OF THIS PROJECT ARCHIVE EBOOK 1 ***")
    assert pd is not None
