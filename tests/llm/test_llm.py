"""Small cases of the training-data operators: nulls, blanks, ties, repeats, empty tables and clashing columns."""

import random
import unicodedata

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillspark.llm import canonical, encoding, leaks, names, packing, pieces, sentences, subjects
from quillspark.llm.registry import oracle_sql, queries

SEG = "segment_id long, book_id string, text string"


def sent(spark, rows):
    df = spark.createDataFrame([(i, b, t) for i, b, t in rows], SEG)
    text = {i: t for i, _, t in rows}
    out = {}
    for r in sentences.sentences(df).orderBy("segment_id", "start_pos").collect():
        out.setdefault(r.segment_id, []).append(text[r.segment_id][r.start_pos : r.end_pos])
    return out


def test_sentences(spark):
    rows = [
        (1, "a", "Mr. Fenn came by the weir. Then he sat. Dr. Oak saw Fenn and Oak."),
        (2, "a", None), (3, "a", ""), (4, "a", " \n "), (5, None, "No end mark"),
        (6, "b", "“Is it you?” asked Ann. “Go!” It fell."),
        (7, "b", "在桥下，他说：“快走吧。天黑了。”寡妇来了。“在哪里？”寡妇问，在桥下。"),
        (8, "b", "少女は「早く行け。」と言った。次。"),
        (9, "b", "คนสีข้าวมา เด็กหญิงไป"),
        (10, "b", "CHAPTER 3. The weir\n\nIt rained.\nAll day. He left at 3 p.m. and slept."),
        (11, "c", "Κάτω; Πάνω. «Πού;» ρώτησε. Ναι."),
        (12, "c", "डॉ. वेणु गया। वह बोला, “जाओ। रात हुई।” मल्लाह।"),
    ]
    got = sent(spark, rows + rows[:1])  # redelivered rows count once
    assert got[1] == ["Mr. Fenn came by the weir.", "Then he sat.", "Dr. Oak saw Fenn and Oak."]
    assert not {2, 3, 4} & got.keys() and got[5] == ["No end mark"]
    assert got[6] == ["“Is it you?” asked Ann.", "“Go!”", "It fell."]
    assert got[7] == ["在桥下，他说：“快走吧。", "天黑了。”", "寡妇来了。", "“在哪里？”寡妇问，在桥下。"]
    assert got[8] == ["少女は「早く行け。」と言った。", "次。"]
    assert got[9] == ["คนสีข้าวมา", "เด็กหญิงไป"]
    assert got[10] == ["CHAPTER 3. The weir", "It rained.", "All day.", "He left at 3 p.m. and slept."]
    assert got[11] == ["Κάτω;", "Πάνω.", "«Πού;» ρώτησε.", "Ναι."]
    assert got[12] == ["डॉ. वेणु गया।", "वह बोला, “जाओ।", "रात हुई।”", "मल्लाह।"]


def test_sentences_document_evidence(spark):
    """A token that the document always sets before names is a title, whatever its shape."""
    names_ = ["Fenn", "Oakley", "Marsh", "Thorn", "Wick"]
    rows = [(i, "x", f"The mayor met Vidame. {n} at the mill. What! Then {n} left and {n} slept.") for i, n in enumerate(names_ * 3)]
    rows += [(100 + i, "x", f"He spoke to {n} again.") for i, n in enumerate(names_)]
    got = sent(spark, rows)
    assert got[0][0] == "The mayor met Vidame. Fenn at the mill."


def test_sentences_empty_and_spans(spark):
    assert sentences.sentences(spark.createDataFrame([], SEG)).count() == 0
    random.seed(5)
    for _ in range(300):
        t = "".join(random.choice("ab A.!?…。”“ \n​ก ") for _ in range(random.randint(0, 60)))
        starts, ends, _, _ = sentences.scan(t)
        covered = "".join(t[s:e] for s, e in zip(starts, ends))
        assert "".join(covered.split()) == "".join(t.split())
        assert all(s < e for s, e in zip(starts, ends)) and starts == sorted(starts)


def test_canonical_matches_normalisation():
    random.seed(3)
    alphabet = "aeoụ̧́̂̈z한각がぱ각क़ि्"
    for _ in range(3000):
        s = "".join(random.choice(alphabet) for _ in range(random.randint(0, 9)))
        assert canonical.canonical_texts([s])[0] == unicodedata.normalize("NFC", s)


def test_canonical_forms():
    same = [("ﬁx", "fix"), ("ｶﾞﾊﾟ", "ガパ"), ("M​r. а", "Mr. a"), ("a\r\nb", "a\nb"), ("café", "café"), ("Ｗａｉｔ", "Wait"), ("﻿x­", "x")]
    for a, b in same:
        assert canonical.canonical_texts([a]) == canonical.canonical_texts([b]), a
    different = [("x²", "x2"), ("a", "A"), ("cafe", "café"), ("a  b", "a b"), ("a\nb", "a b"), ("“a”", '"a"'), ("0", "O")]
    for a, b in different:
        assert canonical.canonical_texts([a]) != canonical.canonical_texts([b]), a
    assert canonical.canonical_texts([None, "", "  "]) == [None, "", "  "]
    long = "é́" * 50_000
    assert canonical.canonical_texts([long])[0] == unicodedata.normalize("NFC", long)


def test_same_reading_pairs(spark, monkeypatch):
    rows = [(1, "a", "café"), (2, "a", "café"), (3, "a", "café"), (4, "b", "café"), (5, "a", None), (6, "a", " "), (7, "a", " "), (1, "a", "café"), (8, None, "café"), (9, "a", "cafe")]
    got = canonical.same_reading_pairs(spark.createDataFrame(rows, SEG))
    assert sorted(map(tuple, got.collect())) == [(1, 2), (2, 3)]
    assert canonical.same_reading_pairs(spark.createDataFrame([], SEG)).count() == 0
    copies = [(i, "a", "ﬁx" if i % 3 else "fix") for i in range(30)]
    want = {(i, j) for i in range(30) for j in range(i + 1, 30) if (i % 3 == 0) != (j % 3 == 0)}
    df = spark.createDataFrame(copies, SEG)
    monkeypatch.setattr(canonical, "GROUP_PART", 7)  # a class in parts
    assert {tuple(r) for r in canonical.same_reading_pairs(df).collect()} == want
    assert {(r["class"], r.members, r.forms, r.links) for r in canonical.same_reading_classes(df).collect()} == {(0, 30, 2, 10), (0, 30, 2, 20)}
    df = spark.createDataFrame([(1, "x", "old")], "id long, text string, form string")
    assert canonical.canonical_form(df).columns == ["id", "text", "form"]


def test_pieces_cover_and_overlap():
    random.seed(9)
    for _ in range(400):
        unit = random.choice(["word", "char"])
        n = random.randint(1, 120)
        text = "".join(random.choice(["word ", "end. ", "Next, ", "x\n\n", "no-space", "。"]) for _ in range(n))
        limit, overlap = random.randint(1, 40), random.randint(-2, 50)
        got = pieces.cut(text, limit, overlap, unit)
        size = (lambda s: len(s.split())) if unit == "word" else len
        assert got[0][0] == 0 and got[-1][1] == len(text)
        if size(text) > limit:
            assert len(got) > 1
            want = max(0, min(overlap, limit - 1))
            for (s, e, k), (s2, _, _) in zip(got, got[1:]):
                assert s < s2 <= e and size(text[s:e]) == k <= limit
                assert size(text[s2:e]) == want
        else:
            assert len(got) == 1


def test_pieces_natural_ends():
    text = "One two three. Four five six, seven eight. Nine ten"
    assert [text[s:e].strip() for s, e, _ in pieces.cut(text, 5, 0, "word")] == ["One two three.", "Four five six, seven eight.", "Nine ten"]
    assert pieces.cut_units(10, 4, 0, []) == [(0, 4), (4, 8), (8, 10)]


CONF = "config_id int, chunk_size int, chunk_overlap int, size_unit string"


def test_pieces_defaults(spark):
    segs = spark.createDataFrame([(1, "a b c d", 1), (2, "a " * 1001, 2), (3, None, 1), (4, "", 1), (5, "a " * 1001, None), (1, "a b c d", 1)], "segment_id long, text string, config_id int")
    conf = spark.createDataFrame([(1, 2, 2, "word"), (1, 2, 2, "word"), (2, None, None, None)], CONF)
    got = pieces.pieces(segs, conf).dropDuplicates(["segment_id", "piece_no"])
    count = {r.segment_id: r["count"] for r in got.groupBy("segment_id").count().collect()}
    assert count == {1: 3, 2: 2, 5: 2}
    assert pieces.pieces(segs.limit(0), conf).count() == 0


def test_packing():
    random.seed(1)
    for _ in range(300):
        cap = random.randint(1, 60)
        sizes = [random.randint(1, cap) for _ in range(random.randint(1, 90))]
        n, to = packing.pack(sizes, cap)
        used = {}
        for s, c in zip(sizes, to):
            used[c] = used.get(c, 0) + s
        assert max(used.values()) <= cap and sorted(used) == list(range(n))
        assert -(-sum(sizes) // cap) <= n <= packing._along(sizes, cap, list(range(len(sizes))))[0]


def test_containers_hold_neighbours():
    """Every container is filled from the next NEIGHBOURS items of the curve that are left."""
    random.seed(0)
    sizes = [random.randint(20, 60) for _ in range(3000)]
    count, to = packing._along(sizes, 100, list(range(3000)))
    left = list(range(3000))
    for c in range(count):
        assert [i for i in left[: packing.NEIGHBOURS] if to[i] == c] == [i for i in left if to[i] == c]
        left = [i for i in left if to[i] != c]
    assert not left and packing.pack(sizes, 100)[0] <= 1.01 * (-(-sum(sizes) // 100))


def test_hilbert_neighbours():
    side = 8
    grid = np.array([(x, y, z) for x in range(side) for y in range(side) for z in range(side)])
    keys = packing.hilbert_keys(grid, 3)
    assert sorted(keys) == list(range(side**3))
    path = grid[np.argsort(keys)]
    assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


@pytest.mark.parametrize("block", [4096, 8])  # the second makes the chapters hot
def test_containers(spark, monkeypatch, block):
    rows = [(i, "b", i % 2, f"w{i % 7} " * (1 + i % 5), 1) for i in range(60)] + [(100, "b", 0, "x " * 23, 1), (101, "b", 0, None, 1), (102, "b", 0, "", 1), (3, "b", 1, "w3 " * 4, 1), (104, None, None, "a b", 1)]
    rows += [(200 + i, None, 7, "same words", 1) for i in range(30)]  # one key with many copies, in a chapter without a book
    segs = spark.createDataFrame(rows, "segment_id long, book_id string, chapter_number int, text string, config_id int")
    conf = spark.createDataFrame([(1, 10, 3, "word")], CONF)
    monkeypatch.setattr(packing, "BLOCK", block)
    got = packing.containers(segs, conf).toPandas()
    assert got["size"].sum() == sum(1 + i % 5 for i in range(60)) + 23 + 2 + 60
    assert not got.duplicated(["segment_id", "piece_no"]).any()
    assert (got.groupby(["book_id", "chapter_number", "container_no"], dropna=False)["size"].sum() <= 10).all()
    assert (got[got.segment_id < 100].piece_no == 0).all() and (got.segment_id == 100).sum() == 3
    assert packing.containers(segs.limit(0), conf).count() == 0


def test_name_parts():
    assert names.jaro_winkler("martha", "marhta") == pytest.approx(0.961, abs=1e-3)
    assert names.parse("Dunerson, Benjamin D.")["given"] == "benjamin"
    assert names.parse("Cap'n Rudleigh")["title"] == "captain"
    assert names.parse("Upper Dale Soc.")["words"] == "upper dale society"
    assert names.parse("U.D.A.S.")["kind"] == "acro"
    assert names.contracts("benj", "benjamin") and names.contracts("hy", "henry") and not names.contracts("by", "henry")


def test_jaro_winkler_decides():
    """One slip anywhere passes at every length; several slips pass behind a common beginning."""
    random.seed(8)
    for _ in range(2000):
        a = "".join(random.sample("abcdelmnorst", random.randint(4, 12)))
        i = random.randrange(len(a) - 1)
        for b in (a[:i] + "z" + a[i:], a[:i] + a[i + 1 :], a[:i] + "z" + a[i + 1 :], a[:i] + a[i + 1] + a[i] + a[i + 2 :]):
            assert min(len(a), len(b)) < 4 or names.alike(a, b), (a, b)
    assert names.alike("norworth", "nrworth") and names.alike("sallerson", "sarlerson") and names.alike("hathermere", "hatherme")
    assert not names.alike("hartwell", "hartwood") and not names.alike("ann", "anne") and not names.alike("", "abcd")


def test_long_organisation_names_meet():
    """Two spellings with a very long code share a key when one consonant is left out."""
    words = ["brtkmldrg", "drtkmlbrg", "ktrmldbrg", "lmtrkdbrg", "mtrkldbrg", "company"]
    keys = lambda ws: {k for k in names._keys(names.parse("the " + " ".join(ws))) if k.startswith("o:")}
    assert len(names.phonetic("".join(words))) > names.LONG_CODE
    for w in range(5):
        for i in range(2, 9):
            assert keys(words) & keys([*words[:w], words[w][:i] + words[w][i + 1 :], *words[w + 1 :]]), (w, i)


@pytest.mark.parametrize("hot", [2000, 3])
def test_hot_blocks_meet_whole(spark, hot):
    rows = [("b", f"n{i:02}", k) for i in range(20) for k in ("k", f"k{i % 4}")] + [("c", "n00", "k")]
    got = names.met_pairs(spark.createDataFrame(rows, "book_id string, name string, key string"), hot)
    assert sorted((r.x, r.y) for r in got.collect()) == [(f"n{i:02}", f"n{j:02}") for i in range(20) for j in range(i + 1, 20)]


def test_names(spark):
    roster = spark.createDataFrame(
        [
            (1, "b", "Henry Caldridge", ["Harry Caldridge", "Sir Caldridge"]), (2, "b", "Zoë Caldridge", None), (3, "b", "Caldridge, Zoë F.", []), (4, "b", "HENRY CALDRIDGE", [None, ""]),
            (5, "b", "Hollow Gazette", ["The Hollow Gaz."]), (6, "c", "Henry Caldridge", None), (1, "b", "Henry Caldridge", ["Harry Caldridge", "Sir Caldridge"]), (7, "b", "Søren Wick", ["S. Wick"]), (8, "b", None, None), (9, None, "Ann Lee", ["A. Lee"]),
        ],
        "character_id long, book_id string, name string, aliases array<string>",
    )
    segs = spark.createDataFrame([("b", "Caldridge"), ("b", "H. Caldridge"), ("b", "Unknown"), ("b", "Narrator"), ("b", ""), ("b", None), ("b", "Soren Wick"), ("b", "Henry Caldrigde")], "book_id string, speaker string")
    got = {}
    for r in names.name_entities(roster, segs).collect():
        got.setdefault((r.book_id, r.entity), set()).add(r.name)
    sets = sorted(map(sorted, got.values()))
    assert ["H. Caldridge", "HENRY CALDRIDGE", "Harry Caldridge", "Henry Caldridge", "Henry Caldrigde", "Sir Caldridge"] in sets
    assert ["Caldridge, Zoë F.", "Zoë Caldridge"] in sets
    assert ["Hollow Gazette", "The Hollow Gaz."] in sets and ["S. Wick", "Soren Wick", "Søren Wick"] in sets
    assert not any("Caldridge" in s or "Unknown" in s or "" in s for s in sets)  # the bare surname fits two
    assert names.name_entities(roster.limit(0), segs.limit(0)).count() == 0


def test_encoding(spark):
    import public_tokenizers as P
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    texts = ["It was a dark night.", None, "", " \n\n x  y", "日本語 ไทย é🙂", "<|endoftext|>", "a" * 20_000, "It was a dark night."]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.ids for r in encoding.encode_documents(df).collect()}
    assert len(got) == len(texts)
    for i, x in enumerate(texts):
        assert got[i] == ([] if not x else t.encode(x, add_special_tokens=False).ids)
    assert encoding.encode_documents(df.limit(0)).count() == 0


def test_encoding_round_trip(spark):
    """Decoding gives every text back; null and empty lists give an empty text."""
    texts = ["It was a dark night.", None, "", " \n\n x  y", "日本語 ไทย é🙂", "a" * 3000, "It was a dark night."]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    back = {r.doc_id: r.text for r in encoding.decode_documents(encoding.encode_documents(df)).collect()}
    assert back == {i: t or "" for i, t in enumerate(texts)}
    odd = spark.createDataFrame([(1, None), (2, []), (3, [-5]), (None, [64])], "doc_id long, ids array<int>")
    assert {r.doc_id: r.text for r in encoding.decode_documents(odd).collect()} == {1: "", 2: "", 3: "", None: "a"}


def test_encoding_of_long_words():
    """Many pairs of a long word go in one round, with the ids that one pair at a time gives."""
    import public_tokenizers as P
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    encoder = encoding.WordEncoder(encoding.vocabulary_path())
    r = random.Random(2)
    words = ["a" * 9_999, "ab" * 5_000, "=-" * 700 + "-" * 900, "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(8_000)), "".join(r.choice("etaoinsh") for _ in range(4_000)), "".join(chr(r.randint(0x4E00, 0x5800)) for _ in range(3_000))]
    words += ["".join(r.choice("aab-=e") for _ in range(r.randint(1, 60))) for _ in range(800)]
    got = [x for part in encoding._portions(words) for x in encoder.encode(part)]
    for w, ids in zip(words, got):
        assert list(ids) == t.encode(w, add_special_tokens=False).ids, w[:60]


def passage(seed, n=40):
    r = random.Random(seed)
    return [r.choice("alder birch cedar drift ember fjord glade heath inlet jetty knoll larch marsh north ochre plume quarry ridge".split()) + str(r.randint(0, 30)) for _ in range(n)]


def leak_tables(spark):
    p = passage(1)
    typo = p[:15]
    typo[7] = "zzz"
    docs = [
        (1, "Before. " + " ".join(p[5:20]).upper() + " after"), (2, "x " + " ".join(p[5:19]) + " y"), (3, " ".join(typo)), (4, " ".join(sorted(p))), (5, None), (6, ""),
        (7, " ".join(p[:8]) + "\n[p. 12]\n" + " ".join(p[8:15])), (8, " ".join(w[0] + "​" + w[1:] for w in p[:16])), (9, " ".join(p[:9]) + "\n\n— 12 —\n\n" + " ".join(p[9:20])),
        (10, " ".join(passage(2))), (11, " ".join(p[:20]).replace(p[3], p[3][:2] + "-\n" + p[3][2:])),
    ]
    items = [(1, " ".join(p)), (2, " ".join(p)), (3, " ".join(passage(2))), (4, None), (5, "too short")]
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, passage string")


@pytest.mark.parametrize("bound", [leaks.INDEX_BOUND, 1])
def test_leaks(spark, bound):
    docs, items = leak_tables(spark)
    got = {tuple(r) for r in leaks.leaks(docs, items, bound).collect()}
    assert got == {(d, i) for d in (1, 3, 7, 8, 9, 11) for i in (1, 2)} | {(10, 3)}
    assert leaks.leaks(docs.limit(0), items, bound).count() == 0 and leaks.leaks(docs, items.limit(0), bound).count() == 0


@pytest.mark.parametrize("bound", [leaks.INDEX_BOUND, 1])
def test_leaks_across_gaps(spark, bound):
    """Runs cut by words that no passage has, with and without a replaced word beside."""
    p, docs, want = passage(1), [], set()
    strange = lambda n: " ".join(f"qq{i}" for i in range(n))
    for n in (15, 18, 22):
        for gap in (1, 2, 3, 4, 6):
            for cut in (1, 2, 3, n // 2, n - 4, n - 2, n - 1):
                docs.append((len(docs), f"{strange(9)} {' '.join(p[4 : 4 + cut])} {strange(gap)} {' '.join(p[4 + cut : 4 + n])} {strange(9)}"))
    words = p[4:19]
    words[3] = "zzz"
    docs.append((len(docs), f"{strange(9)} {' '.join(words[:9])} {strange(6)} {' '.join(words[9:])} {strange(9)}"))
    want = {(d, 1) for d, _ in docs}
    docs += [(900, f"{' '.join(p[4:11])} {strange(8)} {' '.join(p[11:19])}"), (901, f"{' '.join(p[4:10])} {strange(4)} {' '.join(p[10:18])}")]
    got = leaks.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(1, " ".join(p))], "item_id long, passage string"), bound)
    assert {tuple(r) for r in got.collect()} == want


def test_leak_recall():
    """Windows with two changed words share a key with the original almost always."""
    random.seed(4)
    hit = 0
    for k in range(400):
        a = np.array([random.randint(1, 300) for _ in range(15)])
        b = a.copy()
        for i in random.sample(range(15), 2):
            b[i] = 999
        hit += bool((leaks.window_keys(a[None]) == leaks.window_keys(b[None])).any())
    assert hit / 400 > 0.97


def subject_tables(spark):
    terms = {"music": ["sonata", "fugue", "chorus", "oboe"], "law": ["verdict", "jury", "bail", "writ"]}
    r = random.Random(6)
    def about(s):
        a, b = r.sample(terms[s], 2)
        return f"The {a} was set beside the {b}."
    filler = lambda: f"The {r.choice(['old man', 'widow', 'miller'])} crossed the {r.choice(['bridge', 'orchard', 'ferry'])}."
    docs, want = [], set()
    for i in range(60):
        s = ["music", "law"][i % 2]
        docs.append((i, " ".join([about(s) for _ in range(4)] + [filler() for _ in range(6)])))
        want.add((i, s))
    docs += [(100, " ".join(filler() for _ in range(9))), (101, " ".join([about("law")] + [filler() for _ in range(11)])), (102, None), (103, " "), (0, docs[0][1])]
    ex = [(i, " ".join([about(s), about(s), filler()]), s) for i, s in enumerate(["music", "law"] * 6)] + [(90, about("law"), "music"), (91, None, "law"), (92, "x", None)]
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(ex, "example_id long, text string, subject string"), spark.createDataFrame([("music",), ("law",)], "subject string"), want


@pytest.mark.parametrize("bound", [subjects.LEXICON_BOUND, 0])  # beyond the bound the lexicon is joined instead
def test_subjects(spark, bound):
    docs, ex, names_, want = subject_tables(spark)
    how = {"leaves": 4, "lexicon_bound": bound}
    assert {tuple(r) for r in subjects.document_subjects(docs.withColumn("row", F.lit(1)).withColumn("leaf", F.lit("x")), ex, names_, **how).collect()} == want
    assert subjects.document_subjects(docs.limit(0), ex, names_, **how).count() == 0
    assert subjects.document_subjects(docs, ex.limit(0), names_, **how).count() == 0
    assert subjects.document_subjects(docs, ex, names_.limit(0), **how).count() == 0


def test_subject_mixtures_have_every_document(spark):
    docs, ex, names_, want = subject_tables(spark)
    more = docs.union(spark.createDataFrame([(200, "12 34."), (None, docs.first().text)], docs.schema))
    got = subjects.subject_mixtures(more, ex, names_, leaves=4).toPandas()
    assert set(got.doc_id.dropna().astype(int)) == {*range(60), 100, 101, 200} and got.doc_id.isna().sum() == 1  # not the null and the blank text
    none = got[got.subject.isna()]
    assert set(none.doc_id.astype(int)) == {100, 200} and (none.weight == 0).all()
    assert (got[got.doc_id == 101].weight < subjects.LEAST_SHARE).all()  # a passing mention


def test_very_long_values(spark):
    """Texts and names far longer than any page, in time that grows with their length."""
    import time

    start = time.time()
    quotes = "He said “go.” Then he went ” away. Dr. Oak? " * 20_000
    starts, ends, _, _ = sentences.scan(quotes)
    assert len(starts) > 40_000 and ends[-1] == len(quotes.rstrip())
    assert len(pieces.cut(quotes, 100, 10, "word")) > 1000
    assert len(names.block_codes("bdfgklmnprst" * 5_000)) == 3 and names.parse("x" * 50_000)["sur"]
    p = passage(1)
    ids = leaks.Index([(1, p)])
    words = ["filler"] * 200_000 + p + ["filler"] * 200_000
    assert ids.search(words) == [1]
    assert len(subjects.terms_of(quotes)) > 100_000
    assert time.time() - start < 60


def test_rows_without_ids_and_clashing_columns(spark):
    df = spark.createDataFrame([(None, "b", 1, "a b", 1, 0, "x"), (None, "b", 1, "c d", 1, 0, "x"), (1, "b", 1, "One. Two.", 1, 0, "x")], "segment_id long, book_id string, chapter_number int, text string, config_id int, starts int, word string")
    conf = spark.createDataFrame([(1, 10, 3, "word")], CONF)
    assert packing.containers(df, conf).count() == 3
    assert sentences.sentences(df).count() == 2
    clash = df.withColumn("_sizes", F.lit(1)).withColumn("chunk_size", F.lit(9)).withColumn("piece_no", F.lit(2))
    assert pieces.pieces(clash, conf).count() == 3
    assert canonical.same_reading_pairs(clash).count() == 0


def test_registry():
    q = list(queries())
    assert set(oracle_sql()) <= set(q)
