"""Problem 4: variant spellings of names typed by people.

Every distinct spelling of a book is parsed once (order, title, given name,
initials, surname; or the words of an organisation). Spellings meet in blocks:
a block key is the phonetic code of a sorted token, or that code with one letter
left out, so one wrong consonant still meets; of two full names the other token is part of
the key, so a block holds little but variants of one name. Met spellings are compared token by
token with Jaro-Winkler, a table of nicknames and a rule for contractions. Two tokens are the
same word if their Jaro-Winkler distance is at most ``SLIP`` over the length of the longer one:
a single wrong letter anywhere has two thirds over the length, and slips behind a common
beginning cost less, so several of them may pass.

1. Full names (given name and surname, or a whole organisation) that agree are
   linked, as are full names of one roster entry; connected components of the
   links are the entities.
2. Every other spelling (initials, title and surname, one name alone, nickname,
   contraction, acronym) joins the entity it fits best. If two entities fit it
   alike it belongs to neither.
3. Spellings that fit no entity are linked through their roster entry or where
   they are the same but for case, and form entities by connected components.

Defined results: ``Unknown``, ``Narrator``, null, empty and blank strings are no
names; redelivered rows change nothing; a null book_id has no names.
All joins are on (book, block key); a block of more than ``HOT_BLOCK`` spellings is split into
parts that meet the whole block one by one. A book with a third of all rows shrinks to its distinct
spellings before anything else.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quillspark.llm.canonical import canonical_texts
from quillspark.llm.tables import table
from quillspark.storage import materialize

NO_NAMES = ("Unknown", "Narrator", "")
# Titles, by the form they are brought to; the second part is the gender they tell.
TITLES = {
    "mr": ("mr", "m"), "mister": ("mr", "m"), "mrs": ("mrs", "f"), "mistress": ("mrs", "f"), "miss": ("miss", "f"), "ms": ("ms", "f"),
    "madame": ("madame", "f"), "madam": ("madame", "f"), "mme": ("madame", "f"), "mlle": ("mademoiselle", "f"), "mademoiselle": ("mademoiselle", "f"),
    "monsieur": ("monsieur", "m"), "m": ("monsieur", "m"), "lady": ("lady", "f"), "ly": ("lady", "f"), "lord": ("lord", "m"), "ld": ("lord", "m"), "sir": ("sir", "m"), "dame": ("dame", "f"),
    "dr": ("doctor", ""), "doctor": ("doctor", ""), "prof": ("professor", ""), "professor": ("professor", ""),
    "captain": ("captain", "m"), "capt": ("captain", "m"), "cap'n": ("captain", "m"), "capn": ("captain", "m"), "major": ("major", "m"), "maj": ("major", "m"),
    "colonel": ("colonel", "m"), "col": ("colonel", "m"), "general": ("general", "m"), "gen": ("general", "m"), "lieutenant": ("lieutenant", "m"), "lieut": ("lieutenant", "m"), "lt": ("lieutenant", "m"),
    "parson": ("parson", "m"), "reverend": ("parson", "m"), "rev": ("parson", "m"), "father": ("father", "m"), "fr": ("father", "m"), "sister": ("sister", "f"), "brother": ("brother", "m"),
    "squire": ("squire", "m"), "esquire": ("squire", "m"), "esq": ("squire", "m"), "uncle": ("uncle", "m"), "aunt": ("aunt", "f"),
}
# Nicknames and the names they stand for.
NICKNAMES = {
    "abby": "abigail", "alec": "alexander", "alex": "alexander", "sandy": "alexander", "sasha": "alexander", "archie": "archibald", "gus": "augustus", "bart": "bartholomew", "bat": "bartholomew",
    "ben": "benjamin", "benny": "benjamin", "benjy": "benjamin", "charlie": "charles", "charley": "charles", "chas": "charles", "kit": "christopher", "chris": "christopher", "dolly": "dorothy", "dot": "dorothy", "dora": "dorothy",
    "ned": "edward", "ted": "edward", "teddy": "edward", "eddie": "edward", "ed": "edward", "nell": "eleanor", "nelly": "eleanor", "ellie": "eleanor", "nora": "eleanor",
    "bess": "elizabeth", "bessie": "elizabeth", "betsy": "elizabeth", "betty": "elizabeth", "eliza": "elizabeth", "lizzie": "elizabeth", "liz": "elizabeth", "beth": "elizabeth", "lizzy": "elizabeth", "libby": "elizabeth",
    "fanny": "frances", "fan": "frances", "frank": "francis", "fred": "frederick", "freddy": "frederick", "fritz": "frederick", "georgie": "georgiana", "georgy": "georgiana", "harry": "henry", "hal": "henry", "hank": "henry",
    "bella": "isabella", "belle": "isabella", "izzy": "isabella", "jim": "james", "jimmy": "james", "jem": "james", "jamie": "james", "jack": "john", "johnny": "john", "joe": "joseph", "jo": "josephine",
    "kate": "katherine", "kitty": "katherine", "katie": "katherine", "kathy": "katherine", "kay": "katherine", "maggie": "margaret", "meg": "margaret", "peggy": "margaret", "madge": "margaret", "daisy": "margaret", "greta": "margaret",
    "molly": "mary", "polly": "mary", "may": "mary", "mamie": "mary", "mike": "michael", "mick": "michael", "nat": "nathaniel", "nate": "nathaniel", "nick": "nicholas", "penny": "penelope", "pen": "penelope", "pat": "patrick", "phil": "philip",
    "dick": "richard", "rick": "richard", "dickie": "richard", "rich": "richard", "bob": "robert", "robin": "robert", "rob": "robert", "bobby": "robert", "bert": "robert", "sam": "samuel", "sammy": "samuel", "sally": "sarah", "sadie": "sarah", "steve": "stephen",
    "sue": "susannah", "susie": "susannah", "susan": "susannah", "sukey": "susannah", "tom": "thomas", "tommy": "thomas", "bill": "william", "will": "william", "billy": "william", "willie": "william", "liam": "william", "winnie": "winifred", "freda": "winifred", "win": "winifred",
}
# Words that make a name an organisation's, and their short forms.
ORG_WORDS = {
    "society": "society", "soc": "society", "gazette": "gazette", "gaz": "gazette", "company": "company", "co": "company", "coy": "company", "brothers": "brothers", "bros": "brothers", "sons": "sons",
    "association": "association", "assoc": "association", "assn": "association", "ass'n": "association", "railway": "railway", "rly": "railway", "ry": "railway", "rlwy": "railway", "shipping": "shipping", "shpg": "shipping", "ship": "shipping", "trading": "trading", "trdg": "trading", "trad": "trading",
    "assurance": "assurance", "assur": "assurance", "assce": "assurance", "insurance": "insurance", "ins": "insurance", "canal": "canal", "bank": "bank", "limited": "limited", "ltd": "limited", "institute": "institute", "inst": "institute",
    "corporation": "corporation", "corp": "corporation", "college": "college", "coll": "college", "university": "university", "univ": "university", "committee": "committee", "comm": "committee", "council": "council", "club": "club", "union": "union", "house": "house", "press": "press", "works": "works", "mission": "mission", "manufacturing": "manufacturing", "mfg": "manufacturing",
}
#: Codes of this length and more also meet by their two ends, which no slip in the other half touches.
LONG_CODE = 38
#: Most Jaro-Winkler distance of two tokens that differ by typing errors, times the length of the longer one.
SLIP = 0.7
#: Spellings of a block above which it is split.
HOT_BLOCK = 2000


_FORMAL = frozenset(NICKNAMES.values())


def _jaro(a: str, b: str, tries: tuple) -> float:
    reach = max(len(a), len(b)) // 2 - 1
    used = [False] * len(b)
    match = [-1] * len(a)
    for near in tries:
        for i, ch in enumerate(a):
            if match[i] < 0:
                for d in near or range(-reach, reach + 1):
                    j = i + d
                    if 0 <= j < len(b) and -reach <= d <= reach and not used[j] and b[j] == ch:
                        used[j] = True
                        match[i] = j
                        break
    mine = [ch for ch, j in zip(a, match) if j >= 0]
    m = len(mine)
    if not m:
        return 0.0
    theirs = [ch for ch, u in zip(b, used) if u]
    swaps = sum(x != y for x, y in zip(mine, theirs)) / 2
    return (m / len(a) + m / len(b) + (m - swaps) / m) / 3


@lru_cache(maxsize=200_000)
def jaro_winkler(a: str, b: str) -> float:
    """The Jaro-Winkler similarity of two strings.

    Of two ways to match equal letters the better one counts: each with the first within reach, or
    with one beside it before any farther off; so one letter too many puts no repeated letters out of order.
    """
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    jaro = max(_jaro(a, b, ((),)), _jaro(a, b, ((0, -1, 1), ())))
    prefix = 0
    for x, y in zip(a[:4], b[:4]):
        if x != y:
            break
        prefix += 1
    return jaro + 0.1 * prefix * (1 - jaro)


def alike(a: str, b: str, least: int = 4) -> bool:
    """Whether two tokens of at least ``least`` letters are the same word but for typing errors."""
    return a == b or min(len(a), len(b)) >= least and (1 - jaro_winkler(a, b)) * max(len(a), len(b)) <= SLIP


def contracts(short: str, name: str) -> bool:
    """Whether ``short`` is a contraction of ``name``: its first letter, then letters in their order."""
    if len(short) < 2 or len(short) >= len(name) or short[0] != name[0]:
        return False
    at = 0
    for ch in short:
        at = name.find(ch, at) + 1
        if not at:
            return False
    return True


_CLASSES = str.maketrans({**dict.fromkeys("bpfvw", "b"), **dict.fromkeys("cgjkqsxz", "k"), **dict.fromkeys("dt", "t"), **dict.fromkeys("mn", "n"), **dict.fromkeys("aeiouyh", None)})


def phonetic(token: str) -> str:
    """The phonetic code of a token: classes of consonants without vowels and doublings."""
    return _undoubled(token.replace("ph", "f").translate(_CLASSES)) or "-"


def _undoubled(code: str) -> str:
    return "".join(c for i, c in enumerate(code) if not i or c != code[i - 1])


def block_codes(token: str) -> list[str]:
    """The code of a token, and the code with one letter left out; of a very long code two halves take the place of the latter."""
    c = phonetic(token)
    if len(c) >= LONG_CODE:
        h = LONG_CODE // 2 - 1
        return [c, f"<{c[:h]}", f">{c[-h:]}"]
    return sorted({c, *(_undoubled(c[:i] + c[i + 1 :]) for i in range(len(c)))}) if len(c) > 1 else [c]


def _codes(kind: str, token: str) -> list[str]:
    return [kind + c for c in block_codes(token)]


def _simple(name: str) -> str:
    t = unicodedata.normalize("NFD", name.replace("ø", "o").replace("Ø", "O").replace("ß", "ss"))
    return " ".join("".join(c for c in t if not unicodedata.combining(c)).replace("’", "'").lower().split())


_TITLE_LIKE = sorted({t for t in TITLES if len(t) >= 4})


@lru_cache(maxsize=200_000)
def parse(name: str) -> dict:
    """The parts of one spelling.

    kind: full, part (of a person's name) or org, acro (organisation). Further: title,
    gender, given, how (the given name is a ``name``, ``nick``, ``short``, ``init`` or ``none``),
    middle (an initial), sur, and words of an organisation.
    """
    s = _simple(canonical_texts([name])[0] or "")
    out = {"kind": "part", "title": "", "gender": "", "given": "", "how": "none", "middle": "", "sur": "", "words": ""}
    raw = s.replace("&", " and ").split()
    words = [w.strip(".,;:'\"()") for w in raw]
    words = [w for w in words if w]
    bare = [w for w in words if w not in ("the", "and")]
    if re.fullmatch(r"(?:[a-z]\.){3,}|(?:[a-z]\. ){2,}[a-z]\.", s) or (" " not in s and name.isupper() and 2 <= len(s) <= 6 and s.isalpha() and not re.search(r"[aeiouy].*[aeiouy]", s)):
        return out | {"kind": "acro", "words": re.sub(r"[^a-z]", "", s)}
    if len(bare) > 1 and any(w in ORG_WORDS or any(len(o) > 5 and alike(w, o) for o in ORG_WORDS) for w in bare[1:]) or (len(bare) == 1 and s.startswith("the ")):
        full = [ORG_WORDS.get(w, w) for w in bare if w != "ad"]
        return out | {"kind": "org", "words": " ".join(full)}
    if "," in s and " " in s:
        sur, _, rest = s.partition(",")
        if rest.strip():
            raw = [*rest.split(), *sur.split()]
    parts = []
    for k, w in enumerate(raw):
        t = w.strip(".,;:\"()")
        if not t:
            continue
        if k == 0 and len(raw) > 1:
            hit = TITLES.get(t) if not (t == "m" and len(raw) > 2) and not (t == "m" and w.endswith(".")) else None
            if not hit and len(t) >= 3 and len(raw) == 2 and not w.endswith(".") and t not in NICKNAMES:
                near = [x for x in _TITLE_LIKE if alike(t, x, 3)]
                hit = TITLES[near[0]] if near and t != "mary" else None
            if hit:
                out["title"], out["gender"] = hit
                continue
        parts.append((t, w.endswith(".")))
    if not parts:
        return out
    if len(parts) == 1:
        out["sur"] = parts[0][0]
        return out | ({"how": "title"} if out["title"] else {"how": "one"})
    given, dotted = parts[0]
    out["sur"] = parts[-1][0]
    out["middle"] = next((t[0] for t, _ in parts[1:-1]), "")
    if len(given) == 1:
        return out | {"given": given, "how": "init"}
    if dotted:
        return out | {"given": given, "how": "short"}
    if given in NICKNAMES:
        return out | {"given": given, "how": "nick"}
    return out | {"given": given, "how": "name", "kind": "full"}


def _keys(p: dict) -> list[str]:
    """Where a spelling meets full names: its surname, a given name that stands for it, or an organisation's words."""
    if p["kind"] == "acro":
        return ["a:" + p["words"]]
    if p["kind"] == "org":
        w = p["words"].split()
        return ["a:" + "".join(x[0] for x in w), *_codes("o:", "".join(sorted(phonetic(x) for x in w)))]
    keys = _codes("s:", p["sur"])
    if p["how"] == "one":
        formal = NICKNAMES.get(p["sur"], p["sur"])
        keys += _codes("g:", formal) + (_codes("g:", p["sur"]) if formal != p["sur"] else [])
    if p["how"] in ("name", "nick"):
        keys += _codes("g:", p["given"])
    return keys


def _own_keys(p: dict) -> list[str]:
    """Where two full names meet: one token as it is, and the code of the other."""
    if p["kind"] == "org":
        return [k for k in _keys(p) if k.startswith("o:")]
    return [*_codes(f"{p['given']}|", p["sur"]), *_codes(f"|{p['sur']}|", p["given"])] if p["kind"] == "full" else []


_PARSED = "book_id string, name string, kind string, title string, gender string, given string, how string, middle string, sur string, same string, keys array<string>, own array<string>"


def _parse_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        parsed = [parse(n) for n in b.column(1).to_pylist()]
        cols = [pa.array([p[c] for p in parsed], pa.string()) for c in ("kind", "title", "gender", "given", "how", "middle", "sur")]
        same = pa.array(["|".join(p[c] for c in ("kind", "title", "given", "middle", "sur", "words")) for p in parsed], pa.string())
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *cols, same, pa.array([_keys(p) for p in parsed], pa.list_(pa.string())), pa.array([_own_keys(p) for p in parsed], pa.list_(pa.string()))], [x.split()[0] for x in _PARSED.split(", ")])


def _same_entity(a: dict, b: dict) -> bool:
    """Whether two full spellings agree."""
    if a["kind"] != b["kind"]:
        return False
    if a["kind"] == "org":
        x, y = a["words"].split(), b["words"].split()
        return len(x) == len(y) and sum(p != q for p, q in zip(x, y)) <= 1 and all(alike(p, q) for p, q in zip(x, y))
    if a["given"] == b["given"]:
        return alike(a["sur"], b["sur"])
    if a["sur"] != b["sur"]:
        return False
    short = min(len(a["given"]), len(b["given"])) < 4
    return alike(a["given"], b["given"], 3) and not (short and {a["given"], b["given"]} <= _FORMAL)


def _fit(p: dict, f: dict, titles: list[str], middles: list[str], gender: str) -> int:
    """How well the spelling ``p`` fits the person or organisation of the full name ``f``: 0 is best, -1 not at all."""
    if f["kind"] == "org":
        if p["kind"] == "acro":
            w = f["words"].split()
            return 0 if p["words"] == "".join(x[0] for x in w) else -1
        return -1
    if p["kind"] != "part":
        return -1
    rank = 0
    if p["how"] == "one":
        formal = NICKNAMES.get(p["sur"], p["sur"])
        if p["sur"] in (f["sur"], f["given"]) or formal == f["given"]:
            return 0
        return 4 if alike(p["sur"], f["sur"]) or alike(p["sur"], f["given"]) else -1
    if p["sur"] != f["sur"]:
        if not alike(p["sur"], f["sur"]):
            return -1
        rank += 8
    if p["title"]:
        if titles:
            female = {"ms", "mrs", "miss"}
            if p["title"] not in titles and not ("ms" in (p["title"], *titles) and p["title"] in female and female & set(titles)):
                return -1
        elif p["gender"] and gender and p["gender"] != gender:
            return -1
        else:
            rank += 1
    g, how = p["given"], p["how"]
    if how == "init" and g != f["given"][0]:
        return -1
    if how == "short" and not contracts(g, f["given"]):
        return -1
    if how == "nick" and NICKNAMES[g] != f["given"] and g != f["given"]:
        if not alike(NICKNAMES[g], f["given"]):
            return -1
        rank += 4
    if p["middle"]:
        if middles and p["middle"] not in middles:
            return -1
        rank += 0 if middles else 2
    return rank


def _pairs_alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keep the pairs (book_id, x, y) of full names that agree. Names travel as strings and are parsed here, each once a task."""
    for b in batches:
        keep = [_same_entity(parse(x), parse(y)) for x, y in zip(b.column(1).to_pylist(), b.column(2).to_pylist())]
        yield b.filter(pa.array(keep, pa.bool_()))


def _fits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = zip(*(b.column(i).to_pylist() for i in (1, 3, 4, 5, 6)))
        fit = [_fit(parse(name), parse(full), titles or [], middles or [], gender or "") for name, full, titles, middles, gender in rows]
        out = pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(fit, pa.int32())], ["book_id", "name", "entity", "fit"])
        yield out.filter(pa.array([k >= 0 for k in fit], pa.bool_()))


def components(edges: DataFrame) -> DataFrame:
    """Connected components: (book_id, name, entity) of every linked name, with the least name of its component.

    Every round takes the least label among a node and its neighbours and then the
    label of that label, until no label changes. Each round is one table in the shared
    folder; how many labels changed is counted while it is written.
    """
    both = materialize(edges.select("book_id", "x", "y").union(edges.select("book_id", F.col("y").alias("x"), F.col("x").alias("y"))).where("x <> y").distinct(), "p4-edges")
    label = materialize(both.groupBy("book_id", F.col("x").alias("name")).agg(F.min("y").alias("least")).select("book_id", "name", F.least("name", "least").alias("entity")), "p4-labels")
    while True:
        near = both.join(label.withColumnRenamed("name", "y"), ["book_id", "y"]).groupBy("book_id", F.col("x").alias("name")).agg(F.min("entity").alias("near"))
        jump = label.select("book_id", F.col("name").alias("entity"), F.col("entity").alias("far"))
        step = label.join(near, ["book_id", "name"]).join(jump, ["book_id", "entity"], "left")
        best = F.least("entity", "near", F.coalesce("far", "entity"))
        counted = Observation()
        label = materialize(step.select("book_id", "name", best.alias("entity"), (best != F.col("entity")).alias("moved")).observe(counted, F.count_if("moved").alias("moved")).select("book_id", "name", "entity"), "p4-labels")
        if not counted.get["moved"]:
            return label


def met_pairs(keyed: DataFrame, hot: int = HOT_BLOCK) -> DataFrame:
    """(book_id, x, y), x < y: the spellings (book_id, name, key) that share a key.

    Blocks of more than ``hot`` spellings are split: each part of the block meets copies of the whole.
    """
    size = keyed.groupBy("book_id", "key").agg(F.ceil(F.count("*") / hot).alias("parts")).where("parts > 1")
    left, right, on = keyed, keyed, ["book_id", "key"]
    if not size.isEmpty():
        sized = materialize(keyed.join(size, on, "left").withColumn("parts", F.coalesce("parts", F.lit(1))), "p4-blocks")
        left = sized.withColumn("part", F.pmod(F.xxhash64("name"), F.col("parts"))).drop("parts")
        right = sized.withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1))).drop("parts")
        on = [*on, "part"]
    met = left.withColumnRenamed("name", "x").join(right.withColumnRenamed("name", "y"), on).where("x < y")
    return met.select("book_id", "x", "y").distinct()


def name_entities(roster: DataFrame, segments: DataFrame) -> DataFrame:
    """(book_id, name, entity): the entity of every spelling that belongs to one.

    Needs book_id, character_id, name, aliases and book_id, speaker.
    """
    entries = roster.where("book_id is not null").select("book_id", "character_id", "name", "aliases").distinct()
    listed = entries.select("book_id", "character_id", F.explode(F.array_append(F.coalesce("aliases", F.array().cast("array<string>")), F.col("name"))).alias("name")).where("name is not null")
    spoken = segments.where("book_id is not null and speaker is not null").select("book_id", F.col("speaker").alias("name")).distinct()
    real = ~F.trim("name").isin(*NO_NAMES) & F.col("name").rlike(r"\p{L}")
    listed = materialize(listed.where(real).distinct(), "p4-listed")
    names = listed.select("book_id", "name").union(spoken.where(real)).distinct()
    parsed = materialize(names.mapInArrow(_parse_batches, _PARSED), "p4-names")

    # 1. full names: links inside blocks, and inside roster entries
    core = parsed.where("kind in ('full', 'org')")
    met = met_pairs(core.select("book_id", "name", F.explode("own").alias("key")))
    links = met.mapInArrow(_pairs_alike, "book_id string, x string, y string")
    full_of = materialize(listed.join(core.select("book_id", "name"), ["book_id", "name"]), "p4-full")
    head = full_of.groupBy("book_id", "character_id").agg(F.min("name").alias("x"))
    listed_links = full_of.join(head, ["book_id", "character_id"]).select("book_id", "x", F.col("name").alias("y"))
    label = components(links.union(listed_links))
    told = materialize(core.join(label, ["book_id", "name"], "left").withColumn("entity", F.coalesce("entity", "name")), "p4-core")

    # what is known of each entity: titles, middle initials, and the gender of its given name in the corpus
    titled = listed.join(parsed.where("how = 'title'").select("book_id", "name", "title", "sur"), ["book_id", "name"]).drop("name")
    by_entry = full_of.join(told.select("book_id", "name", "entity", F.col("sur").alias("full_sur")), ["book_id", "name"]).join(titled, ["book_id", "character_id"]).where(F.levenshtein("sur", "full_sur") <= 2).select("book_id", "entity", "title", F.lit("").alias("middle"))
    facts = told.where("kind = 'full'").select("book_id", "entity", "title", "middle").union(by_entry)
    facts = facts.groupBy("book_id", "entity").agg(F.collect_set(F.when(F.col("title") != "", F.col("title"))).alias("titles"), F.collect_set(F.when(F.col("middle") != "", F.col("middle"))).alias("middles"))
    genders = told.where("gender <> ''").groupBy("given").agg(F.mode("gender").alias("known_gender"))
    known = materialize(told.select("book_id", "entity", F.col("name").alias("full"), "given").join(genders, "given", "left").join(facts, ["book_id", "entity"], "left").select("book_id", "full", "titles", "middles", "known_gender"), "p4-known")

    # 2. every other spelling joins the one entity it fits best
    whole = told.select("book_id", "entity", F.col("name").alias("full"), F.explode("keys").alias("key"))
    rest = parsed.where("kind in ('part', 'acro')")
    tried = rest.select("book_id", "name", F.explode("keys").alias("key")).join(whole, ["book_id", "key"]).select("book_id", "name", "entity", "full").distinct()
    asked = tried.join(known, ["book_id", "full"]).select("book_id", "name", "entity", "full", "titles", "middles", "known_gender")
    fits = asked.mapInArrow(_fits, "book_id string, name string, entity string, fit int").groupBy("book_id", "name", "entity").agg(F.min("fit").alias("fit"))
    alike_ = fits.groupBy("book_id", "name", "fit").agg(F.count("*").alias("n"), F.min("entity").alias("entity"))
    best = materialize(alike_.groupBy("book_id", "name").agg(F.min_by(F.struct("n", "entity"), "fit").alias("b")).select("book_id", "name", "b.n", "b.entity"), "p4-best")
    placed = told.select("book_id", "name", "entity").union(best.where("n = 1").select("book_id", "name", "entity"))

    # 3. spellings that fit nothing: by roster entry, or the same but for case and title
    lost = materialize(rest.select("book_id", "name", "same").join(best.select("book_id", "name"), ["book_id", "name"], "left_anti"), "p4-lost")
    lost_of = materialize(listed.join(lost.select("book_id", "name"), ["book_id", "name"]), "p4-lost-of")
    home = listed.join(lost_of.select("book_id", "character_id").distinct(), ["book_id", "character_id"], "left_semi").join(placed, ["book_id", "name"])
    home = home.groupBy("book_id", "character_id").agg(F.min("entity").alias("entity"), F.countDistinct("entity").alias("n")).where("n = 1").drop("n")
    homed = materialize(lost_of.join(home, ["book_id", "character_id"]).groupBy("book_id", "name").agg(F.min("entity").alias("entity"), F.countDistinct("entity").alias("n")).where("n = 1").drop("n"), "p4-homed")
    lone = materialize(lost.join(homed, ["book_id", "name"], "left_anti"), "p4-lone")
    same_links = lone.join(lone.groupBy("book_id", "same").agg(F.min("name").alias("x")), ["book_id", "same"]).select("book_id", "x", F.col("name").alias("y"))
    lone_of = lost_of.join(lone.select("book_id", "name"), ["book_id", "name"])
    entry_links = lone_of.join(lone_of.groupBy("book_id", "character_id").agg(F.min("name").alias("x")), ["book_id", "character_id"]).select("book_id", "x", F.col("name").alias("y"))
    alone = lone.select("book_id", "name").join(components(same_links.union(entry_links)), ["book_id", "name"], "left")
    return placed.union(homed).union(alone.select("book_id", "name", F.concat(F.lit("~"), F.coalesce("entity", "name"))))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of spellings of a book that mean the same person or organisation."""
    e = materialize(name_entities(table(spark, sf_dir, "roster"), table(spark, sf_dir, "segments")), "p4-entities")
    return met_pairs(e.select("book_id", "name", F.col("entity").alias("key"))).select("book_id", F.col("x").alias("name_a"), F.col("y").alias("name_b"))


def p4_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every spelling that belongs to a person or organisation, its entity, and how many other spellings are linked to it."""
    e = materialize(name_entities(table(spark, sf_dir, "roster"), table(spark, sf_dir, "segments")), "p4-entities")
    sizes = e.groupBy("book_id", "entity").agg((F.count("*") - 1).alias("links"))
    return e.join(sizes, ["book_id", "entity"]).select("book_id", "name", "entity", "links")
