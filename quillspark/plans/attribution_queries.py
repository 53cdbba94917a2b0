"""Queries on names, speakers and finished books."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.functions import patterns as P
from quillspark.functions import text as T
from quillspark.operators import assemble as Z
from quillspark.operators import attribution as A
from quillspark.operators import resolver as R
from quillspark.operators import roster as O
from quillspark.plans import sql as Q
from quillspark.plans.registry import query
from quillspark.plans.segment_queries import CHAPTER, doc_segments, docs, segments_once
from quillspark.plans.structure_queries import chapters_once, table

E = "coalesce(aliases, cast(array() as array<string>))"


def people(spark: SparkSession, sf: str) -> DataFrame:
    r = table(spark, sf, "roster").withColumn("aliases", F.expr(E))
    return r.select("character_id", "book_id", "ord", "name", "aliases", "pronunciation_hints", "first_appearance_chapter").distinct()


def aliases(spark: SparkSession, sf: str) -> DataFrame:
    return A.alias_map(people(spark, sf), "book_id")


@query(f"with {Q.ALIASES} select book_id, alias, canonical from amap")
def alias_map(spark: SparkSession, sf: str) -> DataFrame:
    return aliases(spark, sf).select("book_id", "alias", "canonical")


@query(f"""with {Q.ALIASES}, {Q.SEGS}
select segment_id, case when s.speaker is null or s.speaker in ('Unknown', 'Narrator') then s.speaker else coalesce(canonical, 'Unknown') end as speaker from segs s left join amap a on a.book_id = s.book_id and a.alias = lower(s.speaker)""")
def remapped_speakers(spark: SparkSession, sf: str) -> DataFrame:
    return Z.remapped_speakers(segments_once(spark, sf, "book_id", "speaker"), aliases(spark, sf), "book_id").select("segment_id", "speaker")


@query(f"with {Q.SEGS} select segment_id, {Q.is_tag('seg_type', 'text')} as is_tag, {Q.leads('text')} as leads from segs where text is not null")
def attribution_tags(spark: SparkSession, sf: str) -> DataFrame:
    x = F.col("text")
    return segments_once(spark, sf, T.is_tag(F.col("seg_type"), x).alias("is_tag"), T.leads_with_speech(x).alias("leads"), x.isNotNull().alias("has")).where("has").drop("has")


def named(spark: SparkSession, sf: str) -> DataFrame:
    """Segments of the documents of books, with the aliases of the book as a map."""
    d = docs(spark, sf).where("book_id is not null").select("doc_id", "book_id")
    amap = A.map_of_aliases(aliases(spark, sf), "book_id")
    return doc_segments(spark, sf).join(d, "doc_id").join(amap, "book_id", "left")


_SPEAKER_CTE = f"""{Q.ALIASES}, {Q.SPANS},
dsegs as (select t.doc_id, d.book_id, (row_number() over (partition by t.doc_id order by para, k) - 1)::int as seg_idx, seg_type, t.text from typed t join documents d on d.doc_id = t.doc_id where t.text <> ''),
tags as (select *, {Q.tag_sentences('text')} as ss from dsegs where book_id is not null and {Q.is_tag('seg_type', 'text')}),
ends_ as (select doc_id, book_id, seg_idx, ss[1] as s, -1 as side from tags where {Q.leads('ss[1]')}
 union all select doc_id, book_id, seg_idx, ss[-1], 1 from tags where {Q.leads('ss[-1]')} and regexp_matches({Q.strip('text')}, '[,;:]$')),
hits as (select e.doc_id, e.seg_idx, e.side, count(distinct canonical) as n, min(canonical) as c from ends_ e join amap a on a.book_id = e.book_id and length(alias) >= 3 and {Q.mentions('e.s', 'a.alias')} group by all),
names_ as (select e.*, nullif(regexp_extract(s, {Q.lit(P.VERB_NAME)}, 1), '') as after_, lower(nullif(regexp_extract(s, {Q.lit(P.NAME_VERB)}, 1), '')) as before_ from ends_ e),
said as (select n.doc_id, n.seg_idx, n.side, coalesce(a1.canonical, after_, a2.canonical, case when h.n = 1 then h.c end) as who from names_ n
 left join amap a1 on a1.book_id = n.book_id and a1.alias = lower(after_) left join amap a2 on a2.book_id = n.book_id and a2.alias = before_ left join hits h on h.doc_id = n.doc_id and h.seg_idx = n.seg_idx and h.side = n.side),
anch as (select d.doc_id, d.book_id, d.seg_idx, coalesce(b.who, f.who) as anchor from dsegs d left join said b on b.doc_id = d.doc_id and b.seg_idx = d.seg_idx + 1 and b.side = -1 left join said f on f.doc_id = d.doc_id and f.seg_idx = d.seg_idx - 1 and f.side = 1
 where d.seg_type = 'dialogue' and coalesce(b.who, f.who) is not null and d.book_id is not null)"""


def anchored(spark: SparkSession, sf: str) -> DataFrame:
    from quillspark.operators import segment as G

    d = docs(spark, sf).where("book_id is not null").select("doc_id", "text")
    book = docs(spark, sf).select("doc_id", "book_id")
    s = G.segments(d, "doc_id", limit=1 << 30).join(book, "doc_id").join(A.map_of_aliases(aliases(spark, sf), "book_id"), "book_id", "left")
    return A.anchors(s, ["doc_id"])


@query(f"with {_SPEAKER_CTE} select doc_id, seg_idx, anchor from anch")
def named_anchors(spark: SparkSession, sf: str) -> DataFrame:
    return anchored(spark, sf).where("anchor is not null").select("doc_id", "seg_idx", "anchor")


@query(f"with {_SPEAKER_CTE} select book_id, name from (select distinct book_id, anchor as name from anch) x where not exists (select 1 from people p where p.book_id = x.book_id and p.name = x.name)")
def missed_names(spark: SparkSession, sf: str) -> DataFrame:
    return O.missed_names(anchored(spark, sf), people(spark, sf), "book_id")


@query(f"with {_SPEAKER_CTE} select doc_id, count(*) as n from dsegs d where book_id is not null and {Q.is_tag('seg_type', 'text')} and not exists (select 1 from amap a where a.book_id = d.book_id and length(alias) >= 3 and {Q.mentions('d.text', 'a.alias')}) group by doc_id")
def nameless_tags(spark: SparkSession, sf: str) -> DataFrame:
    from quillspark.operators import segment as G

    d = docs(spark, sf).where("book_id is not null").select("doc_id", "text")
    s = G.segments(d, "doc_id", limit=1 << 30).join(docs(spark, sf).select("doc_id", "book_id"), "doc_id").join(A.map_of_aliases(aliases(spark, sf), "book_id"), "book_id", "left")
    return A.nameless_tags(s).groupBy("doc_id").agg(F.count("*").alias("n"))


@query(f"""with {Q.ALIASES}, {Q.SEGS},
short as (select segment_id, book_id, text from segs where seg_type = 'dialogue' and text is not null),
h as (select segment_id, canonical, max(length(alias)) as n from short s join amap a on a.book_id = s.book_id and length(alias) >= 3 and contains(lower(text), alias) and {Q.mentions('s.text', 'a.alias')} group by all)
select segment_id, count(*) as mentioned, max(n)::int as longest from h group by segment_id""")
def mentions(spark: SparkSession, sf: str) -> DataFrame:
    s = segments_once(spark, sf, "book_id", "seg_type", "text").where("seg_type = 'dialogue' and text is not null").drop("seg_type")
    a = aliases(spark, sf).where(F.length("alias") >= A.SHORTEST_MENTION)
    hit = s.join(a, "book_id").where(F.contains(F.lower("text"), F.col("alias")) & T.mentions(F.col("text"), F.col("alias")))
    longest = hit.groupBy("segment_id", "canonical").agg(F.max(F.length("alias")).alias("n"))
    return longest.groupBy("segment_id").agg(F.count("*").alias("mentioned"), F.max("n").alias("longest"))


_ASCII = "translate(lower({}), 'éèêëáàâäóòôöúùûüíìîïñçøåæœß', '0123456789!#$%&*+/<=>?@^_|~')"


@query(f"""with {Q.ROSTER}, {Q.SEGS},
lost as (select distinct book_id, speaker from segs s where speaker is not null and speaker not in ('Unknown', 'Narrator') and not exists (select 1 from people p where p.book_id = s.book_id and p.name = s.speaker)),
ns as (select book_id, name, min(ord) as ord from people where name is not null group by all),
d as (select l.book_id, speaker, name, ord, levenshtein({_ASCII.format('speaker')}, {_ASCII.format('name')}) as distance from lost l join ns on ns.book_id = l.book_id)
select book_id, speaker, arg_min(name, (distance, ord)) as nearest, min(distance)::int as distance from d where distance <= 2 group by book_id, speaker""")
def nearest_names(spark: SparkSession, sf: str) -> DataFrame:
    return O.nearest_names(table(spark, sf, "segments").select("book_id", "speaker"), people(spark, sf), "book_id")


@query(f"""with {Q.ROSTER},
sp as (select book_id, ord, unnest(list_append(aliases, name)) as spelling from people),
al as (select p.book_id, p.ord, p.name, count(distinct q.ord) as n, min(q.ord) as o from people p join people q on q.book_id = p.book_id and q.ord <> p.ord and len(list_filter(q.aliases, lambda a: lower(a) = lower(p.name))) > 0 group by all),
tk as (select p.book_id, p.ord, count(distinct s.ord) as n, min(s.ord) as o from people p join sp s on s.book_id = p.book_id and s.ord <> p.ord and list_has_all({Q.name_tokens('s.spelling')}, {Q.name_tokens('p.name')}) group by all)
select p.book_id, p.ord, p.name, coalesce(case when al.n = 1 then al.o end, case when tk.n = 1 then tk.o end) as target from people p left join al on al.book_id = p.book_id and al.ord = p.ord left join tk on tk.book_id = p.book_id and tk.ord = p.ord where coalesce(case when al.n = 1 then al.o end, case when tk.n = 1 then tk.o end) is not null""")
def duplicate_candidates(spark: SparkSession, sf: str) -> DataFrame:
    return O.duplicate_candidates(people(spark, sf).where("name is not null"), "book_id")


@query(f"""with {Q.ROSTER}, n as (select distinct unnest(list_append(aliases, name)) as name from people)
select name, (list_sum(list_transform({Q.words('name')}, lambda t: case when regexp_matches(t, '^\\p{{Lu}}') then 1 when regexp_matches(t, '^\\p{{L}}') then -1 else 0 end)) - case when regexp_matches(name, {Q.lit("[’']s($|" + P.NOT_W + ")")}) then 2 else 0 end)::int as quality,
 regexp_matches(name, {Q.lit(P.PLACEHOLDER)}) as placeholder, list_sort({Q.name_tokens('name')}) as tokens from n where {Q.strip('name')} <> ''""")
def name_facts(spark: SparkSession, sf: str) -> DataFrame:
    n = people(spark, sf).select(F.explode(F.array_append("aliases", F.col("name"))).alias("name")).distinct().where(T.strip(F.col("name")) != "")
    x = F.col("name")
    return n.select("name", T.name_quality(x).alias("quality"), T.is_placeholder(x).alias("placeholder"), F.array_sort(T.name_tokens(x)).alias("tokens"))


@query(f"""with {Q.ROSTER} select book_id, list_distinct(list(name order by ord)).list_sort() as options, count(*) as entries from people where name is not null and not regexp_matches(name, {Q.lit(P.PLACEHOLDER)}) group by book_id""".replace("list_distinct(list(name order by ord)).list_sort()", "list_sort(list_distinct(list(name order by ord) || ['Unknown']))"))
def speaker_options(spark: SparkSession, sf: str) -> DataFrame:
    p = people(spark, sf).where(F.col("name").isNotNull() & ~T.is_placeholder(F.col("name")))
    g = p.groupBy("book_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", "name"))), lambda x: x["name"]).alias("names"), F.count("*").alias("entries"))
    return g.select("book_id", F.array_sort(T.speaker_options(F.col("names"))).alias("options"), "entries")


@query(f"with {Q.SEGS} select book_id, chapter_number, count(*) filter (seg_type = 'dialogue') as dialogue, count(*) filter (seg_type = 'dialogue' and coalesce(speaker, 'Unknown') <> 'Unknown') as named, count(*) filter (seg_type = 'dialogue' and coalesce(speaker, 'Unknown') = 'Unknown') as unknown from segs group by all")
def attribution_counts(spark: SparkSession, sf: str) -> DataFrame:
    return Z.attribution_counts(segments_once(spark, sf, *CHAPTER, "seg_type", "speaker"), CHAPTER)


@query(f"with {Q.SEGS} select segment_id from segs where seg_type = 'dialogue' and speaker is null")
def unresolved_dialogue(spark: SparkSession, sf: str) -> DataFrame:
    return A.unresolved(segments_once(spark, sf, "seg_type", "speaker")).select("segment_id")


def passes(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """Answers of three readers to every unresolved segment, by arithmetic on its number."""
    u = A.unresolved(segments_once(spark, sf, *CHAPTER, "seg_idx", "seg_type", "speaker")).select("segment_id", *CHAPTER, "seg_idx")
    who = lambda k: F.concat(F.lit("N"), ((F.col("segment_id") * k) % 3).cast("string"))
    on = [*CHAPTER, "seg_idx"]
    return {
        "asked": u.select("segment_id", *on),
        "a": u.where("segment_id % 7 <> 0").select(*on, who(1).alias("speaker"), F.lit(0).alias("ord")),
        "b": u.where("segment_id % 5 <> 0").select(*on, who(2).alias("speaker"), F.lit(0).alias("ord")),
        "c": u.where("segment_id % 11 <> 0").select(*on, who(4).alias("speaker"), F.lit(0).alias("ord")),
    }


@query(f"""with {Q.SEGS}, u as (select segment_id, case when segment_id % 7 <> 0 then 'N' || (segment_id % 3) end as a, case when segment_id % 5 <> 0 then 'N' || (segment_id * 2 % 3) end as b, case when segment_id % 11 <> 0 then 'N' || (segment_id * 4 % 3) end as c from segs where seg_type = 'dialogue' and speaker is null)
select segment_id, case when a is not null and b is not null and a <> b then coalesce(c, 'Unknown') else coalesce(a, b, 'Unknown') end as speaker, coalesce(a <> b, false) as disputed from u""")
def pass_reconcile(spark: SparkSession, sf: str) -> DataFrame:
    p = passes(spark, sf)
    kept = {k: A.kept_answers(p[k], p["asked"], CHAPTER) for k in "abc"}
    return A.reconcile(kept["a"], kept["b"], kept["c"], p["asked"], CHAPTER).join(p["asked"], [*CHAPTER, "seg_idx"]).select("segment_id", "speaker", "disputed")


@query(f"""with {Q.SEGS}, t as (select *, case when seg_type = 'narration' and segment_id % 4 <> 0 then 'T' || (segment_id % 5) end as ans from segs),
n as (select *, lag(case when regexp_matches({Q.strip('text')}, '[,;:]$') then ans end) over w as ahead, lead(ans) over w as back from t window w as (partition by book_id, chapter_number order by seg_idx))
select segment_id, case when seg_type = 'dialogue' then coalesce(speaker, ahead, back) else speaker end as speaker from n""")
def tag_answers_spread(spark: SparkSession, sf: str) -> DataFrame:
    s = segments_once(spark, sf, *CHAPTER, "seg_idx", "seg_type", "speaker", F.right(T.strip(F.col("text")), F.lit(1)).alias("text"))  # only how it ends counts
    ans = s.where("seg_type = 'narration' and segment_id % 4 <> 0").select(*CHAPTER, "seg_idx", F.concat(F.lit("T"), (F.col("segment_id") % 5).cast("string")).alias("speaker"), F.lit(0).alias("ord"))
    return A.spread_tag_answers(s, ans, CHAPTER).select("segment_id", "speaker")


@query(f"""with {Q.SEGS}, c as (select *, 'C' || (segment_id % 4) as better, case when segment_id % 6 = 0 then 'said' end as anchor from segs)
select segment_id, case when seg_type = 'dialogue' and anchor is null and segment_id % 3 = 0 and speaker is distinct from better then better else speaker end as speaker, coalesce(seg_type = 'dialogue' and anchor is null and segment_id % 3 = 0 and speaker is distinct from better, false) as corrected from c""")
def critic_corrections(spark: SparkSession, sf: str) -> DataFrame:
    s = segments_once(spark, sf, *CHAPTER, "seg_idx", "seg_type", "speaker").withColumn("anchor", F.when(F.col("segment_id") % 6 == 0, "said"))
    one = s.where("segment_id % 3 = 0").select(*CHAPTER, "seg_idx", F.concat(F.lit("C"), (F.col("segment_id") % 4).cast("string")).alias("speaker"))
    proposed = one.withColumn("ord", F.lit(1)).union(one.withColumn("speaker", F.lit("first")).withColumn("ord", F.lit(0)))
    return A.corrections(s, proposed, CHAPTER).select("segment_id", "speaker", F.coalesce("corrected", F.lit(False)).alias("corrected"))


@query(f"""with {Q.SEGS}, w as (select book_id, chapter_number, seg_idx // 10 as window_id, count(*) filter (seg_type = 'dialogue') as dialogue, case when chapter_number % 4 <> 0 then (seg_idx // 10 + chapter_number) % 5 / 4.0 end as quality from segs group by all)
select book_id, chapter_number, round(coalesce(sum(quality * dialogue) / nullif(sum(case when quality is not null then dialogue end), 0), avg(quality), 1.0), 6)::double as quality from (select book_id, chapter_number, window_id, sum(dialogue) as dialogue, any_value(quality) as quality from w group by all) group by all""")
def critic_quality(spark: SparkSession, sf: str) -> DataFrame:
    w = segments_once(spark, sf, *CHAPTER, "seg_idx", "seg_type").withColumn("window_id", (F.col("seg_idx") / 10).cast("int")).groupBy(*CHAPTER, "window_id").agg(F.count_if(F.col("seg_type") == "dialogue").alias("dialogue"))
    w = w.withColumn("quality", F.when(F.col("chapter_number") % 4 != 0, ((F.col("window_id") + F.col("chapter_number")) % 5) / F.lit(4.0)))
    return A.quality(w, CHAPTER).select(*CHAPTER, F.round("quality", 6).alias("quality"))


@query(f"""with {Q.ROSTER}, i as (select book_id, name, ord, case when ord % 2 = 0 then 'not_a_character' else 'duplicate' end as verdict from people where name is not null)
select book_id, name, arg_min(verdict, ord) as verdict from i group by all""")
def first_verdicts(spark: SparkSession, sf: str) -> DataFrame:
    i = people(spark, sf).where("name is not null").select("book_id", "name", "ord", F.when(F.col("ord") % 2 == 0, "not_a_character").otherwise("duplicate").alias("verdict"), F.lit("").alias("canonical"))
    return O.first_verdicts(i, "book_id").select("book_id", "name", "verdict")


@query(f"""with {Q.ROSTER} select p.book_id, p.name, p.ord from people p where ord >= 5 and name is not null and not exists (select 1 from people q where q.book_id = p.book_id and q.ord < 5 and lower(q.name) = lower(p.name))""")
def new_roster_names(spark: SparkSession, sf: str) -> DataFrame:
    p = people(spark, sf).where("name is not null")
    return O.new_names(p.where("ord < 5"), p.where("ord >= 5"), "book_id").select("book_id", "name", "ord")


@query(f"""with {Q.SEGS}, x as (select book_id, chapter_number, lower(speaker) as low from segs where speaker is not null),
c as (select distinct book_id, chapter_number from x)
select c.book_id, c.chapter_number, list_sort(list_distinct(list(x.low))) as names from c join x on x.book_id = c.book_id and x.chapter_number <= c.chapter_number group by all""")
def protected_names(spark: SparkSession, sf: str) -> DataFrame:
    s = segments_once(spark, sf, *CHAPTER, "speaker").where("speaker is not null").select(*CHAPTER, F.col("speaker").alias("anchor"))
    return O.protected_names(s, CHAPTER)


_STATS = f"""{Q.SEGS}, {Q.CHAPTERS}, {Q.ROSTER},
s as (select book_id, count(*) as total_segments from segs group by all), c as (select book_id, count(*) as total_chapters, coalesce(sum(word_count), 0)::bigint as total_words from chaps group by all), r as (select book_id, count(*) as total_characters from people group by all),
q as (select book_id, avg((chapter_number % 5) / 4.0) as a, min((chapter_number % 5) / 4.0) as m from chaps group by all)"""


@query(f"with {_STATS} select c.book_id, total_chapters, total_words, coalesce(total_segments, 0) as total_segments, coalesce(total_characters, 0) as total_characters, round(coalesce(a, 1.0), 6)::double as avg_confidence, coalesce(m, 1.0)::double as min_confidence from c left join s using (book_id) left join r using (book_id) left join q using (book_id)")
def book_statistics(spark: SparkSession, sf: str) -> DataFrame:
    c = chapters_once(spark, sf)
    q = c.select("book_id", ((F.col("chapter_number") % 5) / F.lit(4.0)).alias("quality"))
    return Z.statistics(segments_once(spark, sf, "book_id"), c, people(spark, sf), q, "book_id").withColumn("avg_confidence", F.round("avg_confidence", 6))


@query(f"""with {_STATS} select distinct b.book_id, (c.total_chapters)::bigint as chapters, true as is_json from books b join c on c.book_id = b.book_id""")
def book_documents(spark: SparkSession, sf: str) -> DataFrame:
    """The finished documents, read back: chapters in each, and whether it is JSON."""
    segs = segments_once(spark, sf).withColumn("pronunciation_hints", F.array().cast("array<string>"))
    c, p = chapters_once(spark, sf), people(spark, sf)
    b = O.latest(table(spark, sf, "books"), "book_id", "ingested_at")
    d = Z.documents(b, c, segs, p, Z.statistics(segs, c, p, None, "book_id"), "book_id")
    # the elements of the document count; where their segments are not those of its statistics, it is not whole
    read = F.from_json("document", "chapters array<struct<processed: struct<segments: array<struct<type: string>>>>>, statistics struct<total_segments: bigint>, processing_config struct<chunk_size: int>")
    told = F.aggregate("r.chapters", F.lit(0).cast("bigint"), lambda n, x: n + F.size(x["processed"]["segments"]))
    whole = F.col("r.processing_config.chunk_size").isNotNull() & (told == F.col("r.statistics.total_segments"))
    return d.select("book_id", read.alias("r")).select("book_id", F.size("r.chapters").cast("bigint").alias("chapters"), F.coalesce(whole, F.lit(False)).alias("is_json"))


@query()
def duplicate_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Every book's roster with the entries of one person folded into one."""
    return O.merged_rosters(people(spark, sf), "book_id")


@query()
def rolling_roster(spark: SparkSession, sf: str) -> DataFrame:
    """The roster of each book after each chapter."""
    p = people(spark, sf).where("name is not null").withColumn("chapter_number", F.coalesce("first_appearance_chapter", F.lit(1))).withColumn("first_appearance_chapter", F.col("chapter_number"))
    said = segments_once(spark, sf, *CHAPTER, "seg_type", "speaker").where("seg_type = 'dialogue' and speaker not in ('Unknown', 'Narrator')").select(*CHAPTER, F.col("speaker").alias("anchor"))
    return O.rolling_rosters(p, said, "book_id")


@query()
def resolved_segments(spark: SparkSession, sf: str) -> DataFrame:
    """The model tier over all books with the rule resolver: windows, requests, answers."""
    from quillspark.operators import segment as G

    s = G.with_neighbours(segments_once(spark, sf).where("text is not null"), CHAPTER)
    asked = A.unresolved(s)
    reqs = R.requests(s, asked, people(spark, sf).where("name is not null"), CHAPTER, "attribute")
    got = A.kept_answers(R.answered(reqs, R.RuleResolver, CHAPTER), asked, CHAPTER)
    return got


