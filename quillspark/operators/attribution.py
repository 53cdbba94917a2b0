"""Who speaks: tags beside quotations, names in tags, and what passes of a resolver answer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quillspark.functions import patterns as P
from quillspark.functions import text as T

SHORTEST_MENTION = 3


def alias_map(roster: DataFrame, key: str) -> DataFrame:
    """(key, alias, canonical, ord): lower-case names and aliases; of repeated ones the last entry's counts."""
    named = roster.select(key, "ord", F.lit(-1).alias("k"), F.lower("name").alias("alias"), F.col("name").alias("canonical"))
    listed = roster.select(key, "ord", F.posexplode("aliases").alias("k", "a"), F.col("name").alias("canonical")).select(key, "ord", "k", F.lower("a").alias("alias"), "canonical")
    both = named.unionByName(listed).where("alias is not null and canonical is not null")
    return both.groupBy(key, "alias").agg(F.max_by("canonical", F.struct("ord", "k")).alias("canonical"), F.min("ord").alias("ord"))


def map_of_aliases(aliases: DataFrame, key: str) -> DataFrame:
    """(key, amap): one book's aliases as a map, for use inside row expressions. A roster is small."""
    return aliases.groupBy(key).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("alias", "canonical")))).alias("amap"))


def mentioned(x: Column, amap: Column) -> Column:
    """The canonical names whose aliases the text holds, the longest alias first."""
    hits = F.filter(F.map_entries(amap), lambda e: (F.length(e["key"]) >= SHORTEST_MENTION) & T.mentions(x, e["key"]))
    ranked = F.array_sort(F.transform(hits, lambda e: F.struct((-F.length(e["key"])).alias("n"), e["value"].alias("c"))))
    return F.array_distinct(F.transform(ranked, lambda s: s["c"]))


def tag_speaker(x: Column, amap: Column) -> Column:
    """The speaker a tag's sentence names, or null.

    A name right after the verb counts even if unknown; before the verb, or alone in the
    sentence, only a known one does.
    """
    after = F.nullif(F.regexp_extract(x, P.VERB_NAME, 1), F.lit(""))
    before = F.lower(F.nullif(F.regexp_extract(x, P.NAME_VERB, 1), F.lit("")))
    m = mentioned(x, amap)
    return F.coalesce(F.try_element_at(amap, F.lower(after)), after, F.try_element_at(amap, before), F.when(F.size(m) == 1, F.get(m, 0)))


def anchors(segs: DataFrame, key: list[str]) -> DataFrame:
    """Dialogue segments whose speaker a tag beside them names: ``segs`` with ``anchor``.

    ``segs`` has seg_idx, seg_type, text and amap. A tag names the speech before it by its
    first sentence, and the speech after it by its last if it ends with a comma, semicolon or
    colon. Where both speak, the tag after the speech counts.
    """
    s = T.tag_sentences(F.col("text"))
    amap = F.coalesce("amap", F.expr("cast(map() as map<string, string>)"))
    tagged = segs.withColumn("ss", F.when(T.is_tag(F.col("seg_type"), F.col("text")), s))
    first, last = F.get("ss", 0), F.try_element_at("ss", F.lit(-1))
    back = F.when(T.leads_with_speech(first), tag_speaker(first, amap))
    ahead = F.when(T.leads_with_speech(last) & T.strip(F.col("text")).rlike("[,;:]$"), tag_speaker(last, amap))
    w = Window.partitionBy(*key).orderBy("seg_idx")
    named = tagged.withColumn("back", back).withColumn("ahead", ahead)
    return named.withColumn("anchor", F.when(F.col("seg_type") == "dialogue", F.coalesce(F.lead("back").over(w), F.lag("ahead").over(w)))).drop("ss", "back", "ahead")


def nameless_tags(segs: DataFrame) -> DataFrame:
    """Tags that name no known character; ``segs`` has amap."""
    amap = F.coalesce("amap", F.expr("cast(map() as map<string, string>)"))
    return segs.where(T.is_tag(F.col("seg_type"), F.col("text")) & (F.size(mentioned(F.col("text"), amap)) == 0))


def unresolved(segs: DataFrame) -> DataFrame:
    """Dialogue without a speaker."""
    return segs.where((F.col("seg_type") == "dialogue") & (F.coalesce("speaker", F.lit("")) == ""))


def spread_tag_answers(segs: DataFrame, answers: DataFrame, key: list[str]) -> DataFrame:
    """Speakers of nameless tags handed to the speeches beside them; only empty speakers are filled.

    The speech before a tag always gets its speaker, the one after if the tag ends with a comma,
    semicolon or colon. The tag that stands earlier writes first.
    """
    known = answers.where("coalesce(speaker, '') not in ('', 'Unknown')").groupBy(*key, "seg_idx").agg(F.max_by("speaker", "ord").alias("answer"))
    w = Window.partitionBy(*key).orderBy("seg_idx")
    joined = segs.join(known, [*key, "seg_idx"], "left")
    ahead = F.when(T.strip(F.col("text")).rlike("[,;:]$"), F.col("answer"))
    told = joined.withColumn("ahead", ahead).withColumn("told", F.coalesce(F.lag("ahead").over(w), F.lead("answer").over(w)))
    mine = F.nullif(F.coalesce("speaker", F.lit("")), F.lit(""))
    return told.withColumn("speaker", F.when(F.col("seg_type") == "dialogue", F.coalesce(mine, "told")).otherwise(F.col("speaker"))).drop("answer", "ahead", "told")


def kept_answers(answers: DataFrame, flagged: DataFrame, key: list[str]) -> DataFrame:
    """Of a resolver's answers those on flagged segments with a speaker; of repeated ones the last."""
    asked = answers.join(flagged.select(*key, "seg_idx").distinct(), [*key, "seg_idx"], "left_semi")
    return asked.where("coalesce(speaker, '') <> ''").groupBy(*key, "seg_idx").agg(F.max_by("speaker", "ord").alias("speaker"))


def reconcile(a: DataFrame, b: DataFrame, c: DataFrame, asked: DataFrame, key: list[str]) -> DataFrame:
    """Speakers from two independent passes, and a third where they differ: (key, seg_idx, speaker, disputed)."""
    on = [*key, "seg_idx"]
    rows = asked.select(*on).distinct()
    for name, df in (("a", a), ("b", b), ("c", c)):
        rows = rows.join(df.select(*on, F.col("speaker").alias(name)), on, "left")
    disputed = F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b"))
    speaker = F.when(disputed, F.coalesce("c", F.lit("Unknown"))).otherwise(F.coalesce("a", "b", F.lit("Unknown")))
    return rows.select(*on, speaker.alias("speaker"), F.coalesce(disputed, F.lit(False)).alias("disputed"))


def corrections(segs: DataFrame, proposed: DataFrame, key: list[str]) -> DataFrame:
    """``segs`` (with anchor) after a critic's corrections: dialogue only, never a named anchor, never no change.

    Of repeated corrections of a segment the last counts.
    """
    on = [*key, "seg_idx"]
    last = proposed.where("coalesce(speaker, '') <> ''").groupBy(*on).agg(F.max_by("speaker", "ord").alias("better"))
    may = (F.col("seg_type") == "dialogue") & F.col("anchor").isNull() & F.col("better").isNotNull() & ~F.col("better").eqNullSafe(F.col("speaker"))
    joined = segs.join(last, on, "left")
    return joined.withColumn("corrected", may).withColumn("speaker", F.when(may, F.col("better")).otherwise(F.col("speaker"))).drop("better")


def quality(windows: DataFrame, key: list[str]) -> DataFrame:
    """(key, quality): window qualities weighted by the dialogue they judge; plain mean if none; 1.0 if no window answered."""
    weighted = F.sum(F.col("quality") * F.col("dialogue")) / F.nullif(F.sum(F.when(F.col("quality").isNotNull(), F.col("dialogue"))), F.lit(0))
    return windows.groupBy(*key).agg(F.coalesce(weighted, F.avg("quality"), F.lit(1.0)).alias("quality"))
