"""From book texts to one document per book: the stages as tables.

Chapters of all books are found, cut and attributed together. What depends on the order of
chapters is the roster; it is folded per book, and a chapter is attributed with the roster as it
stands after that chapter, so no name from a later one gets in. With a critic the chapters of a book would
have to wait for each other; here the critic judges all chapters at once, its objections are
applied in reading order to the last roster, and its corrections to the segments.

A stage is a table for one set of books; another book, or another text of one, makes another set.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quillspark.functions import text as T
from quillspark.operators import assemble as Z
from quillspark.operators import attribution as A
from quillspark.operators import resolver as R
from quillspark.operators import roster as O
from quillspark.operators import segment as G
from quillspark.operators import structure as S
from quillspark.operators import windows as W
from quillspark.plans.config import Config
from quillspark.sources import books as B
from quillspark.storage import materialize

KEY = ["book_id", "chapter_number"]
EMPTY_ROSTER = "book_id string, chapter_number int, ord int, name string, aliases array<string>, pronunciation_hints array<string>, first_appearance_chapter int"


def discover(texts: DataFrame, config: Config, factory: Callable[[], R.Resolver] | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Lines, metadata and chapters of books (book_id, text)."""
    lines = S.explode_lines(texts, "book_id")
    bounds = S.body_bounds(lines, "book_id")
    pre = lines.join(bounds, "book_id").where("line_idx < body_start").groupBy("book_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_idx", "line"))), lambda x: x["line"]), "\n").alias("pre"))
    meta = texts.select("book_id").join(pre, "book_id", "left").select("book_id", *S.preamble_metadata(F.coalesce("pre", F.lit(""))))
    heads = S.chapters(lines, "book_id", config.include_back_matter)
    first = S.unlabeled_first_chapter(lines, "book_id").join(bounds, "book_id").select("book_id", F.lit(0).alias("number"), F.lit("Chapter I").alias("title"), F.lit("body").alias("kind"), (F.col("start_line") + F.col("body_start")).alias("start_line"), F.col("body_end"))
    ends = heads.groupBy("book_id").agg((F.min("start_line") - 1).alias("end_line"))
    first = first.join(ends, "book_id", "left").withColumn("end_line", F.coalesce("end_line", "body_end")).drop("body_end")
    both = heads.unionByName(first)
    if factory is not None:
        # where headings give fewer than two chapters, what a model proposes takes their place
        few = bounds.select("book_id").join(both.groupBy("book_id").count().where("count >= 2").select("book_id"), "book_id", "left_anti")
        body = S.body_lines(lines, "book_id").join(few, "book_id", "left_semi")
        sizes = bounds.select("book_id", "body_start", "body_end", (F.col("body_end") - F.col("body_start")).alias("n"))
        proposed = R.proposed_chapters(body, factory, "book_id").join(sizes, "book_id")
        valid = S.validated_chapters(proposed, "book_id", F.col("n"), config.include_front_matter, config.include_back_matter).join(sizes, "book_id")
        nxt = F.lead("start_line").over(Window.partitionBy("book_id").orderBy("number"))
        model = valid.select("book_id", "number", "title", "kind", (F.col("start_line") + F.col("body_start")).alias("start_line"), (F.coalesce(nxt - 1, F.col("n")) + F.col("body_start")).cast("int").alias("end_line"))
        both = both.join(model.select("book_id").distinct(), "book_id", "left_anti").unionByName(model)
    # a book in which nothing was found is one chapter
    whole = bounds.join(both.select("book_id").distinct(), "book_id", "left_anti").select("book_id", F.lit(0).alias("number"), F.lit("Chapter 1").alias("title"), F.lit("body").alias("kind"), (F.col("body_start") + 1).alias("start_line"), F.col("body_end").alias("end_line"))
    numbered = both.unionByName(whole).withColumn("number", F.row_number().over(Window.partitionBy("book_id").orderBy("number")))
    return lines, meta, numbered


def discovered_characters(texts: DataFrame, factory: Callable[[], R.Resolver], retries: int) -> DataFrame:
    """Characters a resolver finds in the windows of each chapter; a window without an answer finds none."""
    windows = W.discovery_windows(texts.withColumn("k", F.struct(*KEY)), "k").select("k.*", "window_id", "text")

    def run(frames):  # noqa: ANN001, ANN202
        import pandas as pd

        resolver = factory()
        for pdf in frames:
            out = []
            for r in pdf.itertuples():
                for _ in range(max(1, retries)):
                    try:
                        got = R.parsed_answer(resolver.resolve(R.SYSTEM["discover"], r.text, None))
                    except R.ResolverError:
                        continue
                    for i, c in enumerate(got.get("characters") or []):
                        if isinstance(c, dict) and c.get("name"):
                            out.append((r.book_id, r.chapter_number, r.window_id * 10_000 + i, c["name"], list(c.get("aliases") or []), list(c.get("pronunciation_hints") or []), r.chapter_number))
                    break
            yield pd.DataFrame(out, columns=["book_id", "chapter_number", "ord", "name", "aliases", "pronunciation_hints", "first_appearance_chapter"])

    found = windows.mapInPandas(run, EMPTY_ROSTER)
    return found.where(~T.is_placeholder(F.col("name")))


def attribute(segs: DataFrame, roster: DataFrame, factory: Callable[[], R.Resolver] | None, config: Config, validator: Callable[[], R.Resolver] | None = None) -> DataFrame:
    """Speakers: tags first, then the passes of a resolver where one is given; the rest is ``Unknown``.

    The blind pass and the tie-break ask the validator, by default the same resolver. A roster with
    chapter_number is the one that counts in that chapter.
    """
    validator = validator or factory
    on = [k for k in KEY if k in roster.columns]
    keyed = roster.withColumn("_at", F.struct(*on))
    amap = A.map_of_aliases(A.alias_map(keyed, "_at"), "_at").select("_at.*", "amap")
    said = materialize(A.anchors(segs.join(amap, on, "left"), KEY).withColumn("speaker", F.col("anchor")), "anchored")
    if factory is not None:
        missed = O.missed_names(said.withColumn("_at", F.struct(*on)), keyed, "_at").select("_at.*", F.lit(1_000_000).alias("ord"), "name")
        names = materialize(roster.where("name is not null").select(*on, "ord", "name").unionByName(missed), "names")
        told = G.with_neighbours(said, KEY)
        tags = A.nameless_tags(told)
        answers = R.answered(R.requests(told, tags, names, KEY, "tags", config.chunk_size), factory, KEY, config.max_retries)
        told = materialize(A.spread_tag_answers(told, A.kept_answers(answers, tags, KEY).withColumn("ord", F.lit(0)), KEY), "tagged")
        asked = A.unresolved(told)
        # a pass is asked once: its answers are a table before anything is compared
        ask = lambda kind, rows, by: materialize(A.kept_answers(R.answered(R.requests(told, rows, names, KEY, kind, config.chunk_size), by, KEY, config.max_retries), rows, KEY), kind)
        a, b = ask("attribute", asked, factory), ask("verify", asked, validator)
        differ = a.alias("a").join(b.alias("b"), [*KEY, "seg_idx"]).where("a.speaker <> b.speaker").select(*KEY, "seg_idx")
        settled = A.reconcile(a, b, ask("settle", differ, validator), asked, KEY).select(*KEY, "seg_idx", F.col("speaker").alias("settled"))
        said = told.join(settled, [*KEY, "seg_idx"], "left").withColumn("speaker", F.coalesce(F.nullif("speaker", F.lit("")), "settled")).drop("settled", "new_para")
    return said.withColumn("speaker", F.when(F.col("seg_type") == "dialogue", F.coalesce("speaker", F.lit("Unknown")))).drop("amap")


def rosters_by_chapter(rolling: DataFrame, chapters: DataFrame) -> DataFrame:
    """The roster as it stands after each of ``chapters`` (book_id, chapter_number): of the last chapter, up to that one, that changed it."""
    states = rolling.select(*KEY, F.col("chapter_number").alias("state")).distinct()
    asked = chapters.select(*KEY).distinct().withColumn("state", F.lit(None).cast("int"))
    so_far = Window.partitionBy("book_id").orderBy("chapter_number").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    at = states.unionByName(asked).withColumn("state", F.max("state").over(so_far)).where("state is not null").select(*KEY, "state").distinct()
    entries = rolling.withColumnRenamed("chapter_number", "state")
    return at.join(entries, ["book_id", "state"]).drop("state").join(asked.select(*KEY), KEY, "left_semi")


def run(texts: DataFrame, config: Config, factory: Callable[[], R.Resolver] | None = None, validator: Callable[[], R.Resolver] | None = None) -> DataFrame:
    """(book_id, document) of books (book_id, text); the validator, by default the same resolver, checks speakers and is the critic."""
    spark = texts.sparkSession
    validator = validator or factory

    # the stages of a run are those of its books as they are now; what a run over some chapters computes is never taken for the whole book
    books = texts.agg(F.coalesce(F.sum(F.xxhash64("book_id", "text").cast("decimal(38,0)")), F.lit(0)).cast("string")).first()[0]
    some = f"-chapters-{'-'.join(map(str, sorted(config.chapters_only)))}" if config.chapters_only else ""

    def stage(n: int, name: str, df: DataFrame) -> DataFrame:
        path = f"{config.stage_path(n)}/{name}{some if n > 2 else ''}/books={books.replace('-', 'm')}"
        if config.must_run(n, B.stage_complete(spark, path)):
            B.write_stage(df, path)
        return spark.read.schema(df.schema).parquet(path)

    lines, meta, heads = discover(texts, config, factory)
    meta, heads = stage(2, "metadata", meta), stage(2, "chapters", heads)
    if config.chapters_only:
        heads = heads.where(F.col("number").isin(config.chapters_only))
    body = stage(3, "texts", S.chapter_texts(lines, heads, "book_id").withColumnRenamed("number", "chapter_number")).where(T.strip(F.col("text")) != "")
    found = discovered_characters(body.select(*KEY, "text"), factory, config.max_retries) if factory else spark.createDataFrame([], EMPTY_ROSTER)
    found = stage(4, "found", found)
    segs = materialize(G.segments(body.withColumn("k", F.struct(*KEY)).select("k", "text"), "k").select("k.*", "seg_idx", "para", "seg_type", "text", "notes"), "segments")
    first = A.anchors(segs.withColumn("amap", F.expr("cast(map() as map<string, string>)")), KEY)
    rolling = stage(5, "rosters", O.rolling_rosters(found, first, "book_id"))
    last = rolling.groupBy("book_id").agg(F.max("chapter_number").alias("chapter_number"))
    roster = rolling.join(last, KEY, "left_semi")
    done = stage(5, "segments", attribute(segs, rosters_by_chapter(rolling, segs), factory, config, validator).withColumn("pronunciation_hints", F.array().cast("array<string>")))
    quality = None
    if factory is not None and not config.no_critic:
        # the critic reads finished chapters; named tags outrank it
        s = G.with_neighbours(done, KEY)
        reqs = R.requests(s, s, roster.select("book_id", "ord", "name"), KEY, "critic", config.chunk_size)
        said = stage(6, "critic", R.critiques(reqs, validator, KEY))
        better, issues, quality = R.judged(s, said, KEY, config.chunk_size)
        done = materialize(A.corrections(done, better, KEY), "corrected")
        kept = first.where("anchor is not null").groupBy("book_id").agg(F.collect_set(F.lower("anchor")).alias("names"))
        roster = O.objected(roster, issues.select("book_id", "name", "verdict", "canonical", F.struct("chapter_number", "ord").alias("ord")), kept, "book_id")
        roster = materialize(roster, "objected")
        stage(6, "checks", O.chapter_checks(done, roster, KEY))
    final = O.merged_rosters(roster, "book_id")
    finished = Z.remapped_speakers(done, A.alias_map(final, "book_id"), "book_id")
    chaps = heads.join(body.select("book_id", F.col("chapter_number").alias("number"), "word_count"), ["book_id", "number"]).select("book_id", F.col("number").alias("chapter_number"), "title", "word_count", F.col("title").alias("start_marker"))
    stats = Z.statistics(finished, chaps, final, quality, "book_id")
    plain = lambda c: F.coalesce(c, F.lit("")).alias(c)
    shown = meta.select("book_id", plain("title"), plain("author"), F.col("language").alias("book_lang"), F.col("book_id").alias("gutenberg_id"), plain("release_date"), plain("credits"))
    return Z.documents(shown, chaps, finished, final, stats, "book_id", config.processing_config())


def factories(config: Config) -> tuple[Callable[[], R.Resolver] | None, Callable[[], R.Resolver] | None]:
    """What makes the resolvers of the processing and of the validation model; none without a processing model."""
    if not config.processing_model:
        return None, None
    of = lambda model: lambda: R.HttpResolver(config.base_url, model, config.api_key)
    return of(config.processing_model), of(config.validation_model)


def main(argv: list[str] | None = None) -> int:
    """Command line: a folder of books in, one line of JSON per book out."""
    from quillspark.plans.cli import parsed_arguments

    try:
        config, source = parsed_arguments(argv)
    except ValueError:
        return 1
    spark = SparkSession.builder.appName("quillspark").getOrCreate()
    try:
        texts = B.read_books(spark, source)
        B.write_documents(run(texts, config, *factories(config)), config.output_file or f"{config.stage_path(7)}/{Z.output_name(config.book_id or 'books', config.chapters_only)}")
    except KeyboardInterrupt:
        return 130
    except Exception as e:
        print(f"failed: {e}")
        return 1
    return 0
