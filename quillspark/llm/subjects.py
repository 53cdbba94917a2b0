"""Problem 8: the subjects of each document, by clusters.

Documents become normalised TF-IDF vectors (each term is added to or taken from ``PLACES`` of
``FEATURES`` places by its hash; document frequencies are counted by ``BUCKETS`` of hashes) and are
clustered by bisecting k-means into up to ``LEAVES`` leaves, enough that languages,
subjects and their pairs need not share one. A leaf is labelled by its discriminative
terms, those that are more frequent in it than in the corpus: where they are terms of the
labelled examples they vote for the examples' subjects, and the votes are the leaf's mixture
of subjects. Through the leaves the labels reach the terms that no example has: a term
stands for a subject if it sets some leaf apart and the leaves in which it occurs have
that subject; words of the narrative occur in the leaves of every subject and stand for
none.

A document is a mixture too. Its sentences are placed one by one: a sentence belongs to
the leaves' subject whose discriminative terms it holds (two or more, and more than of
any other), or to none. The shares of its sentences are its weights, and it has the
subjects with a weight of an eighth or more. All counts run over all documents and all their
sentences; only the labelled examples are bounded (``EXAMPLES_BOUND``).

Defined results: null, empty and blank texts have no subject; repeated rows repeat no
result; a document may have no subject, one or several; a document with text always has a row
in the mixtures, with a null subject where no sentence treats any.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quillspark.llm.canonical import canonical_texts
from quillspark.llm.sentences import plain_sentences
from quillspark.llm.tables import slices, table
from quillspark.storage import materialize

#: Share of a document's sentences from which it has a subject.
LEAST_SHARE = 1 / 8
#: Leaves of the clustering, places of its vectors, and buckets of document frequencies.
LEAVES, FEATURES, BUCKETS = 1024, 256, 1 << 16
#: Places that a term has in a vector.
PLACES = 4
#: A cluster of fewer documents is not divided.
LEAST_LEAF = 20
#: A term sets a leaf apart if so many of its documents have it, this many times the corpus' rate.
APART_DOCUMENTS, APART_LIFT = 3, 1.5
#: Share of a leaf's votes from which a subject is in its mixture.
LEAF_SHARE = 0.3
#: A term stands for a subject from this share of its occurrences by leaf, in at least so many documents.
TERM_SHARE, TERM_DOCUMENTS = 0.4, 4
#: The share must also exceed the subject's share of all terms by this much.
OVER_BASE = 0.25
#: Labelled examples to fit on; more are left out by the order of their ids.
EXAMPLES_BOUND = 20_000
#: Terms up to which the lexicon is sent to every task; beyond, it is joined, with the same result.
LEXICON_BOUND = 300_000

_TERM = re.compile(r"[^\W\d_㐀-鿿豈-\ufaff]{2,}|[㐀-鿿豈-\ufaff]+")


def _han(ch: str) -> bool:
    return "\u3400" <= ch <= "\u9fff" or "\uf900" <= ch <= "\ufaff"


def terms_of(text: str, breaks: frozenset[str] = frozenset()) -> list[str]:
    """Words of a text; of stretches of ideographs the pairs of neighbours, where ``breaks`` end a stretch."""
    out = []
    for t in _TERM.findall(text.lower()):
        if not _han(t[0]):
            out.append(t)
            continue
        for run in re.split(f"[{''.join(sorted(breaks))}]", t) if breaks else [t]:
            out += [run[i : i + 2] for i in range(len(run) - 1)] or ([run] if run else [])
    return out


def common_ideographs(examples: list[tuple[str, str]], most: int = 3) -> frozenset[str]:
    """Ideographs that occur in the examples of more than ``most`` subjects: they are the language's, not a subject's."""
    seen: dict[str, set] = defaultdict(set)
    for subject, text in examples:
        for ch in set(text):
            if _han(ch):
                seen[ch].add(subject)
    return frozenset(ch for ch, s in seen.items() if len(s) > most)


def _sentence_batches(batches: Iterator[pa.RecordBatch], breaks: frozenset[str]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.list_(pa.string()))
    for b in slices(batches):
        texts = b.column(1).to_pylist()
        out = []
        for raw, form in zip(texts, canonical_texts(texts)):
            out.append([terms_of(form[s:e], breaks) for s, e in plain_sentences(form)] if raw and form and not form.isspace() else [])
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, kind)], ["doc_id", "sentences"])


def sentence_terms(documents: DataFrame, breaks: frozenset[str] = frozenset()) -> DataFrame:
    """(doc_id, sentences): the terms of each sentence of each document, in order."""
    rows = documents.where("text is not null").select("doc_id", "text")
    return rows.mapInArrow(lambda it: _sentence_batches(it, breaks), "doc_id bigint, sentences array<array<string>>")


def labelled(examples: DataFrame) -> list[tuple[str, str]]:
    """(subject, text) of at most EXAMPLES_BOUND labelled examples."""
    rows = examples.where("text is not null and subject is not null").orderBy("example_id").limit(EXAMPLES_BOUND).select("subject", "text").collect()
    return [(r["subject"], canonical_texts([r["text"]])[0]) for r in rows]


def example_lexicon(examples: list[tuple[str, str]], breaks: frozenset[str] = frozenset()) -> dict[str, str]:
    """Terms that occur, and more than once, in the examples of (nearly) one subject only."""
    seen: dict[str, Counter] = defaultdict(Counter)
    times: Counter = Counter()
    for subject, text in examples:
        terms = Counter(terms_of(text, breaks))
        times += terms
        for t in terms:
            seen[t][subject] += 1
    return {t: c.most_common(1)[0][0] for t, c in seen.items() if times[t] > 1 and c.most_common(1)[0][1] >= 0.75 * c.total()}


def _lexicons(b: pa.RecordBatch, lexicon: dict[str, str] | None) -> Iterator[dict[str, str]]:
    """The lexicon of each row: the same for all, or the row's own entries."""
    if lexicon is not None:
        yield from (lexicon for _ in range(b.num_rows))
    else:
        for x in b.column(3).to_pylist():
            yield {e["term"]: e["subject"] for e in x or []}


def _codes(sentences: list[list[list[str]] | None], known: dict[str, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, hash, occurrences) of every term of every document."""
    if len(known) > 200_000:
        known.clear()
    row, code, times = [], [], []
    for i, doc in enumerate(sentences):
        counts = Counter(t for s in doc or [] for t in s)
        row += [i] * len(counts)
        code += [known[t] if t in known else known.setdefault(t, xxhash.xxh3_64_intdigest(t)) for t in counts]
        times += counts.values()
    return np.array(row, np.int64), np.array(code, np.uint64), np.array(times, float)


def _frequency_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (bucket, n): in how many documents of the task the terms of each bucket occur; bucket -1 counts documents."""
    known: dict[str, int] = {}
    n, docs = np.zeros(BUCKETS, np.int64), 0
    for b in slices(batches):
        _, code, _ = _codes(b.column(0).to_pylist(), known)
        n += np.bincount((code % np.uint64(BUCKETS)).astype(np.int64), minlength=BUCKETS)
        docs += b.num_rows
    at = np.flatnonzero(n)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1).astype(np.int32)), pa.array(np.append(n[at], docs))], ["bucket", "n"])


def _vector_batches(batches: Iterator[pa.RecordBatch], idf: np.ndarray, features: int) -> Iterator[pa.RecordBatch]:
    known: dict[str, int] = {}
    for b in slices(batches):
        row, code, times = _codes(b.column(1).to_pylist(), known)
        x = np.zeros((b.num_rows, features))
        weight = times * idf[(code % np.uint64(len(idf))).astype(np.int64)]
        for k in range(PLACES):
            sign = np.where(code >> np.uint64(63 - k) & np.uint64(1), 1.0, -1.0)
            place = (code >> np.uint64(11 * k) & np.uint64(0x7FFF)) % np.uint64(features)
            np.add.at(x, (row, place.astype(np.int64)), sign * weight)
        x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(b.num_rows + 1, dtype=np.int32) * features), pa.array(x.ravel()))
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), lists], ["doc_id", "sentences", "x"])


def clustered(sentences: DataFrame, leaves: int, features: int) -> DataFrame:
    """(row, doc_id, sentences, leaf) of the documents with text."""
    from pyspark.ml.clustering import BisectingKMeans
    from pyspark.ml.functions import array_to_vector

    docs = materialize(sentences.where(F.size("sentences") > 0), "p8-sentences")
    counts = docs.select("sentences").mapInArrow(_frequency_batches, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()  # BUCKETS rows at most
    n = counts[counts.bucket < 0].n.sum()
    if not n:
        return docs.select(F.lit(0).cast("bigint").alias("row"), "doc_id", "sentences", F.lit(0).alias("leaf"))
    seen = np.zeros(BUCKETS)
    at = counts[counts.bucket >= 0]
    seen[at.bucket] = at.n
    idf = np.where(seen > 1, np.log((n + 1) / (np.minimum(seen, n) + 1)), 0.0)
    vectors = docs.mapInArrow(lambda it: _vector_batches(it, idf, features), "doc_id bigint, sentences array<array<string>>, x array<double>")
    vectors = materialize(vectors.withColumn("row", F.monotonically_increasing_id()), "p8-vectors").withColumn("features", array_to_vector("x"))
    # the fit reads nothing but the vectors and keeps them while it lasts
    model = BisectingKMeans(k=leaves, maxIter=5, seed=42, minDivisibleClusterSize=LEAST_LEAF, featuresCol="features", predictionCol="leaf").fit(vectors.select("features"))
    return materialize(model.transform(vectors).select("row", "doc_id", "sentences", "leaf"), "p8-leaves")


def leaf_lexicon(placed: DataFrame, examples: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(leaf, subject, weight), the labels of the leaves, and (term, subject), what their terms stand for.

    ``examples`` are (term, subject) to vote with.
    """
    counts = materialize(placed.select("leaf", F.explode(F.array_distinct(F.flatten("sentences"))).alias("term")).groupBy("leaf", "term").agg(F.count("*").alias("n")), "p8-counts")
    sizes = placed.groupBy("leaf").agg(F.count("*").alias("size"))
    corpus = counts.groupBy("term").agg(F.sum("n").alias("all_n"))
    everything = sizes.agg(F.sum("size").alias("all_size"))
    rated = counts.join(corpus, "term").join(sizes, "leaf").crossJoin(F.broadcast(everything))  # one row
    rated = materialize(rated.withColumn("lift", F.col("n") * F.col("all_size") / (F.col("size") * F.col("all_n"))).select("leaf", "term", "n", "all_n", "size", "lift", ((F.col("n") >= APART_DOCUMENTS) & (F.col("lift") > APART_LIFT)).alias("apart")), "p8-rated")
    votes = rated.where("apart").join(examples, "term").groupBy("leaf", "subject").agg(F.sum(F.col("n") / F.col("size") * F.log2("lift")).alias("votes"))
    own = Window.partitionBy("leaf")
    strong = votes.withColumn("share", F.col("votes") / F.sum("votes").over(own)).where(F.col("share") >= LEAF_SHARE)
    labels = materialize(strong.select("leaf", "subject", (F.col("share") / F.sum("share").over(own)).alias("weight")), "p8-labels")

    told = rated.join(labels, "leaf")
    by_subject = told.groupBy("term", "subject").agg(F.sum(F.col("n") * F.col("weight")).alias("s"))
    base = told.groupBy("subject").agg(F.sum(F.col("n") * F.col("weight")).alias("b")).withColumn("base", F.col("b") / F.sum("b").over(Window.partitionBy(F.lit(0)))).select("subject", "base")
    best = by_subject.groupBy("term").agg(F.max_by(F.struct("subject", "s"), F.struct("s", "subject")).alias("best")).select("term", "best.subject", "best.s")
    facts = rated.groupBy("term").agg(F.max("apart").alias("apart"), F.any_value("all_n").alias("all_n")).where(F.col("apart") & (F.col("all_n") >= TERM_DOCUMENTS))
    stands = best.join(facts, "term").join(base, "subject").where(F.col("s") >= F.greatest(F.lit(TERM_SHARE), F.col("base") + OVER_BASE) * F.col("all_n"))
    return labels, materialize(stands.select("term", "subject"), "p8-lexicon")


def _with_lexicon(docs: DataFrame, lexicon: DataFrame, bound: int) -> tuple[DataFrame, dict[str, str] | None]:
    """The documents, and the lexicon as a dictionary where its size, which is counted, allows; else joined to the rows."""
    if lexicon.count() <= bound:
        return docs.select("doc_id", "sentences", "leaf"), {r["term"]: r["subject"] for r in lexicon.collect()}
    terms = docs.select("row", F.explode(F.array_distinct(F.flatten("sentences"))).alias("term")).join(lexicon, "term")
    own = terms.groupBy("row").agg(F.collect_list(F.struct("term", "subject")).alias("entries"))
    return docs.join(own, "row", "left").select("doc_id", "sentences", "leaf", "entries"), None


_MIXTURE = "doc_id bigint, leaf int, subject string, weight double"


def _mix_batches(batches: Iterator[pa.RecordBatch], lexicon: dict[str, str] | None) -> Iterator[pa.RecordBatch]:
    for b in slices(batches):
        rows: list[tuple] = []
        for doc, sentences, leaf, lex in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), _lexicons(b, lexicon)):
            treats: Counter = Counter()
            for s in sentences or []:
                hits = Counter(x for t in s if (x := lex.get(t)))
                if hits:
                    (first, most), *rest = hits.most_common(2)
                    if most >= 2 and (not rest or rest[0][1] < most):
                        treats[first] += 1
            rows += [(doc, leaf, subject, k / len(sentences)) for subject, k in treats.items()] or [(doc, leaf, None, 0.0)]
        columns = list(zip(*rows)) or [[], [], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.string(), pa.float64()))], ["doc_id", "leaf", "subject", "weight"])


def subject_mixtures(documents: DataFrame, examples: DataFrame, subjects: DataFrame, leaves: int = LEAVES, features: int = FEATURES, lexicon_bound: int = LEXICON_BOUND) -> DataFrame:
    """(doc_id, leaf, subject, weight): each document's leaf, and its mixture of subjects by its sentences.

    A document without a subject has one row with a null subject and weight 0.
    """
    spark = documents.sparkSession
    known = labelled(examples)
    breaks = common_ideographs(known)
    placed = clustered(sentence_terms(documents, breaks), leaves, features)
    start = spark.createDataFrame(list(example_lexicon(known, breaks).items()), "term string, subject string")
    _, lexicon = leaf_lexicon(placed, start.join(subjects.select("subject").distinct(), "subject", "left_semi"))
    rows, own = _with_lexicon(placed, lexicon, lexicon_bound)
    return rows.mapInArrow(lambda it: _mix_batches(it, own), _MIXTURE)


def document_subjects(documents: DataFrame, examples: DataFrame, subjects: DataFrame, **how: int) -> DataFrame:
    """(doc_id, subject) of the subjects that are at least an eighth of a document's mixture."""
    return subject_mixtures(documents, examples, subjects, **how).where(F.col("subject").isNotNull() & (F.col("weight") >= LEAST_SHARE)).select("doc_id", "subject").distinct()


def _tables(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    return [table(spark, sf_dir, t) for t in ("documents", "subject_examples", "subjects")]


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every subject that at least an eighth of a document's sentences treat."""
    return document_subjects(*_tables(spark, sf_dir))


def p8_mixtures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The leaf and the mixture of subjects of every document with text."""
    return subject_mixtures(*_tables(spark, sf_dir))
