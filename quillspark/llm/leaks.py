"""Problem 7: held-out passages that leaked into the training text.

Documents and passages become sequences of words in one consistent form (case,
punctuation, layout marks, hyphens at line ends and the way characters are stored
are gone). Every window of ``LEAST_WORDS`` words that could hold a leak is embedded
by random walks (CGK): a walk reads the window word by word and stays on a word or
moves on by a random bit of (step, word), so windows at a small edit distance give
walks at a small Hamming distance, also after an inserted or a missing word. Each
walk is sampled at some steps; the sampled words are a hash key. ``WALKS`` x
``SAMPLES`` keys per window bring the recall of windows with two changed words
near 1 (the README has the measured figure). The window is the least part of an item that counts,
so one length serves items of every length. Windows that share a key with a window of a passage are candidates, and
each is verified exactly along its diagonal: a run of at least ``LEAST_WORDS`` words,
the first and the last in common, of which at most one in eight differs, across one gap (an unknown layout mark, a
missing word) if need be.

A window without a gap can only hold a leak if all but two of its words occur in passages, so
other windows are not embedded. A run across a gap (a layout mark of up to ``GAP`` words that no passage
has) may have no such window; it is found by
seeds: it always has two stretches of ``SEED`` words in common with the passage (14 words in
three pieces are the fewest), so passages with two such stretches are candidates too.

The passages are a fixed small table. Their index goes to the tasks only when it has
at most ``INDEX_BOUND`` keys, which are counted; every document is then one pass
without a shuffle. Beyond the bound the keys of both sides meet in a shuffled and salted join
and the candidates are verified in a second pass; what goes to the tasks then is a bitmap of
``BITMAP`` bits of the passages' words, by which windows are left out. Both ways use the same
word codes, keys and check.

Defined results: null, empty and short texts leak nothing, nor do null passages or
passages of fewer than ``LEAST_WORDS`` words; every item with a passage counts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.llm.canonical import canonical_texts
from quillspark.llm.tables import slices, table
from quillspark.storage import materialize

LEAST_WORDS, ONE_IN = 15, 8
WALKS, SAMPLES, STEPS_PER_KEY, STEPS = 6, 4, 5, 26
#: Keys of passages up to which the index is sent to every task.
INDEX_BOUND = 4_000_000
#: Words between two halves of a run that a layout mark may put in.
GAP = 6
#: Bits of the passages' words sent to every task beyond the bound, and parts that a key's rows are salted into.
BITMAP, SALTS = 1 << 24, 16
#: Words in a row in common, of which every run across a gap has ``LEAST_SEEDS``.
SEED, LEAST_SEEDS = 5, 2

_MARKS = re.compile(r"\[[^\]\n]{0,60}\]|(?m:^[^\w\n]*(?:(?:pp?|page|pag|pág|seite|s|стр|fol)\.?[^\w\n]*)?\d*[^\w\n]*$)", re.I)
_IN_WORD = re.compile(r"(?<=\w)(?:['’\-‐‑](?=\w)|[-‐‑]\s*\n\s*(?=\w))")
_ALONE = "\u0e00-\u0eff\u3040-ヿ㐀-鿿豈-\ufaff가-\ud7af"
_WORDS = re.compile(rf"[^\W_{_ALONE}]+|[{_ALONE}]")


def word_lists(texts: list[str | None]) -> list[list[str]]:
    """The words of each text in the form in which they are compared."""
    out = []
    for t in canonical_texts(texts):
        if not t:
            out.append([])
            continue
        if "\n" in t or "[" in t:
            t = _MARKS.sub(" ", t)
        out.append(_WORDS.findall(_IN_WORD.sub("", t).casefold()))
    return out


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_CHOSEN = [[np.sort(np.random.default_rng(97 * w + s).choice(STEPS, STEPS_PER_KEY, replace=False)) for s in range(SAMPLES)] for w in range(WALKS)]


def window_keys(windows: np.ndarray) -> np.ndarray:
    """The hash keys (rows x WALKS*SAMPLES) of windows of word codes."""
    n, width = windows.shape
    keys = np.empty((n, WALKS * SAMPLES), np.uint64)
    padded = np.concatenate([windows.astype(np.uint64), np.zeros((n, 1), np.uint64)], 1)
    rows = np.arange(n)
    with np.errstate(over="ignore"):
        for w in range(WALKS):
            at = np.zeros(n, np.int64)
            read = np.empty((STEPS, n), np.uint64)
            for j in range(STEPS):
                read[j] = padded[rows, at]
                bit = _mix(read[j] * np.uint64(0x9E3779B97F4A7C15) + np.uint64((w * STEPS + j + 1) * 0xD1B54A32D192ED03 % 2**64)) >> np.uint64(63)
                at = np.minimum(at + bit.astype(np.int64), width)
            for s, steps in enumerate(_CHOSEN[w]):
                k = np.full(n, w * SAMPLES + s + 1, np.uint64)
                for j in steps:
                    k = _mix(k * np.uint64(0x2545F4914F6CDD1D) + read[j] + np.uint64(1))
                keys[:, w * SAMPLES + s] = k
    return keys


def seed_keys(ids: np.ndarray) -> np.ndarray:
    """A hash of every ``SEED`` words in a row."""
    n = max(len(ids) - SEED + 1, 0)
    k = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(SEED):
            k = _mix(k * np.uint64(0x2545F4914F6CDD1D) + ids[j : j + n].astype(np.uint64) + np.uint64(1))
    return k


def across(seeds: list[int], doc: int, passage: int) -> list[int]:
    """The diagonals on which the first part of a run across a gap can be when a part of it is on one of ``seeds``."""
    return sorted({a for d in seeds for a in range(max(d - GAP, 1 - passage), min(d + 1, doc - 1) + 1)})


def _runs(same: np.ndarray) -> bool:
    """Whether some run of at least LEAST_WORDS has at most one difference in ONE_IN."""
    if len(same) < LEAST_WORDS:
        return False
    p = np.concatenate(([0], np.cumsum(np.where(same, 1, 1 - ONE_IN))))
    # a run begins and ends with a word in common: at its ends a replaced word is no part of it
    low = np.minimum.accumulate(np.where(same, p[:-1], len(p)))[: len(same) - LEAST_WORDS + 1]
    return bool((same[LEAST_WORDS - 1 :] & (p[LEAST_WORDS:] >= low)).any())


def _line(doc: np.ndarray, passage: np.ndarray, diagonal: int) -> np.ndarray:
    """For each word of the passage, whether the document has it on the diagonal."""
    same = np.zeros(len(passage), bool)
    lo, hi = max(0, -diagonal), min(len(passage), len(doc) - diagonal)
    if lo < hi:
        same[lo:hi] = (doc[lo + diagonal : hi + diagonal] == passage[lo:hi]) & (passage[lo:hi] != 0)
    return same


def _edges(doc: np.ndarray, passage: np.ndarray, diagonal: int) -> np.ndarray:
    lo, hi = max(0, -diagonal), min(len(passage), len(doc) - diagonal)
    return _line(doc, passage, diagonal)[lo:hi]


def holds(doc: np.ndarray, passage: np.ndarray, diagonals: list[int]) -> bool:
    """Whether the document holds a long enough part of the passage on or across the diagonals."""
    if not diagonals:
        return False
    if any(_runs(_edges(doc, passage, d)) for d in diagonals):
        return True
    # words in common on each diagonal around, by looking the document's words up in the passage
    n = len(passage)
    around = np.unique(np.concatenate([np.arange(max(0, d - 1), min(len(doc), d + GAP + n + 1)) for d in diagonals]))
    order = np.argsort(passage, kind="stable")
    lo, hi = (np.searchsorted(passage[order], doc[around], side) for side in ("left", "right"))
    times = hi - lo
    at = np.repeat(lo, times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    common = np.bincount(np.repeat(around, times) - order[at] + n, minlength=len(doc) + n + GAP + 1)
    near = {(a, b) for a in diagonals for b in range(max(a - 1, 1 - n), a + GAP + 1) if a != b and min(x := common[a + n], y := common[b + n]) >= 1 and x + y >= LEAST_WORDS - 2}
    return any(_runs_across(_line(doc, passage, a), _line(doc, passage, b)) for a, b in near)


def _runs_across(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether a run goes from word i on the first diagonal to t, over a gap that costs one word, and on the second to j."""
    n = len(x)
    p = np.concatenate(([0], np.cumsum(np.where(x, 1, 1 - ONE_IN))))
    q = np.concatenate(([0], np.cumsum(np.where(y, 1, 1 - ONE_IN))))
    # the best that ends, and that begins, at each word; only where both are worth the gap can a run be
    best = (p - np.minimum.accumulate(p)) + (np.maximum.accumulate(q[::-1])[::-1] - q)
    # the best end at or after each word: a run ends with a word in common
    ends = np.concatenate(([-(1 << 40)], np.where(y, q[1:], -(1 << 40)), np.full(LEAST_WORDS, -(1 << 40))))
    ends = np.maximum.accumulate(ends[::-1])[::-1]
    begins = np.flatnonzero(x)
    for t in np.flatnonzero(best >= ONE_IN - 1):
        i = begins[: np.searchsorted(begins, t)]
        if t < n and len(i) and (p[t] - p[i] + ends[np.maximum(t + 1, i + LEAST_WORDS)] - q[t] >= ONE_IN - 1).any():
            return True
    return False


def codes(words: list[str]) -> np.ndarray:
    """The codes of words: positive numbers by hash, alike wherever they are made."""
    return np.array([xxhash.xxh3_64_intdigest(w) >> 1 or 1 for w in words], np.int64)


def _starts(known: np.ndarray) -> np.ndarray:
    """Starts of the windows that can hold a leak, from whether each word is known from passages."""
    c = np.concatenate(([0], np.cumsum(known)))
    return np.flatnonzero(c[LEAST_WORDS:] - c[:-LEAST_WORDS] >= LEAST_WORDS - 2)


def _seed_starts(known: np.ndarray) -> np.ndarray:
    c = np.concatenate(([0], np.cumsum(known)))
    return np.flatnonzero(c[SEED:] - c[:-SEED] == SEED)


class Index:
    """The passages, the codes of their words, and the keys of their windows."""

    def __init__(self, passages: list[tuple[int, list[str]]]):
        self.code: dict[str, int] = {}
        self.passages: dict[int, np.ndarray] = {}
        keys, owner, offset = [], [], []
        for number, words in passages:
            ids = codes(words)
            if len(ids) < LEAST_WORDS:
                continue
            self.code.update(zip(words, ids.tolist()))
            self.passages[number] = ids
            k = window_keys(np.lib.stride_tricks.sliding_window_view(ids, LEAST_WORDS))
            keys.append(k.ravel())
            owner.append(np.full(k.size, number, np.int64))
            offset.append(np.repeat(np.arange(len(k)), k.shape[1]))
        self.keys = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
        order = np.argsort(self.keys, kind="stable")
        self.keys = self.keys[order]
        self.owner = (np.concatenate(owner) if keys else np.zeros(0, np.int64))[order]
        self.offset = (np.concatenate(offset) if keys else np.zeros(0, np.int64))[order]
        seeds = {n: seed_keys(p) for n, p in self.passages.items()}
        flat = np.concatenate([np.zeros(0, np.uint64), *seeds.values()])
        by_key = np.argsort(flat, kind="stable")
        self.seeds = flat[by_key]
        self.seed_owner = np.concatenate([np.zeros(0, np.int64), *(np.full(len(k), n, np.int64) for n, k in seeds.items())])[by_key]
        self.seed_offset = np.concatenate([np.zeros(0, np.int64), *(np.arange(len(k)) for k in seeds.values())])[by_key]

    def seeded(self, ids: np.ndarray, known: np.ndarray) -> dict[int, list[int]]:
        """The diagonals of seeds in common with passages that have enough of them."""
        starts = _seed_starts(known)
        keys = seed_keys(ids)[starts]
        lo, hi = np.searchsorted(self.seeds, keys, "left"), np.searchsorted(self.seeds, keys, "right")
        n = hi - lo
        at = np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        owner, diagonal = self.seed_owner[at], np.repeat(starts, n) - self.seed_offset[at]
        numbers, counts = np.unique(owner, return_counts=True)
        return {int(x): np.unique(diagonal[owner == x]).tolist() for x in numbers[counts >= LEAST_SEEDS]}

    def search(self, words: list[str]) -> list[int]:
        """The passages that leaked into a document of these words."""
        if len(words) < LEAST_WORDS:
            return []
        get = self.code.get
        ids = np.array([get(w, 0) for w in words], np.int64)
        known = ids > 0
        starts = _starts(known)
        if not len(starts) and len(_seed_starts(known)) < LEAST_SEEDS:
            return []
        strange = np.flatnonzero(~known)
        ids[strange] = codes([words[i] for i in strange])
        found = self._walked(ids, starts)
        for number, seeds in self.seeded(ids, known).items():
            if number not in found and holds(ids, p := self.passages[number], across(seeds, len(ids), len(p))):
                found.append(number)
        return found

    def _walked(self, ids: np.ndarray, starts: np.ndarray) -> list[int]:
        """The passages found by walks."""
        if not len(starts):
            return []
        keys = window_keys(np.lib.stride_tricks.sliding_window_view(ids, LEAST_WORDS)[starts])
        flat = keys.ravel()
        lo, hi = np.searchsorted(self.keys, flat, "left"), np.searchsorted(self.keys, flat, "right")
        n = hi - lo
        if not n.any():
            return []
        at = np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        pos = np.repeat(np.repeat(starts, keys.shape[1]), n)
        met = np.unique(np.stack([self.owner[at], pos - self.offset[at]], 1), axis=0)
        found = []
        for number in np.unique(met[:, 0]):
            if holds(ids, self.passages[int(number)], met[met[:, 0] == number, 1].tolist()):
                found.append(int(number))
        return found


def _search_batches(batches: Iterator[pa.RecordBatch], index: Index) -> Iterator[pa.RecordBatch]:
    for b in slices(batches):
        docs, found = [], []
        for doc, words in zip(b.column(0).to_pylist(), word_lists(b.column(1).to_pylist())):
            hits = index.search(words)
            docs += [doc] * len(hits)
            found += hits
        yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(found, pa.int64())], ["doc_id", "passage"])


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches):
        yield pa.RecordBatch.from_arrays([pa.array([sum(max(len(w) - LEAST_WORDS + 1, 0) for w in word_lists(b.column(0).to_pylist()))], pa.int64())], ["n"])


def _word_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (slot, bits): 64 bits of the bitmap of the words in passages."""
    for b in slices(batches):
        bit = np.unique(np.concatenate([np.zeros(0, np.int64), *(codes(w) % BITMAP for w in word_lists(b.column(0).to_pylist()) if len(w) >= LEAST_WORDS)]))
        yield pa.RecordBatch.from_arrays([pa.array((bit >> 6).astype(np.int32)), pa.array((np.uint64(1) << (bit & 63).astype(np.uint64)).view(np.int64))], ["slot", "bits"])


def _key_batches(batches: Iterator[pa.RecordBatch], words_seen: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    """Rows (id, key, pos, seed) of every window and seed that can hold a leak, where no index is at hand."""
    for b in slices(batches):
        for row, words in zip(b.column(0).to_pylist(), word_lists(b.column(1).to_pylist())):
            if len(words) < LEAST_WORDS:
                continue
            ids = codes(words)
            bit = ids % BITMAP
            known = np.ones(len(ids), bool) if words_seen is None else (words_seen[bit >> 6] >> (bit & 63).astype(np.uint64) & np.uint64(1)) > 0
            starts, seeds_at = _starts(known), _seed_starts(known)
            if not len(starts) and len(seeds_at) < LEAST_SEEDS:
                continue
            keys, seeds = window_keys(np.lib.stride_tricks.sliding_window_view(ids, LEAST_WORDS)[starts]), seed_keys(ids)[seeds_at]
            n = keys.size + len(seeds)
            pos = np.concatenate((np.repeat(starts, keys.shape[1]), seeds_at)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array([row] * n, pa.int64()), pa.array(np.concatenate((keys.ravel(), seeds)).view(np.int64)), pa.array(pos), pa.array(np.arange(n) >= keys.size)], ["id", "key", "pos", "seed"])


def _verify_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = b.to_pylist()
        texts = word_lists([r["text"] for r in rows])
        passages = word_lists([r["passage_text"] for r in rows])
        keep = [(r["doc_id"], r["passage"]) for r, t, p in zip(rows, texts, passages) if holds(codes(t), codes(p), sorted({*r["diagonals"], *across(r["seeds"], len(t), len(p))}))]
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keep], pa.int64()), pa.array([k[1] for k in keep], pa.int64())], ["doc_id", "passage"])


def leaks(documents: DataFrame, items: DataFrame, index_bound: int = INDEX_BOUND) -> DataFrame:
    """(doc_id, item_id) of every document that holds a part of an item's passage, without repeats."""
    by_passage = items.where("passage is not null").select("item_id", "passage", F.xxhash64("passage").alias("number")).distinct()
    passages = by_passage.select("number", "passage").distinct()
    size = passages.select("passage").mapInArrow(_count_batches, "n bigint").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    texts = documents.where("text is not null").select("doc_id", "text")
    if size * WALKS * SAMPLES <= index_bound:
        rows = passages.collect()
        index = Index([(r["number"], w) for r, w in zip(rows, word_lists([r["passage"] for r in rows]))])
        found = texts.mapInArrow(lambda it: _search_batches(it, index), "doc_id bigint, passage bigint")
    else:
        kind = "id bigint, key bigint, pos int, seed boolean"
        words_seen = np.zeros(BITMAP // 64, np.uint64)
        for r in passages.select("passage").mapInArrow(_word_batches, "slot int, bits bigint").groupBy("slot").agg(F.bit_or("bits").alias("bits")).toLocalIterator():  # BITMAP / 64 rows at most
            words_seen[r["slot"]] = np.uint64(r["bits"] & 0xFFFFFFFFFFFFFFFF)
        mine = texts.mapInArrow(lambda it: _key_batches(it, words_seen), kind).select(F.col("id").alias("doc_id"), "key", "seed", F.col("pos").alias("p"), F.pmod(F.xxhash64("id", "pos"), F.lit(SALTS)).alias("salt"))
        theirs = passages.select("number", "passage").mapInArrow(lambda it: _key_batches(it, None), kind)
        theirs = theirs.select(F.col("id").alias("passage"), "key", "seed", F.col("pos").alias("q"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))).alias("salt"))
        met = mine.join(theirs, ["key", "seed", "salt"]).groupBy("doc_id", "passage", "seed", (F.col("p") - F.col("q")).alias("d")).agg(F.count("*").alias("n"))
        pairs = met.groupBy("doc_id", "passage").agg(F.collect_set(F.when(~F.col("seed"), F.col("d"))).alias("diagonals"), F.collect_set(F.when(F.col("seed"), F.col("d"))).alias("seeds"), F.sum(F.when(F.col("seed"), F.col("n"))).alias("n"))
        pairs = pairs.withColumn("seeds", F.when(F.col("n") >= LEAST_SEEDS, F.col("seeds")).otherwise(F.array().cast("array<int>"))).where((F.size("diagonals") > 0) | (F.size("seeds") > 0))
        met = materialize(pairs.drop("n"), "p7-candidates")
        full = met.join(texts, "doc_id").join(passages.select(F.col("number").alias("passage"), F.col("passage").alias("passage_text")), "passage")
        found = full.select("doc_id", "passage", "text", "passage_text", "diagonals", "seeds").mapInArrow(_verify_batches, "doc_id bigint, passage bigint")
    return found.join(by_passage.select(F.col("number").alias("passage"), "item_id"), "passage").select("doc_id", "item_id").distinct()


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the items whose passages leaked into it."""
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))
