"""Problem 6: encoding the whole corpus with a public byte-level BPE tokenizer.

Every task loads the tokenizer's ranks into an in-process DuckDB as a merge table
and encodes the distinct words of its batches there. A recursive query keeps the parts of
the words as rows (word, position, id): each round joins neighbouring parts with the merge
table and contracts each word's leftmost pair of minimum rank, until no word has a pair
left. An ordered aggregation gives each word's ids, and another the text of a document's ids
(decoding).

In a long word one round contracts many pairs: a pair whose rank is the least within
as many parts on either side as the longest token has bytes that the word's bytes can form. Nothing farther away can reach it
first, since a token that did would be longer than that. Of equal ranks within that
reach the leftmost goes first; where no merge that the new token could take part in has a lower
rank, they go in the same round (of overlapping ones every other). So the number of rounds
depends on the vocabulary and not on the length of the word, and the work grows with the length.

Words a task has met before are kept with their ids in a dictionary of bounded size; the
bound changes nothing but the time. Documents are joined to their words' ids in order.

A whole word that is in the vocabulary is its own fix-point only when its merges
lead there, so every word goes through the recursion.

Defined results: an empty list for null and empty texts; a row for every row of
the input, repeated or not; texts of any length are encoded whole. Null and empty lists decode
to an empty text; ids that the vocabulary does not have decode to nothing.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from quillspark.llm.tables import slices, table

TOKENIZER = "byte_bpe_50k"
#: Words that a task remembers with their ids.
REMEMBERED = 400_000
#: Words, and bytes of them, that one run of the recursive query encodes; a longer word has a run of its own.
WORDS_AT_ONCE, BYTES_AT_ONCE = 20_000, 1 << 19


def vocabulary_path(name: str = TOKENIZER) -> str:
    """The file of a tokenizer of the ``public_tokenizers`` package, as a path that executors share."""
    import public_tokenizers

    return public_tokenizers.path(f"{name}.tiktoken")


_CONTRACT = """
with recursive parts(word, pos, id) using key (word, pos) as (
  select word, pos, id from bytes_of_words
  union
  (
    with live as (
      select word, pos, id, lead(id) over w as right_id, lead(pos) over w as right_pos
      from recurring.parts where id >= 0 and word in (select word from parts)
      window w as (partition by word order by pos)
    ),
    ranked as (
      select l.word, l.pos, l.right_pos, m.merged, m.rank, m.early from live l left join merges m on m.a = l.id and m.b = l.right_id
    ),
    seen as (
      select *, min(rank) over (partition by word order by pos rows between {reach} preceding and 1 preceding) as before,
        min(rank) over (partition by word order by pos rows between 1 following and {reach} following) as behind,
        row_number() over w as nth, lag(rank) over w as rank_before
      from ranked window w as (partition by word order by pos)
    ),
    runs as (
      select *, nth - max(case when rank is distinct from rank_before then nth end) over (partition by word order by pos rows unbounded preceding) as in_run from seen
    ),
    chosen as (
      select word, pos, right_pos, merged from runs
      where rank <= coalesce(behind, rank) and in_run % 2 = 0 and (before is null or rank < before or (rank = before and not early))
    )
    select word, pos, merged from chosen union all select word, right_pos, -1 from chosen
  )
)
select word, list(id order by pos) as ids from parts where id >= 0 group by word order by word
"""

_DECODE = "select doc, string_agg(hex, '' order by pos) as hex from ids_of_docs join vocabulary using (id) group by doc"


def _database() -> "duckdb.DuckDBPyConnection":  # noqa: F821
    """An in-process database of one thread; it spills where Spark's own tasks do, if anywhere."""
    import duckdb

    scratch = os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0]
    return duckdb.connect(config={"threads": 1, "memory_limit": "500MB", "preserve_insertion_order": False, "temp_directory": f"{scratch}/merges-{os.getpid()}" if scratch else ""})


def _ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class WordEncoder:
    """Encodes words by contracting pairs in DuckDB."""

    def __init__(self, path: str):
        ranks = _ranks(path)
        self.byte_ids = np.array([ranks[bytes([i])] for i in range(256)], np.int32)
        # tokens from the longest, each with the set of its bytes as bits
        self.by_length = [(len(t), sum(1 << x for x in set(t))) for t in sorted(ranks, key=len, reverse=True)]
        self.db = _database()
        # a merge has as rank its result's; each pair of parts that together are a token is a merge
        merges = [(x, y, rank) for token, rank in ranks.items() for k in range(1, len(token)) if (x := ranks.get(token[:k])) is not None and (y := ranks.get(token[k:])) is not None]
        a, b, merged = (np.array(c, np.int32) for c in zip(*merges))
        # tokens that can merge further at a lower rank than their own
        early = np.unique(np.concatenate((a[merged < a], b[merged < b])))
        rows = pa.table({"a": a, "b": b, "merged": merged, "rank": merged, "early": np.isin(merged, early)})
        self.db.register("rows_of_merges", rows)
        self.db.execute("create table merges as select * from rows_of_merges")
        self.db.unregister("rows_of_merges")

    def encode(self, words: list[str]) -> list[np.ndarray]:
        """The ids of each word."""
        data = [w.encode("utf-8", "surrogatepass") for w in words]
        n = np.array([len(d) for d in data], np.int64)
        pos = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        rows = pa.table({"word": np.repeat(np.arange(len(words), dtype=np.int32), n), "pos": pos.astype(np.int32), "id": self.byte_ids[np.frombuffer(b"".join(data), np.uint8)]})
        self.db.register("bytes_of_words", rows)
        here = sum(1 << x for x in set(b"".join(data)))
        reach = next((k for k, bits in self.by_length if not bits & ~here), 1)
        found = self.db.sql(_CONTRACT.format(reach=reach)).to_arrow_table().column("ids").combine_chunks()
        self.db.unregister("bytes_of_words")
        values, off = found.values.to_numpy(zero_copy_only=False), found.offsets.to_numpy(zero_copy_only=False)
        return [values[s:e] for s, e in zip(off[:-1], off[1:])]


def _portions(words: list[str]) -> Iterator[list[str]]:
    """The words in portions for one run each."""
    part: list[str] = []
    size = 0
    for w in words:
        if part and (len(part) == WORDS_AT_ONCE or size + 4 * len(w) > BYTES_AT_ONCE):
            yield part
            part, size = [], 0
        part.append(w)
        size += 4 * len(w)
    if part:
        yield part


def _encode_batches(batches: Iterator[pa.RecordBatch], path: str, pattern: str) -> Iterator[pa.RecordBatch]:
    import regex

    split = regex.compile(pattern).findall
    encoder = WordEncoder(path)
    known: dict[str, int] = {}
    ids: list[np.ndarray] = []
    for b in slices(batches):
        docs = [split(t) if t else [] for t in b.column(1).to_pylist()]
        if len(known) > REMEMBERED:
            known.clear()
            ids.clear()
        new = list(dict.fromkeys(w for d in docs for w in d if w not in known))
        for part in _portions(new):
            for w, x in zip(part, encoder.encode(part)):
                known[w] = len(ids)
                ids.append(x)
        flat, sizes = [], []
        for d in docs:
            mine = [ids[known[w]] for w in d]
            flat += mine
            sizes.append(sum(map(len, mine)))
        values = np.concatenate(flat) if flat else np.zeros(0, np.int32)
        offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
        yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.int32)))], ["doc_id", "ids"])


def encode_documents(documents: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """(doc_id, ids) of every row of ``documents``; no shuffle."""
    import public_tokenizers

    path, pattern = path or vocabulary_path(), pattern or public_tokenizers.PATTERN
    return documents.select("doc_id", "text").mapInArrow(lambda it: _encode_batches(it, path, pattern), "doc_id bigint, ids array<int>")


def _decode_batches(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    db = _database()
    ranks = _ranks(path)
    tokens = pa.table({"id": pa.array(list(ranks.values()), pa.int32()), "hex": [t.hex() for t in ranks]})
    db.register("tokens", tokens)
    db.execute("create table vocabulary as select * from tokens")
    db.unregister("tokens")
    for b in slices(batches):
        n = np.array([len(x) if x is not None else 0 for x in b.column(1).to_pylist()], np.int64)
        rows = pa.table({"doc": np.repeat(np.arange(b.num_rows, dtype=np.int32), n), "pos": (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)).astype(np.int32), "id": b.column(1).flatten()})
        db.register("ids_of_docs", rows)
        text = [""] * b.num_rows
        for doc, code in db.execute(_DECODE).fetchall():
            text[doc] = bytes.fromhex(code).decode("utf-8", "replace")
        db.unregister("ids_of_docs")
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(text, pa.string())], ["doc_id", "text"])


def decode_documents(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, text) of rows (doc_id, ids); no shuffle."""
    path = path or vocabulary_path()
    return encoded.select("doc_id", "ids").mapInArrow(lambda it: _decode_batches(it, path), "doc_id bigint, text string")


def p6_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ids of each document's text by byte_bpe_50k, without special tokens."""
    return encode_documents(table(spark, sf_dir, "documents"))


def p6_decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text of each document out of its ids."""
    return decode_documents(encode_documents(table(spark, sf_dir, "documents")))
