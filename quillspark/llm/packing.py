"""Problem 2: filling containers of fixed capacity with the segments of a chapter.

Space-filling-curve order. Every segment's words are hashed to a vector of
``DIMS`` signed sums, which is scaled by the square root of the word count and
put on a grid; its place on a Hilbert curve through the grid is the segment's
key. Segments are range-sorted by chapter and key, and neighbours along the curve
share containers: each container is filled from the next ``NEIGHBOURS`` segments along the
curve that are still without one. One of them opens the container, and the subset of the others
that fills it best joins (subset sums); of equally good ones the nearest. The curve is walked
from its start; as long as the sum of sizes would allow fewer containers, also from its end, with the
largest neighbour opening, and from ``STARTS`` places, and the walk with the fewest containers
is taken, the earliest on a tie.

A chapter is one block as long as it has at most ``BLOCK`` segments. A larger
one is cut along the curve into blocks of that size from histograms of
keys (of ``CELLS`` cells, then of the keys within each cell), and only a single key with more copies
than that is salted, so no task ever holds more than some blocks. A block wastes at
most a part of one container against the whole chapter.

Defined results: null and empty texts, and texts of white space only in words,
have size 0 and no container. Only a segment above chunk_size is divided, by the
cutting operator without overlap. Redelivered segments count once; rows without a
segment_id are segments of their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quillspark.llm.pieces import cut, with_sizes
from quillspark.llm.tables import table
from quillspark.storage import materialize

DIMS, BITS = 3, 10
#: Segments from which a container is filled, and places where a walk along the curve may begin.
NEIGHBOURS, STARTS = 64, 8
#: Segments of a chapter that are packed together.
BLOCK = 4096
#: Cells of a chapter's first histogram of keys.
CELLS = 1 << 15


def hilbert_keys(x: np.ndarray, bits: int) -> np.ndarray:
    """The place on the Hilbert curve of each row of ``x`` (integers below 2**bits), by transposing Gray codes."""
    x = x.astype(np.int64).copy()
    n = x.shape[1]
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            high = (x[:, i] & q) > 0
            t = np.where(high, 0, (x[:, 0] ^ x[:, i]) & p)
            x[:, 0] ^= np.where(high, p, t)
            x[:, i] ^= t
        q >>= 1
    for i in range(1, n):
        x[:, i] ^= x[:, i - 1]
    t = np.zeros(len(x), np.int64)
    q = 1 << (bits - 1)
    while q > 1:
        t ^= np.where((x[:, n - 1] & q) > 0, q - 1, 0)
        q >>= 1
    x ^= t[:, None]
    key = np.zeros(len(x), np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[:, i] >> b) & 1)
    return key


def _words_and_keys(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Number of words, and Hilbert key, of each text."""
    lists = pc.utf8_split_whitespace(text)
    flat = lists.flatten()
    n = pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.repeat(np.arange(len(text)), n)
    words = flat.dictionary_encode()
    vocabulary = words.dictionary.to_pylist()
    hashes = np.array([xxhash.xxh3_64_intdigest(w.lower()) for w in vocabulary] or [0], np.uint64)
    real = np.array([bool(w) for w in vocabulary] or [False])
    signs = np.stack([np.where((hashes >> np.uint64(7 * d)) & np.uint64(1), 1.0, -1.0) for d in range(DIMS)], 1) * real[:, None]
    index = words.indices.to_numpy(zero_copy_only=False) if len(flat) else np.zeros(0, np.int64)
    counts = np.bincount(row, weights=real[index], minlength=len(text)) if len(row) else np.zeros(len(text))
    vector = np.stack([np.bincount(row, weights=signs[index, d], minlength=len(text)) if len(row) else np.zeros(len(text)) for d in range(DIMS)], 1)
    scaled = vector / np.sqrt(np.maximum(counts, 1))[:, None]
    grid = np.clip((scaled + 3.0) / 6.0 * (1 << BITS), 0, (1 << BITS) - 1)
    return counts.astype(np.int64), hilbert_keys(grid, BITS)


_ITEM_DDL = "book_id string, chapter_number int, segment_id bigint, piece_no int, start_pos int, end_pos int, size int, capacity int, curve bigint"
_ITEM = pa.schema([("book_id", pa.string()), ("chapter_number", pa.int32()), ("segment_id", pa.int64()), ("piece_no", pa.int32()), ("start_pos", pa.int32()), ("end_pos", pa.int32()), ("size", pa.int32()), ("capacity", pa.int32()), ("curve", pa.int64())])


def _items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Columns in: book_id, chapter_number, segment_id, text, chunk_size, size_unit."""
    for b in batches:
        text, cap = b.column(3), np.maximum(b.column(4).to_numpy(zero_copy_only=False), 1)
        chars = pc.utf8_length(text).fill_null(0).to_numpy(zero_copy_only=False)
        words, curve = _words_and_keys(text)
        by_char = pc.equal(b.column(5), "char").to_numpy(zero_copy_only=False)
        size = np.where(by_char, chars, words)
        whole = (size > 0) & (size <= cap)
        m = pa.array(whole)
        n = int(whole.sum())
        if n:
            yield pa.RecordBatch.from_arrays(
                [b.column(0).filter(m), b.column(1).filter(m), b.column(2).filter(m), pa.array(np.zeros(n, np.int32)), pa.array(np.zeros(n, np.int32)), pa.array(chars[whole].astype(np.int32)), pa.array(size[whole].astype(np.int32)), pa.array(cap[whole].astype(np.int32)), pa.array(curve[whole])],
                schema=_ITEM,
            )
        rows = []
        for i in np.flatnonzero(size > cap):
            i = int(i)
            for k, (s, e, units) in enumerate(cut(text[i].as_py(), int(cap[i]), 0, "char" if by_char[i] else "word")):
                rows.append((b.column(0)[i].as_py(), b.column(1)[i].as_py(), b.column(2)[i].as_py(), k, s, e, units, int(cap[i]), int(curve[i])))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ITEM)], schema=_ITEM)


def _along(sizes: list[int], cap: int, order: list[int], largest_opens: bool = False) -> tuple[int, list[int]]:
    """Number of containers, and each item's container, when they are filled from the next neighbours in ``order``."""
    to = [0] * len(sizes)
    count, at = 0, 0
    hood: list[int] = []
    while hood or at < len(order):
        while len(hood) < NEIGHBOURS and at < len(order):
            hood.append(order[at])
            at += 1
        first = max(hood, key=sizes.__getitem__) if largest_opens else hood[0]
        others = [i for i in hood if i != first]
        if largest_opens:
            others.sort(key=lambda i: -sizes[i])
        rest = cap - sizes[first]
        chosen = {first}
        reach, steps, full = 1, [], (1 << (rest + 1)) - 1  # bit k: some subset of those met so far has size k
        for i in others:
            if reach >> rest & 1:
                break
            steps.append(reach)
            reach |= (reach << sizes[i]) & full
        total = reach.bit_length() - 1
        for i, before in zip(reversed(others[: len(steps)]), reversed(steps)):
            if not before >> total & 1:
                chosen.add(i)
                total -= sizes[i]
        for i in chosen:
            to[i] = count
        hood = [i for i in hood if i not in chosen]
        count += 1
    return count, to


def pack(sizes: list[int], cap: int) -> tuple[int, list[int]]:
    """Pack items given in curve order into containers of ``cap``, by the walk along the curve that needs the fewest."""
    n = len(sizes)
    least = max(-(-sum(sizes) // cap), sum(2 * s > cap for s in sizes))
    curve = list(range(n))
    best = _along(sizes, cap, curve)
    for order, largest in ((curve[::-1], False), (curve, True), *(([*curve[k:], *curve[:k]], False) for k in (n * r // STARTS for r in range(1, STARTS)))):
        if best[0] == least:
            break
        if (other := _along(sizes, cap, order, largest))[0] < best[0]:
            best = other
    return best


_OUT_DDL = "book_id string, chapter_number int, container_no bigint, segment_id bigint, piece_no int, start_pos int, end_pos int, size int, capacity int"


def _pack_sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pack rows that come sorted by (book_id, chapter_number, block, curve, segment_id, piece_no)."""
    held: pa.Table | None = None

    def done(t: pa.Table) -> pa.Table:
        """Pack a table of whole blocks."""
        books = t.column("book_id").combine_chunks().dictionary_encode()
        keys = np.stack([np.asarray(books.indices.fill_null(-1)), t.column("chapter_number").fill_null(-1).to_numpy(), t.column("block").to_numpy(), t.column("capacity").to_numpy()], 1)
        ids = np.stack([t.column("segment_id").fill_null(-1).to_numpy(), t.column("piece_no").to_numpy()], 1)
        same = np.concatenate(([False], (keys[1:, :3] == keys[:-1, :3]).all(1) & (ids[1:] == ids[:-1]).all(1) & np.asarray(t.column("segment_id").is_valid())[1:]))
        if same.any():
            keep = ~same
            t, keys = t.filter(pa.array(keep)), keys[keep]
        cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1).tolist(), len(keys)]
        sizes = t.column("size").to_pylist()
        containers = np.zeros(len(keys), np.int64)
        base, last = 0, None
        for a, b in zip(cuts, cuts[1:]):
            block = tuple(keys[a, :3])
            base = base if block == last else 0
            n, to = pack(sizes[a:b], int(keys[a, 3]))
            containers[a:b] = (int(keys[a, 2]) << 20) + base + np.array(to)
            base, last = base + n, block
        return t.append_column("container_no", pa.array(containers)).select([x.split()[0] for x in _OUT_DDL.split(", ")])

    for b in batches:
        t = pa.Table.from_batches([b])
        held = t if held is None else pa.concat_tables([held, t])
        if held.num_rows < BLOCK:
            continue
        # the last block may go on in the next batch
        end = held.slice(held.num_rows - 1).to_pylist()[0]
        other = pc.invert(pc.and_(pc.and_(_same(held.column("book_id"), end["book_id"]), _same(held.column("chapter_number"), end["chapter_number"])), _same(held.column("block"), end["block"])))
        n = pc.sum(other).as_py() or 0
        if n:
            yield from done(held.slice(0, n).combine_chunks()).to_batches()
            held = held.slice(n)
    if held is not None and held.num_rows:
        yield from done(held.combine_chunks()).to_batches()


def _same(column: pa.ChunkedArray, value: object) -> pa.ChunkedArray:
    return pc.is_null(column) if value is None else pc.fill_null(pc.equal(column, value), False)


def containers(segments: DataFrame, configs: DataFrame) -> DataFrame:
    """The container of every segment, or piece of an oversized segment.

    One row per item: book_id, chapter_number, container_no (within the chapter),
    segment_id, piece_no, start_pos, end_pos, size, capacity.
    """
    rows = with_sizes(segments.select("book_id", "chapter_number", "segment_id", "text", "config_id"), configs)
    items = rows.select("book_id", "chapter_number", "segment_id", "text", "chunk_size", "size_unit").mapInArrow(_items, _ITEM_DDL)
    chapter = ["book_id", "chapter_number"]
    cells = rows.groupBy(*chapter).count().where(F.col("count") > BLOCK).select(*chapter)
    if cells.isEmpty():  # usually no chapter is larger than a block
        blocked = items.withColumn("block", F.lit(0))
    else:
        width = (1 << DIMS * BITS) // CELLS
        # keys are compared null-safe: a chapter without a name is a chapter
        named = lambda df: df.withColumnsRenamed({"book_id": "_b", "chapter_number": "_c"})
        here = [F.col("book_id").eqNullSafe(F.col("_b")), F.col("chapter_number").eqNullSafe(F.col("_c"))]
        fine = items.join(named(cells), here, "left_semi").groupBy(*chapter, "curve").agg(F.count("*").alias("n")).withColumn("cell", F.floor(F.col("curve") / width))
        fine = materialize(fine, "p2-keys")
        before = lambda *by: Window.partitionBy(*chapter, *by).orderBy("curve" if by else "cell").rowsBetween(Window.unboundedPreceding, -1)
        coarse = fine.groupBy(*chapter, "cell").agg(F.sum("n").alias("in_cell")).withColumn("first", F.coalesce(F.sum("in_cell").over(before()), F.lit(0)))
        coarse = named(coarse.withColumnRenamed("cell", "_cell").drop("in_cell"))
        place = F.col("first") + F.coalesce(F.sum("n").over(before("cell")), F.lit(0))
        located = fine.join(coarse, [*here, F.col("cell") == F.col("_cell")]).withColumn("place", place)
        located = named(located.drop("_b", "_c").select(*chapter, F.col("curve").alias("_curve"), F.floor(F.col("place") / BLOCK).alias("at"), F.ceil(F.col("n") / BLOCK).alias("parts")))
        salt = F.pmod(F.xxhash64("segment_id", "piece_no", "start_pos"), F.col("parts"))
        blocked = items.join(located, [*here, F.col("curve") == F.col("_curve")], "left").select(*items.columns, F.coalesce(F.col("at") + salt, F.lit(0)).cast("int").alias("block"))
    placed = blocked.repartition(*chapter, "block").sortWithinPartitions(*chapter, "block", "capacity", "curve", "segment_id", "piece_no")
    return placed.mapInArrow(_pack_sorted, _OUT_DDL)


def p2_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The container of every segment of every chapter."""
    return containers(table(spark, sf_dir, "segments"), table(spark, sf_dir, "run_configs"))


def p2_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per book: containers, the least that any packing needs, and the share of space in use."""
    rows = p2_containers(spark, sf_dir)
    by_container = rows.groupBy("book_id", "chapter_number", "container_no").agg(F.sum("size").alias("used"), F.any_value("capacity").alias("capacity"))
    by_chapter = by_container.groupBy("book_id", "chapter_number").agg(F.count("*").alias("containers"), F.sum("used").alias("used"), F.max("capacity").alias("capacity"))
    return by_chapter.groupBy("book_id").agg(
        F.sum("containers").alias("containers"),
        F.sum(F.ceil(F.col("used") / F.col("capacity"))).alias("least"),
        F.sum("used").alias("used"),
        F.sum(F.col("containers") * F.col("capacity")).alias("space"),
    )
