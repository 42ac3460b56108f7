"""Benchmark decontamination with suffix arrays over the training texts.

Every batch of documents is a shard. Its suffix array holds, in order of their
words, the suffixes that start a run of benchmark words long enough for the
shortest window; all other suffixes can match nothing. Each suffix of each benchmark
item is looked up by binary search: the neighbours of its place give its longest
verbatim match, and the range of suffixes that start with its window gives every
occurrence. A document lies in one shard, so nothing is shuffled.

The benchmark is dealt into blocks of bounded size, each broadcast to one pass; the
hits found so far travel with the document from pass to pass.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.llm.batches import ALNUM, Words, text_slices
from plumbline.llm.stored import share, shared

WINDOW = 13
#: Bytes of benchmark text that one pass holds in memory and that are broadcast at once.
BLOCK_BYTES = 16 << 20

_FOUND = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()), T.StructField("hit", T.BinaryType()),
    T.StructField("items", T.ArrayType(T.StringType())), T.StructField("longest", T.LongType()),
    T.StructField("longest_start", T.LongType()), T.StructField("longest_item", T.StringType())])
_ARROW = [
    pa.field("n_words", pa.int64()), pa.field("n_hit", pa.int64()), pa.field("hit", pa.binary()),
    pa.field("items", pa.list_(pa.string())), pa.field("longest", pa.int64()), pa.field("longest_start", pa.int64()),
    pa.field("longest_item", pa.string())]


class _Block:
    """The suffixes of some benchmark items, their words numbered from 1."""

    def __init__(self, ids: list, texts: list, window: int) -> None:
        words = Words(pa.array(texts, pa.string()), ALNUM)
        self.vocabulary, number = np.unique(words.hashes(), return_inverse=True)
        self.words = (number + 1).astype(np.uint32)
        self.window = window
        self.names = ["" if i is None else str(i) for i in ids]
        self.item = words.doc
        start = np.arange(len(self.words))
        last = (words.first + words.count)[self.item]
        #: Words left in the item, and the window that starts here (0: none).
        self.left = last - start
        whole = words.count[self.item]
        self.span = np.where(whole >= window, np.where(self.left >= window, window, 0), np.where(self.left == whole, whole, 0))
        self.shortest = int(self.span[self.span > 0].min()) if len(start) else 0
        self.keys = _keys(self.words, start, np.minimum(self.left, window), window)
        ends = self.keys.copy()
        cut = np.arange(window)[None, :] >= self.span[:, None]
        ends[cut] = np.uint32(0xFFFFFFFF)
        self.tops = ends


def _keys(words: np.ndarray, starts: np.ndarray, lengths: np.ndarray, window: int) -> np.ndarray:
    """The first words of each suffix, one row per suffix, padded with 0."""
    steps = np.arange(window)
    rows = words[np.minimum(starts[:, None] + steps, max(len(words) - 1, 0))] if len(starts) else np.zeros((0, window), np.uint32)
    return np.where(steps < lengths[:, None], rows, 0).astype(np.uint32)


def _sortable(keys: np.ndarray) -> np.ndarray:
    """Rows as byte strings whose order is the order of their words."""
    keys = np.ascontiguousarray(keys.astype(">u4"))
    return keys.view(f"S{4 * keys.shape[1]}").ravel() if len(keys) else np.zeros(0, f"S{4 * keys.shape[1]}")


def _common(words: np.ndarray, at: np.ndarray, room: np.ndarray, block: _Block, suffix: np.ndarray) -> np.ndarray:
    """Words that the shard's suffixes ``at`` share with the block's ``suffix``."""
    length = np.zeros(len(at), np.int64)
    active = np.arange(len(at))
    while len(active):
        n = length[active]
        going = (n < room[active]) & (n < block.left[suffix[active]])
        active, n = active[going], n[going]
        if not len(active):
            break
        same = words[at[active] + n] == block.words[suffix[active] + n]
        active = active[same]
        length[active] += 1
    return length


def _search(words: Words, numbers: np.ndarray, block: _Block) -> tuple[np.ndarray, np.ndarray, np.ndarray, tuple]:
    """(hit mask, rows, items) of a shard and its longest match for each row."""
    n = len(numbers)
    longest = (np.zeros(words.rows, np.int64), np.zeros(words.rows, np.int64), np.zeros(words.rows, np.int64))
    hit = np.zeros(n + 1, np.int64)
    none = np.zeros(0, np.int64)
    if not n or not block.shortest:
        return hit[:n] > 0, none, none, longest
    # Known words in a row from each position on, inside the document.
    at = np.arange(n)
    last = (words.first + words.count)[words.doc]
    stops = np.where(numbers == 0, at, n)
    room = np.minimum(np.minimum.accumulate(stops[::-1])[::-1], last) - at
    starts = np.flatnonzero(room >= block.shortest)
    if not len(starts):
        return hit[:n] > 0, none, none, longest
    keys = _sortable(_keys(numbers, starts, np.minimum(room[starts], block.window), block.window))
    order = np.argsort(keys, kind="stable")
    array, keys = starts[order], keys[order]
    wanted = _sortable(block.keys)
    low = np.searchsorted(keys, wanted, side="left")
    high = np.searchsorted(keys, _sortable(block.tops), side="right")
    high = np.where(block.span > 0, np.maximum(high, low), low)

    found = np.flatnonzero(high > low)
    sizes = (high - low)[found]
    suffix = np.repeat(found, sizes)
    place = array[np.repeat(low[found] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())]
    np.add.at(hit, place, 1)
    np.add.at(hit, place + block.span[suffix], -1)
    pairs = np.unique(words.doc[place] * len(block.names) + block.item[suffix]) if len(place) else none

    # Longest matches: every occurrence of a window, followed to its end.
    if len(place):
        length = _common(numbers, place, room[place], block, suffix)
        row = words.doc[place]
        best = np.lexsort((block.item[suffix], place, -length, row))
        first = best[np.concatenate([[True], row[best][1:] != row[best][:-1]])]
        longest[0][row[first]], longest[1][row[first]], longest[2][row[first]] = (
            length[first], place[first] - words.first[row[first]], block.item[suffix[first]])
    return np.cumsum(hit[:n]) > 0, pairs // len(block.names), pairs % len(block.names), longest


def _match(texts: pa.Array, block: _Block) -> tuple[Words, np.ndarray, np.ndarray, np.ndarray, tuple]:
    """The words of some texts and what ``_search`` finds in them."""
    words = Words(texts, ALNUM)
    hashes = words.hashes()
    if len(block.vocabulary):
        spot = np.searchsorted(block.vocabulary, hashes)
        known = block.vocabulary[np.minimum(spot, len(block.vocabulary) - 1)] == hashes
        numbers = np.where(known, spot + 1, 0).astype(np.uint32)
    else:
        numbers = np.zeros(len(hashes), np.uint32)
    return words, *_search(words, numbers, block)


def _pass(block: Broadcast, carried: list[str], text_at: int):
    """Adds one block's hits to the columns that follow the ``carried`` ones."""
    n = len(carried)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        its = shared(block)
        for batch in batches:
            for part in text_slices(batch, text_at):
                words, hit, rows, items, (length, start, item) = _match(part.column(text_at), its)
                bits, names, *longest = (part.column(n + 2 + i).to_pylist() for i in range(5))
                names = [list(x or []) for x in names]
                for r, i in zip(rows, items):
                    names[r].append(its.names[i])
                cells, counts, begin = [], [], 0
                for r, count in enumerate(words.count):
                    own = hit[begin : begin + count]
                    begin += count
                    if bits[r]:
                        own = own | np.unpackbits(np.frombuffer(bits[r], np.uint8), count=count).astype(bool)
                    counts.append(int(own.sum()))
                    cells.append(np.packbits(own).tobytes() if counts[-1] else b"")
                best = [
                    (int(length[r]), int(start[r]), its.names[item[r]]) if length[r] > (longest[0][r] or 0)
                    else (longest[0][r] or 0, longest[1][r], longest[2][r]) for r in range(words.rows)]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:n], pa.array(words.count), pa.array(counts, pa.int64()), pa.array(cells, pa.binary()),
                     pa.array(names, pa.list_(pa.string())), pa.array([b[0] for b in best], pa.int64()),
                     pa.array([b[1] for b in best], pa.int64()), pa.array([b[2] for b in best], pa.string())],
                    schema=pa.schema([*list(part.schema)[:n], *_ARROW]))

    return run


def _passes(
    rows: DataFrame, text_at: int, benchmark: DataFrame, item_col: str, item_text_col: str, window: int, block_bytes: int,
) -> DataFrame:
    """``rows`` with the fields of what was found after their own columns."""
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(item_text_col).cast("string").alias("text"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = int(total // block_bytes) + 1
    carried = [f"`{c}`" for c in rows.columns]
    schema = T.StructType([*rows.schema.fields, *_FOUND.fields])
    found = rows.select(*carried, *(F.lit(None).cast(f.dataType).alias(f.name) for f in _FOUND.fields))
    for i in range(blocks):
        some = items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == i).orderBy("item", "text").collect()
        block = share(rows.sparkSession, _Block([r.item for r in some], [r.text for r in some], window))
        found = found.mapInArrow(_pass(block, rows.columns, text_at), schema)
    return found


def find(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES, keep_text: bool = False,
) -> DataFrame:
    """Benchmark matches of each row of ``docs``.

    (doc_id, n_words, n_hit, hit, items, longest, longest_start, longest_item): ``hit`` has one
    bit per word, set inside occurrences of a window of ``window`` words of an item (the
    whole item, if it has fewer) and ``n_hit`` counts them; ``items`` names the items with such windows, sorted;
    ``longest`` is the longest verbatim match in words, at word ``longest_start``, with
    ``longest_item``. Words are runs of ASCII digits and letters (A-Z lower-cased) and
    of bytes beyond ASCII.

    Null texts and texts without words have no words and no hits, items without words
    have no windows. Rows with the same id, of either table, are kept apart; items of one
    id count once, and a null item id is written as an empty name. Empty tables give no
    rows or no hits. Other columns are not read.
    """
    read = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    found = _passes(read, 1, benchmark, item_col, item_text_col, window, block_bytes)
    found = found if keep_text else found.drop("text")
    return found.withColumn("items", F.array_sort(F.array_distinct("items")))


def contaminated() -> Column:
    """The rule: at least one word and at least a twentieth of the words are hit."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
    window: int = WINDOW, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all their columns."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    at = [c.lower() for c in docs.columns].index(text_col.lower())
    found = _passes(docs.toDF(*names), at, benchmark, item_col, item_text_col, window, block_bytes)
    return found.filter(~contaminated()).select(*names).toDF(*docs.columns)


def digest(found: DataFrame) -> DataFrame:
    """One row of counts per document from the result of ``find``."""
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        contaminated().alias("contaminated"))
