"""Packing by power-of-two decomposition.

A document's token ids, closed by an end id, are cut into pieces whose lengths are
powers of two: as many of the longest as fit and then the binary digits of the rest.
Each piece is a sequence of its own, so no sequence crosses documents and none is
padded. Batches are drawn from the bucket of one length.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.batches import text_slices

LENGTH = 2048
END_ID = 1
#: Files of the tokenizer in the folder of public tokenizers: the tokenizer itself and its vocabulary as ranks.
TOKENIZER, RANKS = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"
#: A text with this string is encoded whole, because the tokenizer has an id for it.
SPECIAL = "<|endoftext|>"

_SPACE = r"[\t\n\v\f\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
#: A blank inside a run of white space, where cutting before the blank would change the tokens.
_BLANK_IN_RUN = f"{_SPACE} (?:{_SPACE}|\\z)"

SLICE_BYTES = 8 << 20


class Encoder:
    """Token ids of many texts at once, equal to those of the public tokenizer.

    The tokenizer never joins a blank with what precedes it, so a text is cut before its
    blanks and each different piece of a batch is encoded once. Texts where that
    would not hold are encoded whole.
    """

    def __init__(self, tokenizer: str = TOKENIZER, ranks: str = RANKS) -> None:
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        with open(public_tokenizers.path(ranks), "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self._pieces = tiktoken.Encoding(
            "pieces", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
        self._whole = lambda: Tokenizer.from_file(public_tokenizers.path(tokenizer))

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids, one text after another with ``end_id`` after each, and the ids of each text."""
        texts = texts.fill_null("")
        odd = pc.or_(pc.match_substring_regex(texts, _BLANK_IN_RUN), pc.match_substring(texts, SPECIAL))
        cut = pc.split_pattern(pc.if_else(odd, "", texts), " ")
        sizes = pc.list_value_length(cut).to_numpy(zero_copy_only=False).astype(np.int64)
        words = cut.flatten().dictionary_encode()
        index = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        encode = self._pieces.encode_ordinary
        lists = [encode(" " + word) for word in words.dictionary.to_pylist()]
        # The first piece of a text has no blank before it.
        first = np.cumsum(sizes) - sizes
        starts = words.dictionary.take(pa.array(index[first])).to_pylist()
        whole = None
        for row, (start, is_odd) in enumerate(zip(starts, odd.to_pylist())):
            if is_odd:
                whole = whole or self._whole()
                lists.append(whole.encode(texts[row].as_py(), add_special_tokens=False).ids)
            else:
                lists.append(encode(start))
        index[first] = len(words.dictionary) + np.arange(len(first))
        lists.append([end_id])
        index = np.insert(index, np.cumsum(sizes), len(lists) - 1)

        table = np.fromiter(chain.from_iterable(lists), np.uint32)
        counts = np.fromiter(map(len, lists), np.int64, len(lists))
        at, length = (np.cumsum(counts) - counts)[index], counts[index]
        ends = np.cumsum(length)
        ids = table[np.repeat(at - (ends - length), length) + np.arange(ends[-1] if len(ends) else 0)]
        return ids, np.diff(ends[np.cumsum(sizes + 1) - 1], prepend=0)


def cut_lengths(n: int, longest: int) -> list[int]:
    """``n`` as a sum of powers of two up to ``longest``, largest first."""
    return [longest] * (n // longest) + [1 << k for k in range(longest.bit_length() - 2, -1, -1) if n >> k & 1]


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", longest: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """(doc_id, start, length, ids, doc_tokens, sequence_id, offset, bucket): one row per piece.

    ``ids`` packs the token ids as little-endian 32-bit numbers. ``start`` counts the
    document's ids before the piece, ``doc_tokens`` all of them with the end id. Each
    piece is the sequence ``sequence_id`` from ``offset`` 0 on; ``bucket`` is the binary
    logarithm of its length. One pass over the texts, no shuffle.

    Null and empty texts are the end id alone. Rows that repeat, also with one id, are cut
    each for itself. Texts of any length are cut whole. An empty table gives no rows.
    Other columns are not read. ``longest`` must be a power of two.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("longest must be a power of two")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = None
        for batch in batches:
            for part in text_slices(batch, "text", SLICE_BYTES):
                encoder = encoder or Encoder()
                ids, counts = encoder.encode(part.column("text"), end_id)
                cuts = [cut_lengths(int(n), longest) for n in counts]
                length = np.fromiter(chain.from_iterable(cuts), np.int64)
                row = np.repeat(np.arange(len(cuts)), [len(c) for c in cuts])
                ends = np.cumsum(length)
                start = ends - length - (np.cumsum(counts) - counts)[row]
                offsets = np.concatenate([[0], 4 * ends]).astype(np.int32)
                cells = pa.Array.from_buffers(pa.binary(), len(length), [None, pa.py_buffer(offsets), pa.py_buffer(ids.astype("<u4"))])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array(row)), pa.array(start), pa.array(length), cells, pa.array(counts[row])],
                    ["doc_id", "start", "length", "ids", "doc_tokens"])

    cut = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = cut.schema["doc_id"].dataType.simpleString()
    return cut.mapInArrow(run, f"doc_id {kind}, start long, length long, ids binary, doc_tokens long").select(
        "*", F.monotonically_increasing_id().alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
        F.log2("length").cast("int").alias("bucket"))


def digest(cut: DataFrame) -> DataFrame:
    """The pieces with a checksum in place of their ids."""
    return cut.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "bucket")


def write_buckets(cut: DataFrame, path: str) -> None:
    """Write the sequences to one folder per length, from which batches of one length are read."""
    cut.write.partitionBy("bucket").parquet(path)
