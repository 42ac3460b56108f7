"""The trie of conversations that begin alike, by fixed-length block hashing.

A turn is a 120-bit digest and its length; texts are read once and not shuffled. Digest and depth
of a turn give two 64-bit words, and a prefix is known by the exclusive or of its turns' words. That
can be put together from pieces, so a conversation of any length is cut: conversations become blocks of ``BLOCK``
turns, and the prefixes at block ends are running values over the blocks.

Conversations are grouped by the prefix after each block first: equal blocks after an equal prefix become one
row with the number of its members. Where a prefix has one following block only, the nodes inside it are a
chain with the same members. Only where sibling blocks diverge are their turns grouped one by one.

Sums over subtrees need no walk up the tree. Every node belongs to its smallest member; what a subtree
holds is what all members of its top own, but for what the smallest owns above the top.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.spread import keyed_join, running
from plumbline.llm.stored import Stored

#: Turns of a block.
BLOCK = 4
#: Characters of joined ids that travel as one row.
PIECE = 1 << 16


def turn_digests(
    conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
) -> DataFrame:
    """(conv_id, turn, a, b, size) of all turns: two halves of a digest of role and text, and the text's code points.

    Null roles and texts are empty. Rows without a conversation are left out. Other columns are not read.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    digest = F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text))
    # The two halves of 30 of the 32 digits; 60 bits fit into a long.
    half = lambda i: F.conv(F.substring(digest, i, 15), 16, 10).cast("long")
    return conversations.select(
        F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), half(1).alias("a"), half(16).alias("b"),
        F.char_length(text).cast("long").alias("size")).filter("conv_id is not null")


def ordered(digests: DataFrame, stored: Stored) -> DataFrame:
    """(conv_id, a, b, size, place): turns in order, those without a number first, equal numbers by their digests."""
    order = [F.col("turn").isNotNull(), F.coalesce("turn", F.lit(0)), "a", "b"]
    return running(digests.select("conv_id", "turn", "a", "b", "size"), "conv_id", order, stored).drop("turn")


def rebuilt(conversations: DataFrame, stored: Stored | None = None, shared: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """(ids, turns) of conversations that share beginnings.

    Each conversation c gets the first h turns of conversation c - c % ``shared`` (all if it has fewer, none if
    it is not there) before its own turns after its first h; h is the crc32 of c's decimal digits modulo ``most``.
    ``ids`` has all conversations, also those left without turns.
    """
    stored = stored or Stored(conversations.sparkSession)
    own = stored.table(ordered(turn_digests(conversations), stored), keep=True)
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).alias("h")
    ids = stored.table(own.filter("place = 0").select("conv_id"), keep=True)
    # A base has fewer than ``most`` turns to give and fewer than 2 * ``shared`` takers.
    base = own.filter((F.col("conv_id") % shared == 0) & (F.col("place") < most - 1)).select(F.col("conv_id").alias("base"), "place", "a", "b", "size")
    heads = ids.select("conv_id", h, (F.col("conv_id") - F.col("conv_id") % shared).alias("base")).join(base, "base").filter("place < h")
    rest = own.withColumn("h", h).filter("place >= h")
    columns = ["conv_id", "side", "place", "a", "b", "size"]
    both = heads.withColumn("side", F.lit(0)).select(*columns).unionByName(rest.withColumn("side", F.lit(1)).select(*columns))
    turns = running(both.withColumnRenamed("place", "old"), "conv_id", ["side", "old"], stored)
    return ids, turns.select("conv_id", "place", "a", "b", "size")


def _blocks(turns: DataFrame, stored: Stored, block: int) -> DataFrame:
    """(conv_id, block, px, py, kx, ky, turns, x0, y0, s0, ...): blocks with the words of the prefixes before and after them."""
    depth = F.col("place") + 1
    words = turns.select(
        "conv_id", F.floor(F.col("place") / block).alias("block"), (F.col("place") % block).alias("slot"), "size",
        F.xxhash64(F.lit(1), "a", "b", depth).alias("x"), F.xxhash64(F.lit(2), "a", "b", depth).alias("y"))
    slots = [F.max(F.when(F.col("slot") == i, F.col(c))).alias(f"{n}{i}") for i in range(block) for c, n in (("x", "x"), ("y", "y"), ("size", "s"))]
    cut = words.groupBy("conv_id", "block").agg(F.count(F.lit(1)).alias("turns"), F.bit_xor("x").alias("kx"), F.bit_xor("y").alias("ky"), *slots)
    found = running(cut, "conv_id", ["block"], stored, xors=("kx", "ky")).withColumnsRenamed({"kx_before": "px", "ky_before": "py"})
    return found.withColumn("kx", F.col("kx").bitwiseXOR(F.col("px"))).withColumn("ky", F.col("ky").bitwiseXOR(F.col("py"))).drop("place")


def _inside(blocks: DataFrame, block: int, measures: dict[str, str]) -> DataFrame:
    """(kx, ky, qx, qy, depth, size, ...) of the nodes inside of different blocks; q is the node above.

    ``measures`` names columns and how they come together (sum or min). Blocks marked ``diverges`` are refined:
    their turns are grouped with those of their siblings.
    """
    def words(name: str, upto: int) -> Column:
        return reduce(lambda a, b: a.bitwiseXOR(b), [F.col(f"p{name}"), *(F.col(f"{name}{i}") for i in range(upto))])

    slot = [F.struct(
        words("x", i + 1).alias("kx"), words("y", i + 1).alias("ky"), words("x", i).alias("qx"), words("y", i).alias("qy"),
        (F.col("block") * block + i + 1).cast("long").alias("depth"), F.col(f"s{i}").alias("size")) for i in range(block)]
    turns = blocks.select("diverges", *measures, F.explode(F.slice(F.array(*slot), F.lit(1), F.col("turns").cast("int"))).alias("n")).select(
        "diverges", "n.*", *measures)
    how = {"sum": F.sum, "min": F.min}
    refined = turns.filter("diverges").groupBy("kx", "ky").agg(
        *(F.max(c).alias(c) for c in ("qx", "qy", "depth", "size")), *(how[f](c).alias(c) for c, f in measures.items()))
    return turns.filter("not diverges").drop("diverges").unionByName(refined)


def _ends(ends: DataFrame) -> DataFrame:
    """(kx, ky, ends_sha256) of (kx, ky, conv_id): hash of the ids in ascending order, comma-joined.

    Ids are sorted over ranges and joined to pieces of bounded size there; one hash then streams over
    the pieces of its node.
    """
    ranges = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y, ids = (batch.column(c).to_numpy() for c in ("kx", "ky", "conv_id"))
            cuts = [0, *(np.flatnonzero((x[1:] != x[:-1]) | (y[1:] != y[:-1])) + 1), batch.num_rows]
            # An id has at most 20 characters with its comma.
            spans = [(a, min(a + PIECE // 20, end)) for begin, end in zip(cuts[:-1], cuts[1:]) for a in range(begin, end, PIECE // 20)]
            at = [a for a, _ in spans]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x[at]), pa.array(y[at]), pa.array(ids[at]), pa.array([",".join(map(str, ids[a:b].tolist())) for a, b in spans])],
                ["kx", "ky", "first", "piece"])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = None, None
        for batch in batches:
            done = []
            for x, y, piece in zip(*(batch.column(c).to_pylist() for c in ("kx", "ky", "piece"))):
                if (x, y) != current:
                    if current is not None:
                        done.append((*current, state.hexdigest()))
                    current, state = (x, y), hashlib.sha256()
                else:
                    state.update(b",")
                state.update(piece.encode())
            yield _rows(done)
        if current is not None:
            yield _rows([(*current, state.hexdigest())])

    def _rows(done: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([
            pa.array([d[0] for d in done], pa.int64()), pa.array([d[1] for d in done], pa.int64()), pa.array([d[2] for d in done], pa.string())],
            ["kx", "ky", "ends_sha256"])

    pieces = ends.select("kx", "ky", "conv_id").repartitionByRange(ranges, "kx", "ky", "conv_id").sortWithinPartitions("kx", "ky", "conv_id").mapInArrow(
        join, "kx long, ky long, first long, piece string")
    return pieces.repartition("kx", "ky").sortWithinPartitions("kx", "ky", "first").mapInArrow(hashed, "kx long, ky long, ends_sha256 string")


def nodes(ids: DataFrame, turns: DataFrame, stored: Stored, block: int = BLOCK) -> DataFrame:
    """The nodes of the trie of ``turns`` (conv_id, place, a, b, size), whose conversations are ``ids`` (conv_id).

    Per node: conv_id, its smallest member; depth; parent_conv_id, that of the node above (null at the root); n_convs,
    its members; n_children; n_leaves, the nodes without children in its subtree; saved_tokens, the sum over
    its subtree of each node's (members - 1) times the code points of its last text; ends_sha256, the hash
    of the ids of those members that end at the node, ascending and joined by commas. The root has all
    conversations, also those without turns. Without conversations there are no nodes.
    """
    blocks = stored.table(_blocks(turns, stored, block))
    slots = [f"{c}{i}" for i in range(block) for c in "xys"]
    key = ["block", "px", "py", "turns", "kx", "ky"]
    different = stored.table(blocks.groupBy(*key).agg(
        F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id"), *(F.max(c).alias(c) for c in slots)))
    siblings = stored.table(different.groupBy("block", "px", "py").agg((F.count(F.lit(1)) > 1).alias("diverges")))
    different = stored.table(keyed_join(different, siblings, ["block", "px", "py"]))

    root = ids.agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id")).filter("n_convs > 0")
    zero = F.lit(0).cast("long")
    root = root.select(*(zero.alias(c) for c in ("kx", "ky")), *(F.lit(None).cast("long").alias(c) for c in ("qx", "qy")),
                       zero.alias("depth"), zero.alias("size"), "n_convs", "conv_id")
    tree = stored.table(_inside(different, block, {"n_convs": "sum", "conv_id": "min"}).unionByName(root))
    children = tree.filter("depth > 0").groupBy(F.col("qx").alias("kx"), F.col("qy").alias("ky")).agg(F.count(F.lit(1)).alias("n_children"))
    tree = stored.table(tree.join(children, ["kx", "ky"], "left").withColumn("n_children", F.coalesce("n_children", zero)).withColumn(
        "saved", (F.col("n_convs") - 1) * F.col("size")))

    # What each conversation owns, and what the smallest member owns above each node.
    owned = stored.table(tree.groupBy("conv_id").agg(F.sum((F.col("n_children") == 0).cast("long")).alias("leaves"), F.sum("saved").alias("owned")))
    above = running(tree.select("conv_id", "depth", "kx", "ky", "saved"), "conv_id", ["depth"], stored, sums=("saved",)).select("kx", "ky", "saved_before")
    weighted = keyed_join(blocks.select("conv_id", *key), owned, ["conv_id"], "inner")
    sums = weighted.groupBy(*key).agg(F.sum("leaves").alias("leaves"), F.sum("owned").alias("owned"))
    below = _inside(different.drop("n_convs", "conv_id").join(sums, key), block, {"leaves": "sum", "owned": "sum"}).select("kx", "ky", "leaves", "owned")
    whole = owned.agg(F.sum("leaves").alias("leaves"), F.sum("owned").alias("owned")).select(zero.alias("kx"), zero.alias("ky"), "leaves", "owned")
    below = below.unionByName(whole)

    last = blocks.groupBy("conv_id").agg(F.max_by(F.struct("kx", "ky"), "block").alias("last"))
    ends = stored.table(ids.join(last, "conv_id", "left").select(
        "conv_id", F.coalesce("last.kx", zero).alias("kx"), F.coalesce("last.ky", zero).alias("ky")))
    result = stored.table(
        tree.join(above, ["kx", "ky"]).join(below, ["kx", "ky"], "left").join(_ends(ends), ["kx", "ky"], "left").select(
            "conv_id", "depth", "qx", "qy", "n_convs", "n_children", F.coalesce("leaves", zero).alias("n_leaves"),
            (F.coalesce("owned", zero) - F.col("saved_before")).alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256")), keep=True)
    parents = stored.table(tree.select(F.col("kx").alias("qx"), F.col("ky").alias("qy"), F.col("conv_id").alias("parent_conv_id")), keep=True)
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    top = result.filter("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long")).select(*columns)
    return keyed_join(result.filter("depth > 0"), parents, ["qx", "qy"]).select(*columns).unionByName(top)


def trie(conversations: DataFrame, **columns: str) -> DataFrame:
    """The nodes (see ``nodes``) of the trie of a table of conversations; ``columns`` as for ``turn_digests``.

    Turns are ordered by number, those without one first; equal numbers by a digest of role and text, so
    repeated rows are turns each. Null roles and texts are empty. An empty table gives no nodes.
    """
    stored = Stored(conversations.sparkSession)
    turns = stored.table(ordered(turn_digests(conversations, **columns), stored))
    result = nodes(turns.filter("place = 0").select("conv_id"), turns, stored)
    stored.close()
    return result


def rebuilt_trie(conversations: DataFrame) -> DataFrame:
    """The nodes of the trie of ``rebuilt`` conversations."""
    stored = Stored(conversations.sparkSession)
    ids, turns = rebuilt(conversations, stored)
    result = nodes(ids, turns, stored)
    stored.close()
    return result
