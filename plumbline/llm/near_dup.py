"""Near duplicates by a multi-index Hamming join of b-bit MinHash signatures.

A text is the set of its runs of ``width`` words. Its signature has ``SIZE``
components of 16 bits. Two sets of similarity 0.85 differ in a component with
probability 0.15, so their signatures are at a distance of at most 23 but for
fewer than one pair in 100,000. By the pigeonhole principle, of 12 chunks at least one
then has at most one differing component. Writing each chunk once per component
that may be wrong (that component left out) gives ``SIZE`` keys, and all pairs
within the distance share a key. Distance and chunks follow from the similarity asked for.

Pairs are never listed inside a key. Members are first held against the nearest of the
leaders (least and greatest node) of their keys, on full sets; only keys whose members still lie in several
components are looked at again, members outside the key's main component against
all others, in blocks of bounded size. So no link is lost and the copies of one
text cost no pairs. Full sets are kept by family (texts tied by keys), so those that are compared
meet without being sent to each other; families beyond ``BLOCK_BYTES`` are cut.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.batches import (
    NOT_SPACE, Words, distinct_sets, mix, random_words, shingle_hashes, text_slices,
)
from plumbline.llm.components import components
from plumbline.llm.stored import Stored

SIZE = 64
#: Bits of a component: few unlike texts then share the three or more components of a key.
BITS = 16
#: Share of linked pairs whose signatures may be further apart than the distance allowed.
MISSED = 1e-5
#: Members of one key that are compared in one go, and bytes of sets that a home holds.
BLOCK_MEMBERS = 512
BLOCK_BYTES = 4 << 20
#: Pairs of full sets that a task compares before its home is copied to another one.
COMPARED = 1 << 16
#: Numbers by which homes are told apart; homes that share one are one.
HOMES = 1 << 40
#: Leaders that a text is first held against; all other pairs are found after that.
LEADERS = 2
#: Hash classes of ids by which texts are filtered before they are shuffled (bounds a broadcast).
ID_CLASSES = 1 << 18
#: Below this similarity chunks become so short that unlike texts share keys.
LEAST_PERCENT = 60


def _distance_for(percent: int, size: int, missed: float) -> int:
    """Least distance that all but a share ``missed`` of the pairs of this similarity keep.

    Components that agree by chance only bring signatures closer.
    """
    differ = 1 - percent / 100
    tail, at = 1.0, -1
    while tail > missed and at < size:
        at += 1
        tail -= comb(size, at) * differ**at * (1 - differ) ** (size - at)
    return at


class _Scheme:
    """Distances and chunks for one similarity."""

    def __init__(self, percent: int) -> None:
        self.percent = percent
        self.distance = _distance_for(percent, SIZE, MISSED)
        # With one error allowed in a chunk, 2 * chunks > distance leaves one good chunk.
        self.chunks = np.array_split(np.arange(SIZE), self.distance // 2 + 1)


def _signature(flat: np.ndarray, sizes: np.ndarray, size: int, seed: int, kind: type = np.uint8) -> np.ndarray:
    """b-bit MinHash signature (rows x size, the low bits of each minimum); empty sets get zeros."""
    times, plus = random_words(size, seed) | np.uint64(1), random_words(size, seed + 1)
    result = np.zeros((len(sizes), size), kind)
    has = sizes > 0
    if has.any():
        first = (np.cumsum(sizes) - sizes)[has]
        for k in range(size):
            least = np.minimum.reduceat((flat ^ plus[k]) * times[k], first)
            result[has, k] = mix(least).astype(kind)
    return result


def _digest(flat: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """64-bit digest of each set; texts with equal sets are one node of the link graph."""
    ends = np.concatenate([[0], np.cumsum(sizes)])
    sums = np.zeros(len(flat) + 1, np.uint64)
    np.cumsum(mix(flat ^ random_words(1, 101)[0]), dtype=np.uint64, out=sums[1:])
    return mix((sums[ends[1:]] - sums[ends[:-1]]) ^ sizes.astype(np.uint64)).view(np.int64)


def _sets(batch: pa.RecordBatch, width: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for part in text_slices(batch, "text"):
        rows, values = shingle_hashes(Words(part.column("text"), NOT_SPACE), width)
        yield part, *distinct_sets(rows, values, part.num_rows)


def _binary(rows: np.ndarray) -> pa.Array:
    """A binary cell for each row of a matrix."""
    rows = np.ascontiguousarray(rows)
    rows = rows.view(np.uint8).reshape(len(rows), rows.shape[1] * rows.itemsize)
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(rows)])


def _matrix(cells: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(cells.to_pylist()), "<u2").reshape(-1, width)


def signatures(docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """(doc_id, n_shingles, node, sig) of each text; one pass, no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, flat, sizes in _sets(batch, width):
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(sizes), pa.array(_digest(flat, sizes)), _binary(_signature(flat, sizes, SIZE, 5, np.uint16))],
                    ["doc_id", "n_shingles", "node", "sig"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, "doc_id long, n_shingles long, node long, sig binary")


def _keys(groups: DataFrame, scheme: _Scheme) -> DataFrame:
    """(key, node): the chunks of a signature with one component left out, each in turn.

    The low six bits of a key are the place of the component that was left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salt, places = random_words(SIZE, 41), np.arange(SIZE, dtype=np.uint64)
        for batch in batches:
            if not batch.num_rows:
                continue
            sig = _matrix(batch.column("sig"), SIZE).astype(np.uint64)
            parts = mix(sig * random_words(SIZE, 43) + random_words(SIZE, 47))
            keys = np.empty_like(parts)
            for chunk in scheme.chunks:
                whole = parts[:, chunk].sum(axis=1, dtype=np.uint64)
                keys[:, chunk] = mix((whole[:, None] - parts[:, chunk]) ^ salt[chunk])
            keys = (keys & ~np.uint64(SIZE - 1)) | places
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.ravel().view(np.int64)), pa.array(np.repeat(batch.column("node").to_numpy(), SIZE))], ["key", "node"])

    return groups.select("node", "sig").mapInArrow(run, "key long, node long")


def _homes(members: DataFrame, groups: DataFrame, stored: Stored) -> DataFrame:
    """(node, doc_id, sig, spot) of the nodes in ``members`` that have an id; ``spot`` is the number of their home.

    Sets of one home are compared in one task. A family, texts that keys tie together, has one home; one whose
    sets take more than ``BLOCK_BYTES`` has several, to which its nodes are dealt by their hash. Families follow
    the least node of a node's keys for four steps; texts beyond that have other homes, to which sets are sent.
    """
    family = stored.table(members.groupBy("node").agg(F.min("least").alias("component")))
    for _ in range(2):
        onward = family.select(F.col("node").alias("component"), F.col("component").alias("least"))
        family = family.join(onward, "component").select("node", F.col("least").alias("component"))
    family = stored.table(family)
    sized = _among(groups.filter("doc_id is not null"), "node", family.select("node")).join(family, "node")
    # Few families are cut: each has more than BLOCK_BYTES of sets.
    cuts = (
        sized.groupBy("component").agg(F.ceil(F.sum("n_shingles") * 8 / F.lit(BLOCK_BYTES)).alias("cuts")).filter("cuts > 1")
    )
    cut = F.pmod(F.xxhash64("node"), F.coalesce("cuts", F.lit(1)))
    return sized.join(F.broadcast(cuts), "component", "left").select(
        "node", "doc_id", "sig", F.pmod(F.xxhash64("component", cut), F.lit(HOMES)).alias("spot"))


def full_sets(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """(node, spot, set) of the nodes in ``wanted`` (node, doc_id, spot), from one of their texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for part, flat, sizes in _sets(batch, width):
                nodes = _digest(flat, sizes)
                asked = part.column("node").to_numpy()
                ends = np.cumsum(sizes)
                rows = []
                for i in np.flatnonzero(nodes == asked):
                    if int(nodes[i]) not in seen:
                        seen.add(int(nodes[i]))
                        rows.append(i)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(nodes[rows]), part.column("spot").take(pa.array(rows, pa.int64())),
                     pa.array([flat[ends[i] - sizes[i] : ends[i]].tobytes() for i in rows], pa.binary())],
                    ["node", "spot", "set"])

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    # Most texts are not wanted and are filtered before the join shuffles what is left.
    texts = _among(texts, "doc_id", wanted.select("doc_id"))
    return texts.join(wanted, "doc_id").select("node", "spot", "text").mapInArrow(run, "node long, spot long, set binary")


def _among(df: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """The rows of ``df`` whose key may be in ``wanted`` (key), by hash classes, of which there are a fixed number."""
    name = F.pmod(F.xxhash64(key), F.lit(ID_CLASSES)).cast("int").alias("hash_class")
    return df.withColumn("hash_class", name).join(F.broadcast(wanted.select(name).distinct()), "hash_class", "left_semi").drop("hash_class")


def _near(pairs: DataFrame, scheme: _Scheme) -> DataFrame:
    """(a, own, lead, block, distance) of ``pairs`` whose signatures ``sig_a`` and ``sig_b`` are near."""
    names = ["a", "own", "lead", "block"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            differ = (_matrix(batch.column("sig_a"), SIZE) != _matrix(batch.column("sig_b"), SIZE)).sum(axis=1)
            near = pa.array(np.flatnonzero(differ <= scheme.distance))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).take(near) for c in names), pa.array(differ.astype(np.int32)).take(near)], [*names, "distance"])

    return pairs.select(*names, "sig_a", "sig_b").mapInArrow(run, "a long, own long, lead long, block long, distance int")


def _runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, Iterator[pa.RecordBatch]]]:
    """Rows of sorted batches by equal ``keys``, each run as a stream of parts."""
    def parts() -> Iterator[tuple[tuple, pa.RecordBatch]]:
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
            new = np.any([c[1:] != c[:-1] for c in columns], axis=0)
            cuts = [0, *(np.flatnonzero(new) + 1), batch.num_rows]
            for begin, end in zip(cuts[:-1], cuts[1:]):
                yield tuple(int(c[begin]) for c in columns), batch.slice(begin, end - begin)

    stream = parts()
    ahead = next(stream, None)
    while ahead is not None:
        key = ahead[0]

        def own() -> Iterator[pa.RecordBatch]:
            nonlocal ahead
            while ahead is not None and ahead[0] == key:
                yield ahead[1]
                ahead = next(stream, None)

        rest = own()
        yield key, rest
        for _ in rest:
            pass


def _sent(requests: DataFrame, sets: DataFrame, blocks: int) -> DataFrame:
    """(block, salt, side, node, set, others): what meets to answer ``requests`` (a, own, block, others).

    The sets of a home (side 0) meet the requests for it in one task. A request brings the set of ``a`` only
    if that has another home (``own``). A home with many requests is copied to several tasks.
    """
    sets = sets.select("node", "set", F.pmod("spot", F.lit(blocks)).alias("block"))
    if "own" not in requests.columns:
        requests = requests.join(sets.select(F.col("node").alias("a"), F.col("block").alias("own")), "a")
    # Few homes are copied: each has more than 4,096 requests or COMPARED pairs.
    salts = requests.groupBy("block").agg(
        F.ceil(F.greatest(F.count(F.lit(1)) / F.lit(4096), F.sum(F.size("others")) / F.lit(COMPARED))).cast("int").alias("salts")
    ).filter("salts > 1")
    salted = F.coalesce("salts", F.lit(1))
    held = (
        _among(sets, "block", requests.select("block")).join(F.broadcast(salts), "block", "left")
        .select("block", F.explode(F.sequence(F.lit(0), salted - 1)).alias("salt"), F.lit(0).alias("side"),
                "node", "set", F.expr("cast(null as array<long>)").alias("others"))
    )
    near = requests.filter("own = block").withColumn("set", F.expr("cast(null as binary)"))
    away = requests.filter("own <> block")
    theirs = _among(sets.select(F.col("node").alias("a"), "set"), "a", away.select("a"))
    asked = near.unionByName(away.join(theirs, "a")).join(F.broadcast(salts), "block", "left").select(
        "block", F.pmod(F.xxhash64("a"), salted).cast("int").alias("salt"), F.lit(1).alias("side"), F.col("a").alias("node"), "set", "others")
    return held.unionByName(asked)


def _confirm(requests: DataFrame, sets: DataFrame, blocks: int, scheme: _Scheme) -> DataFrame:
    """Links (a, b) among ``requests``: full sets are compared, in a task that holds one home and streams the requests."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _runs(batches, ["block", "salt"]):
            known: dict[int, np.ndarray] = {}
            for part in rows:
                found_a, found_b = [], []
                for side, node, cell, others in zip(*(part.column(c).to_pylist() for c in ("side", "node", "set", "others"))):
                    own = known[node] if cell is None else np.frombuffer(cell, np.uint64)
                    if side == 0:
                        known[node] = own
                        continue
                    for other in others:
                        its = known[other]
                        # Sets of such sizes share too little, whatever they hold.
                        if 100 * min(len(own), len(its)) < scheme.percent * max(len(own), len(its)):
                            continue
                        both = np.concatenate([own, its])
                        both.sort()
                        shared = int((both[1:] == both[:-1]).sum())
                        if 100 * shared >= scheme.percent * (len(both) - shared):
                            found_a.append(node)
                            found_b.append(other)
                yield pa.RecordBatch.from_arrays([pa.array(found_a, pa.int64()), pa.array(found_b, pa.int64())], ["a", "b"])

    return (
        _sent(requests, sets, blocks).repartition("block", "salt").sortWithinPartitions("block", "salt", "side")
        .mapInArrow(run, "a long, b long")
    )


def _open_pairs(members: DataFrame, homes: DataFrame, labels: DataFrame, scheme: _Scheme) -> DataFrame:
    """Requests for pairs that share a key, lie in different components and are near by their signatures.

    In each key only members outside its main component ask, and they meet all
    other members in blocks.
    """
    placed = (
        members.join(labels, "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
    )
    shares = placed.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"))
    mixed = (
        shares.groupBy("key").agg(
            F.count(F.lit(1)).alias("parts"), F.sum("n").alias("n"), F.max_by("component", F.struct("n", "component")).alias("main"))
        .filter("parts > 1")
        .select("key", "main", F.ceil(F.col("n") / F.lit(BLOCK_MEMBERS)).cast("int").alias("cuts"))
    )
    rows = placed.join(mixed, "key").join(homes.select("node", "sig", "spot"), "node")
    data = ["node", "component", "spot", "sig"]
    held = rows.select("key", F.pmod(F.xxhash64("node"), F.col("cuts")).cast("int").alias("cut"), F.lit(0).alias("side"), *data)
    asking = rows.filter("component <> main").select(
        "key", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)).alias("cut"), F.lit(1).alias("side"), *data)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, parts in _runs(batches, ["key", "cut"]):
            kept: list[tuple[np.ndarray, ...]] = []
            for part in parts:
                side = part.column("side").to_numpy()
                rep, part_of, home = (part.column(c).to_numpy() for c in ("node", "component", "spot"))
                place = part.column("key").to_numpy() & (SIZE - 1)
                sig = _matrix(part.column("sig"), SIZE)
                here = side == 0
                if here.any():
                    kept.append((rep[here], part_of[here], home[here], sig[here]))
                if here.all() or not kept:
                    continue
                k_rep, k_part, k_home, k_sig = (np.concatenate(x) for x in zip(*kept))
                out_a, out_own, out_block, out_others = [], [], [], []
                for i in np.flatnonzero(~here):
                    other = k_part != part_of[i]
                    same = k_sig == sig[i]
                    near = other & ((~same).sum(axis=1) <= scheme.distance)
                    at = np.flatnonzero(near)
                    if len(at):
                        # A pair counts in the first key it shares.
                        same = same[at]
                        wrong = np.stack([(~same[:, c]).sum(axis=1) for c in scheme.chunks], axis=1)
                        first = np.argmax(wrong <= 1, axis=1)
                        at = at[[_first_place(s, scheme.chunks[c], w[c]) == place[i] for s, c, w in zip(same, first, wrong)]]
                    if len(at):
                        ids, where = k_rep[at], k_home[at]
                        for b in np.unique(where):
                            out_a.append(int(rep[i]))
                            out_own.append(int(home[i]))
                            out_block.append(int(b))
                            out_others.append(ids[where == b].tolist())
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(x, pa.int64()) for x in (out_a, out_own, out_block)), pa.array(out_others, pa.list_(pa.int64()))],
                    ["a", "own", "block", "others"])

    return (
        held.unionByName(asking).repartition("key", "cut").sortWithinPartitions("key", "cut", "side")
        .mapInArrow(run, "a long, own long, block long, others array<long>")
    )


def _first_place(same: np.ndarray, chunk: np.ndarray, wrong: int) -> int:
    """The first shared key of a pair: the place left out of its first good chunk."""
    return int(chunk[0]) if wrong == 0 else int(chunk[np.argmin(same[chunk])])


def link(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, percent: int = 85) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of each row of ``docs``.

    Two texts are linked if ``100 * intersection >= percent * union`` of their sets of
    ``width``-word runs (A-Z lower-cased words between ASCII white spaces; a shorter
    text is one run). ``component_id`` is the least id reached over links and ``kept``
    tells whether it is the row's own.

    Null and empty texts, and texts without words, have no runs and are linked with
    nothing. Rows that repeat are linked like any two rows. A row without id
    belongs to the component of rows with an equal set; without such rows it is linked
    with nothing, its ``component_id`` is null and it is kept. An empty table gives no rows. Columns other than the two named are not read. ``percent`` must be
    at least 60.
    """
    return _linked(docs, id_col, text_col, width, percent).drop("node", "group")


def _linked(docs: DataFrame, id_col: str, text_col: str, width: int, percent: int) -> DataFrame:
    """The rows of :func:`link` with the digest of their set and the name of their component (null without runs)."""
    if not LEAST_PERCENT <= percent <= 100:
        raise ValueError(f"percent must lie between {LEAST_PERCENT} and 100")
    scheme = _Scheme(percent)
    stored = Stored(docs.sparkSession)
    signed = stored.table(signatures(docs, id_col, text_col, width), keep=True)
    groups = stored.table(
        signed.filter("n_shingles > 0").groupBy("node").agg(
            F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n_shingles"), F.first("sig").alias("sig")), keep=True)

    # Dealt by key once, for the counts and for the members.
    keyed = _keys(groups, scheme).repartition("key")
    shared = (
        keyed.groupBy("key").agg(
            F.count(F.lit(1)).alias("n"), F.min("node").alias("least"), F.max("node").alias("most"))
        .filter("n > 1").drop("n")
    )
    members = stored.table(keyed.join(shared, "key"))
    homes = stored.table(_homes(members, groups, stored))
    sets = stored.table(full_sets(docs, homes.drop("sig"), id_col, text_col, width))

    leaders = _near(
        members.select("node", F.explode(F.array("least", "most")).alias("lead")).filter("node <> lead").distinct()
        .join(homes.select("node", F.col("spot").alias("own"), F.col("sig").alias("sig_a")), "node")
        .join(homes.select(F.col("node").alias("lead"), F.col("spot").alias("block"), F.col("sig").alias("sig_b")), "lead")
        .withColumnRenamed("node", "a"), scheme)
    order = F.row_number().over(Window.partitionBy("a").orderBy("distance", "lead"))
    leaders = leaders.withColumn("order", order).filter(F.col("order") <= LEADERS)
    requests = leaders.groupBy("a", "own", "block").agg(F.collect_set("lead").alias("others"))
    links = stored.table(_confirm(stored.table(requests), sets, HOMES, scheme))
    labels = stored.table(components(links, stored))
    # Groups without id have no home and are linked with nothing.
    held = homes.select("node")
    pairs = stored.table(_open_pairs(members.select("key", "node").join(held, "node", "left_semi"), homes, labels, scheme))
    more = _confirm(pairs, sets, HOMES, scheme)
    # Links between components tie these components.
    label = labels.select(F.col("node").alias("a"), F.col("component").alias("of_a"))
    more = more.join(label, "a", "left").join(label.withColumnsRenamed({"a": "b", "of_a": "of_b"}), "b", "left")
    more = stored.table(more.select(F.coalesce("of_a", "a").alias("a"), F.coalesce("of_b", "b").alias("b")).distinct())
    above = stored.table(components(more, stored))
    above = above.select(F.col("node").alias("component"), F.col("component").alias("whole"))
    labels = (
        labels.unionByName(above.select(F.col("component").alias("node"), "component").join(labels.select("node"), "node", "left_anti"))
        .join(above, "component", "left").select("node", F.coalesce("whole", "component").alias("component"))
    )

    found = groups.select("node", "doc_id").join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = found.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = stored.table(found.join(least, "component").select("node", "component_id", F.col("component").alias("group")), keep=True)
    result = signed.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("node")).alias("node"))
    result = result.join(named, "node", "left").select(
        "doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        "node", "group")
    stored.close()
    return result.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()))


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` without near duplicates, with all their columns: of each component of
    ``link`` the row of the least id stays.

    Rows that share an id are judged each by its own text: those of one component, and those without
    runs, are one document, of which a row of the least text stays. Of rows without id, those
    stay whose set of runs no row with an id has, one for each set; rows without id and
    without runs all stay.
    """
    stored = Stored(docs.sparkSession)
    names = [f"c{i}" for i in range(len(docs.columns))]
    lower = [c.lower() for c in docs.columns]
    own, text = names[lower.index(id_col.lower())], names[lower.index(text_col.lower())]
    rows = docs.toDF(*names)
    linked = stored.table(_linked(rows, own, text, width, percent), keep=True)
    several = linked.filter("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("doc_id")
    removed = linked.filter("not kept and doc_id is not null").join(several, "doc_id", "left_anti").select(F.col("doc_id").alias("gone"))
    rest = rows.join(removed, F.col(own).cast("long") == F.col("gone"), "left_anti")
    if not several.isEmpty() or not linked.filter("doc_id is null").isEmpty():
        held = linked.filter("doc_id is not null").select("node").distinct()
        # Rows without an id of their own carry their texts through the same digest; a number tells them apart.
        again = several.select(F.col("doc_id").alias("again"))
        odd = rest.join(again, F.col(own).cast("long") == F.col("again"), "left").filter(F.col(own).isNull() | F.col("again").isNotNull())
        odd = stored.table(odd.withColumn("row", F.monotonically_increasing_id()), keep=True)
        nodes = signatures(odd, "row", text, width).select(F.col("doc_id").alias("row"), "n_shingles", "node")
        nodes = stored.table(nodes.join(odd.select("row", "again", F.sha2(F.coalesce(F.col(text).cast("string"), F.lit("")), 256).alias("mark")), "row"), keep=True)
        plain = nodes.filter("again is null")
        chosen = plain.filter("n_shingles > 0").join(held, "node", "left_anti").groupBy("node").agg(F.min("row").alias("row")).select("row")
        chosen = chosen.unionByName(plain.filter("n_shingles = 0").select("row"))
        # Of an id's rows: one of each component whose least id it is, and one without runs.
        kept = linked.filter("kept and n_shingles > 0").select(F.col("doc_id").alias("again"), "node", "group").distinct()
        first = F.min(F.struct("mark", "row")).alias("first")
        chosen = chosen.unionByName(
            nodes.filter("n_shingles > 0").join(kept, ["again", "node"]).groupBy("again", "group").agg(first).select("first.row"))
        chosen = chosen.unionByName(nodes.filter("again is not null and n_shingles = 0").groupBy("again").agg(first).select("first.row"))
        odd = odd.join(chosen, "row", "left_semi").select(*names)
        single = rest.filter(F.col(own).isNotNull()).join(again, F.col(own).cast("long") == F.col("again"), "left_anti")
        rest = single.unionByName(odd)
    return rest.select(*names).toDF(*docs.columns)
