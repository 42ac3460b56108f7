"""Scores of a Brown class-based bigram model.

Words are counted over the whole corpus. Every word seen at least ``LEAST_SEEN`` times is
a unit of its own, the others share units by their last letters, and the end of a text is
a unit. Exchange clustering moves units between classes while that raises the likelihood
of the class bigrams; a text's probability is that of its class transitions times that
of each word in its class.

The number of units follows the corpus. Their pairs are a stored table; counts and classes of the most
frequent words, up to a parameter, are broadcast; those of all rarer ones, which no hot key can
hide among, are stored tables that come by joins.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.batches import NOT_SPACE, Words, mix, random_words, text_slices
from plumbline.llm.stored import Stored, share, shared

#: Words seen this often are units. It smooths: pairs of rarer words say little about their class.
LEAST_SEEN = 5
#: Units that all rarer words share, and classes.
SHAPES, CLASSES = 1024, 64
#: Steps of exchange at most; each moves a third of the units. Three steps that together raise the
#: likelihood by less than this share end it.
ROUNDS, TOLERANCE = 6, 1e-4
#: Words whose counts and classes are broadcast to tasks; those of all others come by a join.
WORDS_AT_HAND = 1 << 20
#: Weight of the class frequencies in the transition probabilities.
PRIOR = 4.0
#: Entries that a task gathers before it hands them on.
GATHERED = 1 << 21
#: Entries in a stored cell, and pairs given as rows that a task folds at once.
FOLDED = 1 << 18
#: Tokens whose pairs go to one block of the pair table.
BLOCK = 1 << 20


@dataclass
class Model:
    """Classes and probabilities; ``words``, ``counts`` and ``classes`` are those of the words at hand."""

    words: np.ndarray
    counts: np.ndarray
    classes: np.ndarray
    class_of_shape: np.ndarray
    transition: np.ndarray
    room: np.ndarray
    tokens: int
    kinds: int
    ends: int
    #: Whether words that are not at hand may be units of their own.
    more_units: bool

    def floor(self) -> float:
        """log10 of the room that all words share in the base score."""
        return float(np.log10(self.tokens + 0.5 * (self.kinds + 1)))


def _at_hand(known: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place among the sorted ``known``, whether it is there) of each hash."""
    if not len(known):
        return np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
    # Sorted, so that look-ups next to each other meet in the processor's cache.
    order = np.argsort(hashes)
    at = np.empty(len(hashes), np.int64)
    at[order] = np.minimum(np.searchsorted(known, hashes[order]), len(known) - 1)
    return at, known[at] == hashes


def _shapes(words: Words) -> np.ndarray:
    """A number below ``SHAPES`` from the last three bytes of each word."""
    value = np.zeros(len(words.start), np.uint64)
    for i in range(1, 4):
        at = words.end - i
        byte = np.where(at >= words.start, words.data[np.maximum(at, 0)], 0) if len(words.data) else at
        value = value * np.uint64(257) + byte.astype(np.uint64)
    return (mix(value) % np.uint64(SHAPES)).astype(np.int64)


def _sequences(words: Words, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(unit, row) of all tokens, with the end of each text as unit 0."""
    ends = np.cumsum(words.count)
    return np.insert(units, ends, 0), np.insert(words.doc, ends, np.arange(words.rows))


def _gathered(parts: Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Sums (key, count, extra) over the parts of a task, in tables of bounded size."""
    held, size = [], 0

    def merged():
        keys = np.concatenate([h[0] for h in held])
        keys, first, index = np.unique(keys, return_index=True, return_inverse=True)
        counts = np.bincount(index, weights=np.concatenate([h[1] for h in held]), minlength=len(keys)).astype(np.int64)
        return keys, counts, np.concatenate([h[2] for h in held])[first]

    for part in parts:
        held.append(part)
        size += len(part[0])
        if size > GATHERED:
            held = [merged()]
            size = len(held[0][0])
            if size > GATHERED // 2:
                yield held[0]
                held, size = [], 0
    if held:
        yield merged()


def _word_counts(train: DataFrame) -> DataFrame:
    """(word, n, shape) of all different words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def parts():
            for batch in batches:
                for part in text_slices(batch, "text"):
                    words = Words(part.column("text"), NOT_SPACE)
                    names, first, n = np.unique(words.hashes(), return_index=True, return_counts=True)
                    yield names, n, _shapes(words)[first]

        for names, n, shapes in _gathered(parts()):
            yield pa.RecordBatch.from_arrays(
                [pa.array(names.view(np.int64)), pa.array(n), pa.array(shapes.astype(np.int32))], ["word", "n", "shape"])

    counted = train.mapInArrow(run, "word long, n long, shape int")
    return counted.groupBy("word").agg(F.sum("n").alias("n"), F.min("shape").alias("shape"))


#: Bits of a pair: its first or second word is not at hand.
_FAR = (1, 2)


def _split(df: DataFrame, bit: int) -> tuple[DataFrame, DataFrame]:
    has = F.col("bits").bitwiseAND(F.lit(bit)) != 0
    return df.filter(~has), df.filter(has)


def _runs(*columns: np.ndarray) -> np.ndarray:
    """Where runs of equal entries begin."""
    new = np.ones(len(columns[0]), bool)
    if len(new):
        new[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    return np.flatnonzero(new)


def _cells(lead: list[pa.Array], first: np.ndarray, columns: list[np.ndarray], names: list[str]) -> pa.RecordBatch:
    """A row for each run of entries: its ``lead``, then the run's bytes of each column."""
    cuts = np.append(first, len(columns[0]))
    packed = [
        pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer((cuts * c.itemsize).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(c))])
        for c in columns]
    return pa.RecordBatch.from_arrays([*lead, *packed], names)


def _entries(batch: pa.RecordBatch, name: str, kind: type) -> np.ndarray:
    """The entries of all cells of a column, one after another."""
    column = batch.column(name).cast(pa.large_binary())
    _, offsets, data = column.buffers()
    if not len(column) or data is None:
        return np.zeros(0, kind)
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]].view(kind)


def _summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct keys, sums, place of one of its entries) in ascending order."""
    order = np.argsort(keys)
    keys = keys[order]
    first = _runs(keys)
    return keys[first], np.add.reduceat(n[order], first) if len(first) else n[:0], order[first]


def _pair_hashes(before: np.ndarray, unit: np.ndarray) -> np.ndarray:
    keys = random_words(2, 31) | np.uint64(1)
    with np.errstate(over="ignore"):
        return mix(mix(before.view(np.uint64) * keys[0]) + unit.view(np.uint64) * keys[1])


def _pair_cells(train: DataFrame, hand: tuple[np.ndarray, np.ndarray], weight: np.ndarray, least: int) -> DataFrame:
    """(far, before, unit, n) of units that follow each other, packed; a text begins after the end of another.

    ``hand`` are the sorted hashes and the counts of words at hand, which were seen ``least`` times or more, ``weight`` the
    counts of units at hand. Unit 0 is the end of a text, then come the shapes, then the frequent words at hand; other
    units go by their hash. A cell holds pairs of units at hand as 32-bit numbers, or, if ``far``, pairs with another
    word as 64-bit numbers.

    Pairs of a unit at hand lie in one block; those of a unit with more tokens than a block are cut by the unit after it.
    """
    width, total = len(weight), max(int(weight.sum()), 1)
    blocks = 1 + total // BLOCK
    sent = share(train.sparkSession, (*hand, weight))
    more = least > LEAST_SEEN
    names = ["block", "far", "before", "unit", "n"]

    def cells(block: np.ndarray, far: bool, columns: list[np.ndarray]) -> pa.RecordBatch:
        first = _runs(block)
        return _cells([pa.array(block[first].astype(np.int32)), pa.array(np.full(len(first), far))], first, columns, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, seen, weight = shared(sent)
        own = seen >= LEAST_SEEN
        place = SHAPES + np.cumsum(own)
        lower = np.cumsum(weight) - weight

        def packed(keys: list[np.ndarray], others: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
            key = np.sort(np.concatenate(keys))
            first = _runs(key)
            n = np.diff(np.append(first, len(key)))
            before, unit = np.divmod(key[first], width)
            # Never falls as keys rise.
            at = lower[before] + weight[before] * (lower[unit] / total)
            block = np.minimum((at * (blocks / total)).astype(np.int64), blocks - 1)
            yield cells(block, False, [before.astype(np.int32), unit.astype(np.int32), n])
            before, unit = (np.concatenate(x) for x in zip(*others))
            pair, n, first = _summed(_pair_hashes(before, unit), np.ones(len(before), np.int64))
            block = ((pair >> np.uint64(32)) * np.uint64(blocks) >> np.uint64(32)).astype(np.int64)
            yield cells(block, True, [before[first], unit[first], n])

        keys, others, size = [], [], 0
        for batch in batches:
            for part in text_slices(batch, "text"):
                words = Words(part.column("text"), NOT_SPACE)
                hashes = words.hashes()
                at, there = _at_hand(known, hashes)
                units = 1 + _shapes(words)
                frequent = there.copy()
                frequent[there] = own[at[there]]
                units[frequent] = place[at[frequent]]
                far = ~there & more
                units[far] = hashes.view(np.int64)[far]
                units, _ = _sequences(words, units)
                far = np.insert(far, np.cumsum(words.count), False)
                before = np.concatenate([[0], units[:-1]])
                far[1:] |= far[:-1].copy()
                keys.append(before[~far] * width + units[~far])
                others.append((before[far], units[far]))
                size += len(units)
                if size >= GATHERED:
                    yield from packed(keys, others)
                    keys, others, size = [], [], 0
        if size:
            yield from packed(keys, others)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed(before: np.ndarray, unit: np.ndarray, n: np.ndarray, far: bool) -> pa.RecordBatch:
            first = np.arange(0, len(n), FOLDED)
            return _cells([pa.array(np.full(len(first), far))], first, [before, unit, n], names[1:])

        def near(key: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            before, unit = np.divmod(key, width)
            return packed(before.astype(np.int32), unit.astype(np.int32), n, False)

        def merged(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
            return _summed(*(np.concatenate(x) for x in zip(*held)))[:2]

        held, size = [], 0
        for batch in batches:
            is_far = batch.column("far")
            part = batch.filter(is_far)
            if part.num_rows:
                before, unit, n = (_entries(part, c, np.int64) for c in ("before", "unit", "n"))
                _, n, first = _summed(_pair_hashes(before, unit), n)
                yield packed(before[first], unit[first], n, True)
                batch = batch.filter(pc.invert(is_far))
            before, unit = (_entries(batch, c, np.int32).astype(np.int64) for c in ("before", "unit"))
            held.append((before * width + unit, _entries(batch, "n", np.int64)))
            size += len(before)
            if size > GATHERED:
                held = [merged(held)]
                size = len(held[0][0])
                if size > GATHERED // 2:
                    yield near(*held[0])
                    held, size = [], 0
        if size:
            yield near(*merged(held))

    found = train.mapInArrow(run, "block int, far boolean, before binary, unit binary, n binary").repartitionById(blocks, "block")
    return found.mapInArrow(merge, "far boolean, before binary, unit binary, n binary")


def _far_pairs(cells: DataFrame, counts: DataFrame, width: int, least: int, stored: Stored) -> DataFrame:
    """(before, unit, bits, n) of the ``far`` cells, words that are no units of their own given by their shapes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                before, unit, n = (_entries(batch.slice(i, 1), c, np.int64) for c in ("before", "unit", "n"))
                bits = sum(bit * ((x < 0) | (x >= width)) for bit, x in zip(_FAR, (before, unit)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(before), pa.array(unit), pa.array(bits.astype(np.int32)), pa.array(n)], ["before", "unit", "bits", "n"])

    found = cells.filter("far").mapInArrow(run, "before long, unit long, bits int, n long")
    rare = counts.filter(F.col("n") < least).select("word", "n", "shape").withColumn("own", F.col("n") >= LEAST_SEEN).drop("n")
    for i, column in enumerate(("before", "unit")):
        found = stored.table(found)
        near, far = _split(found, _FAR[i])
        far = far.join(rare, F.col(column) == F.col("word")).withColumns({
            column: F.when(F.col("own"), F.col("word")).otherwise(F.col("shape") + 1).cast("long"),
            "bits": F.when(F.col("own"), F.col("bits")).otherwise(F.col("bits") - _FAR[i])})
        found = near.unionByName(far.select(*found.columns))
    return found.groupBy("before", "unit", "bits").agg(F.sum("n").alias("n"))


def _most_frequent(counts: DataFrame, most: int) -> int:
    """Least count of the words that are taken when no more than ``most`` may be."""
    level = F.floor(F.log2(F.col("n").cast("double")) * 64).cast("int")
    levels = counts.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("kinds"), F.min("n").alias("least")).collect()
    taken, least = 0, None
    for r in sorted(levels, key=lambda r: -r.level):
        taken += r.kinds
        if taken > most:
            break
        least = r.least
    return least if least is not None else (max((r.least for r in levels), default=0) + 1 << 40)


def _plogp(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def _likelihood(pairs: np.ndarray) -> float:
    return float(_plogp(pairs).sum() - _plogp(pairs.sum(axis=0)).sum() - _plogp(pairs.sum(axis=1)).sum())


def _gains(row: np.ndarray, near: np.ndarray, n: np.ndarray, own: np.ndarray, joint: np.ndarray) -> np.ndarray:
    """Change of the likelihood when a unit joins each class (units x classes), all others staying.

    It is exact but for a unit that follows itself. Entries say that unit ``row`` (ascending) has ``n`` neighbours of class ``near``, which counts the classes
    that follow it and then those before it; ``own`` is each unit's class.
    """
    classes = len(joint)
    total = np.zeros((len(own), classes))
    for side, table in enumerate((joint, joint.T)):
        mine = (near // classes) == side
        unit, other, times = row[mine], near[mine] % classes, n[mine].astype(np.float64)
        if not len(unit):
            continue
        size, cells = table.sum(axis=1), _plogp(table)
        first = np.flatnonzero(np.concatenate([[True], unit[1:] != unit[:-1]]))
        held = unit[first]
        weight = np.add.reduceat(times, first)
        joined = _plogp(table.T[other] + times[:, None]) - cells.T[other]
        at = own[unit]
        left = _plogp(np.maximum(table[at, other] - times, 0)) - cells[at, other]
        change = np.add.reduceat(joined + left[:, None], first, axis=0)
        change -= _plogp(size[None] + weight[:, None]) - _plogp(size)[None]
        at = own[held]
        change -= (_plogp(np.maximum(size[at] - weight, 0)) - _plogp(size[at]))[:, None]
        total[held] += change
    # Four cells lie in a changed row and in a changed column: there both changes come together.
    after, before = np.zeros(total.shape), np.zeros(total.shape)
    follows = near < classes
    after[row[follows], near[follows]] = n[follows]
    before[row[~follows], near[~follows] - classes] = n[~follows]
    every = np.arange(len(own))
    here, back = after[every, own][:, None], before[every, own][:, None]
    both = np.diag(joint)[None]
    for cell, one, other in (
        (both, after, before), (joint[:, own].T, here, -before), (joint[own], -after, back), (both[:, own].T, -here, -back),
    ):
        f = lambda x: _plogp(np.maximum(x, 0))
        total += f(cell + one + other) - f(cell + one) - f(cell + other) + f(cell)
    total[every, own] = 0
    return total


def _dealt(names: np.ndarray, hands: int) -> np.ndarray:
    """A number below ``hands`` for each unit, by its hash, wherever the unit is kept."""
    return mix(names.astype(np.int64).view(np.uint64)) % np.uint64(hands)


def _hands(weight: np.ndarray, classes: int) -> tuple[np.ndarray, int]:
    """(part of each unit at hand, number of parts) so that parts hold about as many neighbours by class."""
    blocks = 1 + int(weight.sum()) // BLOCK
    most = np.cumsum(np.minimum(2 * weight, 2 * classes * blocks) + 1)
    hands = 1 + int(most[-1]) // (3 * BLOCK // 2)
    return ((most - 1) * hands // most[-1]).astype(np.int32), hands


def _by_class(u: np.ndarray, own: np.ndarray, near: np.ndarray, n: np.ndarray) -> list[np.ndarray]:
    """Sums of the entries of the same unit and class, in the order of these."""
    if len(u) and u.max() < np.uint64(1 << 40):
        order = np.argsort(u * np.uint64(1 << 16) + near.astype(np.uint64))
    else:
        order = np.lexsort((near, u))
    u, near = u[order], near[order]
    first = _runs(u, near)
    return [u[first], own[order[first]], near[first], np.add.reduceat(n[order], first) if len(first) else n[:0]]


_SIDES = {"u": np.uint64, "own": np.int16, "near": np.int16, "n": np.int64}


def _neighbours(
    pairs: DataFrame | None, cells: DataFrame | None, names: np.ndarray, class_of: np.ndarray, far: DataFrame | None,
    hands: tuple[np.ndarray, int], turn: int, classes: int,
) -> DataFrame:
    """(hand, u, own, near, n), packed: the neighbours by class of each unit of a turn; and the class pairs.

    No unit has the turn -1. ``names`` and ``class_of`` are the hashes and classes of units at hand, ``far`` has (unit, class) of the
    others. All entries of a unit have one ``hand`` and lie next to each other, ``near`` ascending. Class pairs, their classes
    ``own`` and ``near``, have the hand after the last.
    """
    some = pairs if pairs is not None else cells
    sent = share(some.sparkSession, (class_of, (_dealt(names, 3).astype(np.int64) == turn) & (np.arange(len(names)) > 0), hands[0]))
    last, columns = hands[1], list(_SIDES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        its, turns, hand_of = shared(sent)
        joint = np.zeros(classes * classes)

        def folded(before: np.ndarray, unit: np.ndarray, n: np.ndarray, *known: np.ndarray) -> list[np.ndarray]:
            if known:
                sides = list(zip((before, unit), known))
                a, b = (np.where(c >= 0, _dealt(x, 3).astype(np.int64) == turn, turns[np.where(c >= 0, 0, x)]) for x, c in sides)
                old, new = (np.where(c >= 0, c, its[np.where(c >= 0, 0, x)]) for x, c in sides)
            else:
                a, b, old, new = turns[before], turns[unit], its[before], its[unit]
            joint[:] += np.bincount(old.astype(np.int64) * classes + new, weights=n, minlength=len(joint))
            return _by_class(
                np.concatenate([before[a], unit[b]]).astype(np.int64).view(np.uint64),
                np.concatenate([old[a], new[b]]).astype(np.int16), np.concatenate([new[a], old[b] + classes]).astype(np.int16),
                np.concatenate([n[a], n[b]]).astype(np.int64))

        def parts() -> Iterator[list[np.ndarray]]:
            held, size = [], 0
            for batch in batches:
                if batch.schema.names[0] == "far":
                    for i in range(batch.num_rows):
                        cell = batch.slice(i, 1)
                        yield folded(_entries(cell, "before", np.int32), _entries(cell, "unit", np.int32), _entries(cell, "n", np.int64))
                    continue
                held.append([c.to_numpy() for c in batch.columns])
                size += batch.num_rows
                if size >= FOLDED:
                    yield folded(*(np.concatenate(x) for x in zip(*held)))
                    held, size = [], 0
            if size:
                yield folded(*(np.concatenate(x) for x in zip(*held)))

        def packed(u: np.ndarray, *rest: np.ndarray) -> pa.RecordBatch:
            near = u < np.uint64(len(hand_of))
            hand = np.where(near, hand_of[np.where(near, u, np.uint64(0)).astype(np.int64)], (u >> np.uint64(32)) * np.uint64(last) >> np.uint64(32))
            first = _runs(hand)
            return _cells([pa.array(hand[first].astype(np.int32))], first, [u, *rest], ["hand", *columns])

        for part in _merged(parts()):
            yield packed(*part)
        some = np.flatnonzero(joint)
        yield _cells(
            [pa.array([last], pa.int32())], np.zeros(1, np.int64),
            [some.astype(np.uint64), (some // classes).astype(np.int16), (some % classes).astype(np.int16), joint[some].astype(np.int64)], ["hand", *columns])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hand = None

        def parts() -> Iterator[list[np.ndarray]]:
            nonlocal hand
            for batch in batches:
                if batch.num_rows:
                    hand = batch.column("hand")[0]
                    yield [_entries(batch, c, kind) for c, kind in _SIDES.items()]

        # A unit must not be cut, so all of a hand are held.
        for part in _merged(parts(), whole=True):
            new = _runs(part[0])
            first = new[_runs(new // FOLDED)]
            yield _cells([pa.array([hand.as_py()] * len(first), pa.int32())], first, part, ["hand", *columns])

    schema = "hand int, u binary, own binary, near binary, n binary"
    found = []
    if cells is not None:
        found.append(cells.mapInArrow(run, schema))
    if pairs is not None:
        nothing = F.lit(-1)
        if far is None:
            ready = pairs.select(F.col("before").cast("int"), F.col("unit").cast("int"), "n")
        else:
            ready = pairs.filter("bits = 0").select("before", "unit", "n", nothing.alias("from"), nothing.alias("to"))
            rest = pairs.filter("bits != 0").withColumns({"from": nothing, "to": nothing})
            for i, (column, name) in enumerate((("before", "from"), ("unit", "to"))):
                near, lost = _split(rest, _FAR[i])
                its = far.select(F.col("unit").alias("key"), F.col("class").alias("class"))
                rest = near.unionByName(lost.join(its, F.col(column) == F.col("key")).withColumn(name, F.col("class")).select(*rest.columns))
            ready = ready.unionByName(rest.select(*ready.columns))
        found.append(ready.mapInArrow(run, schema))
    sides = found[0].unionByName(found[1]) if len(found) > 1 else found[0]
    return sides.repartitionById(last + 1, "hand").mapInArrow(merge, schema)


def _merged(parts: Iterator[list[np.ndarray]], whole: bool = False) -> Iterator[list[np.ndarray]]:
    """Sums over the parts of a task, in one table or, unless ``whole``, in tables of bounded size."""
    held, size, limit = [], 0, GATHERED
    for part in parts:
        held.append(part)
        size += len(part[0])
        if size > limit:
            held = [_by_class(*(np.concatenate(x) for x in zip(*held)))]
            size = len(held[0][0])
            if whole:
                limit = max(limit, 2 * size)
            elif size > GATHERED // 2:
                yield held[0]
                held, size = [], 0
    if size:
        yield _by_class(*(np.concatenate(x) for x in zip(*held)))


def _moves(vectors: DataFrame, joint: np.ndarray, last: int) -> DataFrame:
    """(unit, to, gain) of the units that gain by another class; the hand ``last`` has none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                u, own, near, n = (_entries(batch.slice(i, 1), c, kind) for c, kind in _SIDES.items())
                first = _runs(u)
                cuts = np.append(first, len(u))
                for begin in range(0, len(first), 500):
                    at = first[begin : begin + 500]
                    sizes = np.diff(cuts[begin : begin + 501])
                    mine = slice(at[0], at[0] + sizes.sum())
                    now = own[at].astype(np.int64)
                    gains = _gains(np.repeat(np.arange(len(at)), sizes), near[mine].astype(np.int64), n[mine], now, joint)
                    gains[:, 0] = -np.inf
                    to = gains.argmax(axis=1)
                    gain = gains[np.arange(len(to)), to]
                    some = np.flatnonzero((gain > 0) & (to != now))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(u[at[some]].view(np.int64)), pa.array(to[some].astype(np.int32)), pa.array(gain[some])], ["unit", "to", "gain"])

    return vectors.filter(F.col("hand") < last).mapInArrow(run, "unit long, to int, gain double")


def exchange(
    pairs: DataFrame | None, names: np.ndarray, weight: np.ndarray, far: DataFrame | None = None, classes: int = CLASSES,
    rounds: int = ROUNDS, tolerance: float = TOLERANCE, cells: DataFrame | None = None,
) -> tuple[np.ndarray, DataFrame | None, np.ndarray, list[float]]:
    """(classes of units at hand, (unit, class) of the others, class pairs, likelihood of each step) by exchange clustering.

    ``pairs`` has (before, unit, bits, n), ``cells`` packed pairs of units at hand that are not among them; either may be None.
    ``names`` and ``weight`` are the hashes and counts of units at hand, ``far`` (unit) all others. A step takes, for a third of the
    units, the neighbours by class, and moves these units to the class that raises the likelihood most; the
    gains are found in tasks against the table of classes by classes. A step that lowered the likelihood is
    undone for the half of its moves with the least gain. Class 0 holds the end of a text alone.
    The classes of other units are a stored table that is kept.
    """
    spark = (pairs if pairs is not None else cells).sparkSession
    width = len(weight)
    hands = _hands(weight, classes)
    class_of = (1 + _dealt(names, classes - 1)).astype(np.int16)
    # The most frequent units open the classes, the others are dealt by hash.
    first = np.argsort(-weight[1:], kind="stable")[: classes - 1] + 1
    class_of[first] = 1 + np.arange(len(first))
    class_of[0] = 0
    if far is not None:
        def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                unit = batch.column(0).to_numpy()
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array((1 + _dealt(unit, classes - 1)).astype(np.int32))], ["unit", "class"])

        far = far.select("unit").mapInArrow(deal, "unit long, class int")

    def seen(class_of: np.ndarray, far: DataFrame | None, turn: int):
        held = Stored(spark)
        if far is not None:
            far = held.table(far)
        vectors = held.table(_neighbours(pairs, cells, names, class_of, far, hands, turn, classes))
        joint = np.zeros((classes, classes))
        for r in vectors.filter(F.col("hand") == hands[1]).collect():
            old, new, n = (np.frombuffer(r[c], _SIDES[c]) for c in ("own", "near", "n"))
            joint[old, new] = n
        return class_of, far, vectors, joint, held

    now = seen(class_of, far, 0)
    history = [_likelihood(now[3])]
    for step in range(rounds):
        moves = now[4].table(_moves(now[2], now[3], hands[1]))
        low = 0.0
        while True:
            taken = moves.filter(F.col("gain") >= low)
            number, middle, least = taken.agg(F.count(F.lit(1)), F.percentile_approx("gain", 0.5), F.min("gain")).first()
            if not number:
                new = seen(now[0], now[1], (step + 1) % 3 if step + 1 < rounds else -1)
                break
            class_of = now[0].copy()
            near = taken.filter(F.col("unit").between(0, width - 1)).select("unit", "to").toArrow()
            class_of[near.column("unit").to_numpy()] = near.column("to").to_numpy()
            far = now[1]
            if far is not None:
                far = far.join(taken.select("unit", "to"), "unit", "left").select("unit", F.coalesce("to", "class").alias("class"))
            new = seen(class_of, far, (step + 1) % 3 if step + 1 < rounds else -1)
            if _likelihood(new[3]) >= history[-1]:
                break
            new[4].close()
            # At least one move goes, so this ends.
            low = middle if middle > least else float(np.nextafter(least, np.inf))
        now[4].close()
        now = new
        history.append(_likelihood(now[3]))
        if step >= 2 and history[-1] - history[-4] <= tolerance * abs(history[-1]):
            break
    class_of, far, _, joint, held = now
    if far is not None:
        far = held.table(far, keep=True)
    held.close()
    return class_of, far, joint, history


def learn(
    train: DataFrame, stored: Stored, classes: int = CLASSES, rounds: int = ROUNDS, tolerance: float = TOLERANCE,
) -> tuple[Model, DataFrame, DataFrame | None]:
    """The model of (text), the counts of all words and the classes of units not at hand, as stored tables."""
    counts = stored.table(_word_counts(train), keep=True)
    ends = train.count()
    total = counts.agg(F.sum("n"), F.count(F.lit(1))).first()
    tokens, kinds = (total[0] or 0) + ends, total[1] + (ends > 0)
    least = _most_frequent(counts, WORDS_AT_HAND) if kinds > WORDS_AT_HAND else 1
    at_hand = counts.filter(F.col("n") >= least).select("word", "n").toArrow()
    words, n = at_hand.column("word").to_numpy().view(np.uint64), at_hand.column("n").to_numpy()
    order = np.argsort(words)
    words, n = words[order], n[order]
    own = n >= LEAST_SEEN
    weight = np.concatenate([[ends], np.zeros(SHAPES, np.int64), n[own]])
    pieces = np.concatenate([[ends > 0], np.zeros(SHAPES, np.int64), own[own]]).astype(np.int64)
    rare = counts.filter(F.col("n") < LEAST_SEEN).groupBy("shape").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("kinds"))
    for r in rare.collect():
        weight[1 + r["shape"]], pieces[1 + r["shape"]] = r.n, r.kinds
    far = counts.filter((F.col("n") >= LEAST_SEEN) & (F.col("n") < least)).select(F.col("word").alias("unit"), "n") if least > LEAST_SEEN else None

    cells = stored.table(_pair_cells(train, (words, n), weight, least))
    pairs = None
    if far is not None:
        between = Stored(train.sparkSession)
        pairs = stored.table(_far_pairs(cells, counts, len(weight), least, between).sortWithinPartitions("before", "unit"))
        between.close()
        cells = cells.filter("not far")
    names = np.concatenate([np.arange(SHAPES + 1), words[own].view(np.int64)])
    class_of, classed, joint, _ = exchange(pairs, names, weight, far, classes, rounds, tolerance, cells)

    # Tokens and different words of each class give the room that its words share.
    of_class = np.bincount(class_of, weights=weight, minlength=classes)
    of_kinds = np.bincount(class_of, weights=pieces, minlength=classes)
    if classed is not None:
        for r in far.join(classed, "unit").groupBy("class").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("kinds")).collect():
            of_class[r["class"]] += r.n
            of_kinds[r["class"]] += r.kinds
    of_word = np.full(len(words), -1, np.int16)
    of_word[own] = class_of[1 + SHAPES :]
    share_of = joint.sum(axis=0) + 0.5
    share_of /= share_of.sum()
    transition = (joint + PRIOR * share_of) / (joint.sum(axis=1, keepdims=True) + PRIOR)
    room = np.log10(of_class + 0.5 * (of_kinds + 1))
    model = Model(words, n, of_word, class_of[1 : 1 + SHAPES].astype(np.int64), np.log10(transition), room, tokens, kinds, ends, classed is not None)
    return model, counts, classed


def _local_scores(docs: DataFrame, model: Model) -> DataFrame:
    """Scores of each text as far as its words are at hand.

    ``words`` lists the others, with the class that they have unless they are units; ``pairs`` the
    transitions that depend on whether they are.
    """
    sent = share(docs.sparkSession, model)

    def lists(rows: np.ndarray, n: int, columns: list[np.ndarray]) -> tuple[pa.Array, list[np.ndarray]]:
        """Equal entries once, with their number, as a list per row (``rows`` ascends)."""
        if len(rows):
            order = np.lexsort([*columns[::-1], rows])
            rows, columns = rows[order], [c[order] for c in columns]
            new = np.concatenate([[True], np.any([c[1:] != c[:-1] for c in (rows, *columns)], axis=0)])
            first = np.flatnonzero(new)
            times = np.diff(np.append(first, len(rows)))
            rows, columns = rows[first], [*(c[first] for c in columns), times]
        else:
            columns = [*columns, np.zeros(0, np.int64)]
        return np.searchsorted(rows, np.arange(n + 1)).astype(np.int32), columns

    def nested(rows: np.ndarray, n: int, columns: list[np.ndarray], names: list[str]) -> pa.Array:
        offsets, columns = lists(rows, n, columns)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        its: Model = shared(sent)
        floor, end = its.floor(), np.log10(its.ends + 0.5)
        for batch in batches:
            for part in text_slices(batch, "text"):
                words = Words(part.column("text"), NOT_SPACE)
                hashes, n = words.hashes(), words.rows
                at, there = _at_hand(its.words, hashes)
                weight = np.zeros(len(hashes))
                weight[there] = np.log10(its.counts[at[there]] + 0.5)
                classes = its.class_of_shape[_shapes(words)]
                own = there.copy()
                own[there] = its.classes[at[there]] >= 0
                classes[own] = its.classes[at[own]]
                sums = lambda index, values: np.bincount(index, weights=values, minlength=n)
                known = np.bincount(words.doc[there], minlength=n) + (its.ends > 0)
                plain = sums(words.doc, np.where(there, weight - floor, 0.0)) + (end - floor)
                shares = sums(words.doc, np.where(there, weight - its.room[classes], 0.0)) + (end - its.room[0])
                rows = words.doc[~there]
                asked = nested(rows, n, [hashes[~there].view(np.int64), classes[~there]], ["word", "class", "times"])

                after, doc = _sequences(words, classes)
                before = np.concatenate([[0], after[:-1]])
                ends = np.cumsum(words.count)
                key = np.insert(hashes.view(np.int64), ends, 0)
                open_ = np.insert(~there & its.more_units, ends, False)
                bits = _FAR[1] * open_ + _FAR[0] * np.concatenate([[False], open_[:-1]])
                some = bits > 0
                moves = sums(doc, np.where(some, 0.0, its.transition[before, after]))
                old = np.concatenate([[0], key[:-1]])
                pairs = nested(doc[some], n, [old[some], key[some], before[some], after[some], bits[some]],
                               ["before", "unit", "from", "to", "bits", "times"])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(words.count + 1), pa.array(known.astype(np.int64)), pa.array(plain),
                     pa.array(shares + moves), asked, pairs],
                    ["doc_id", "n_tokens", "n_known", "base_score", "score", "words", "pairs"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(
        run, f"doc_id {kind}, n_tokens long, n_known long, base_score double, score double, "
        "words array<struct<word: long, class: long, times: long>>, "
        "pairs array<struct<before: long, unit: long, from: long, to: long, bits: long, times: long>>")


def _asked(local: DataFrame, model: Model, counts: DataFrame, classed: DataFrame | None) -> tuple[DataFrame, DataFrame | None]:
    """What words that are not at hand add: (row, more, plain, found), and (row, moved) by transitions."""
    room = F.array(*(F.lit(float(x)) for x in model.room))
    n = F.coalesce("n", F.lit(0))
    words = local.select("row", F.explode("words").alias("w")).select("row", "w.*")
    looked = counts.select("word", "n")
    if model.more_units:
        looked = looked.join(classed.select(F.col("unit").alias("word"), F.col("class").alias("own")), "word", "left")
    else:
        looked = looked.withColumn("own", F.lit(None).cast("int"))
    its = F.coalesce("own", "class").cast("int")
    met = words.join(looked, "word", "left").groupBy("row").agg(
        F.sum((F.log10(n + 0.5) - F.element_at(room, its + 1)) * F.col("times")).alias("more"),
        F.sum((F.log10(n + 0.5) - F.lit(model.floor())) * F.col("times")).alias("plain"),
        F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("found"))
    if not model.more_units:
        return met, None
    pairs = local.select("row", F.explode("pairs").alias("p")).select("row", "p.*")
    own = classed.select(F.col("unit").alias("key"), F.col("class").alias("own"))
    for i, (column, name) in enumerate((("before", "from"), ("unit", "to"))):
        sure, rest = _split(pairs, _FAR[i])
        rest = rest.join(own, F.col(column) == F.col("key"), "left").withColumn(name, F.coalesce("own", name).cast("long"))
        pairs = sure.unionByName(rest.select(*pairs.columns))
    steps = F.array(*(F.lit(float(x)) for x in model.transition.ravel()))
    at = (F.col("from") * len(model.room) + F.col("to") + 1).cast("int")
    return met, pairs.groupBy("row").agg(F.sum(F.element_at(steps, at) * F.col("times")).alias("moved"))


def score(
    docs: DataFrame, train: DataFrame, id_col: str = "doc_id", text_col: str = "text", classes: int = CLASSES, rounds: int = ROUNDS,
) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score, perplexity) of each row of ``docs``.

    Tokens are words between ASCII white spaces, A-Z lower-cased, and one end per text.
    ``base_score`` sums log10((c + 0.5) / (N + 0.5 * (V + 1))) over the tokens, with their
    counts c in ``train``, all N tokens and V different ones there. ``score`` is the log10
    probability under the class model, in which a word's share of its class is
    (c + 0.5) / (n + 0.5 * (v + 1)) for the n tokens and v words of the class.
    ``n_known`` counts tokens that occur in ``train``.

    Null and empty texts are an end alone. Rows that repeat are scored, and learned from,
    each for itself; texts are read whole. An empty table gives no rows; without training rows nothing is
    known, and every token has the same base score. Columns other than the two named are not read.
    """
    stored = Stored(docs.sparkSession)
    text = F.col(text_col).cast("string").alias("text")
    model, counts, classed = learn(train.select(text), stored, classes, rounds)
    local = stored.table(
        _local_scores(docs.select(F.col(id_col).alias("doc_id"), text), model).withColumn("row", F.monotonically_increasing_id()), keep=True)
    met, moved = _asked(local, model, counts, classed)
    stored.close()
    result = local.drop("words", "pairs").join(met, "row", "left")
    result = result.join(moved, "row", "left") if moved is not None else result.withColumn("moved", F.lit(0.0))
    total = F.col("score") + F.coalesce("more", F.lit(0.0)) + F.coalesce("moved", F.lit(0.0))
    return result.select(
        "doc_id", "n_tokens", (F.col("n_known") + F.coalesce("found", F.lit(0))).cast("long").alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("base_score") + F.coalesce("plain", F.lit(0.0))).alias("base_score"), total.alias("score"),
        F.pow(F.lit(10.0), F.least(-total / F.col("n_tokens"), F.lit(300.0))).alias("perplexity"))
