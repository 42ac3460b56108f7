"""Token counts by linear longest-match with failure links.

The vocabulary is a trie over bytes. A node whose string cannot go on has a
failure link to the node where matching continues, and the number of tokens that
are complete by then. So each byte is read once, and the greedy longest-match pieces
of a word are counted without being built. All different words of a batch walk
through the automaton together.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.batches import NOT_SPACE, Words, text_slices
from plumbline.llm.stored import share, shared

#: Vocabulary file in the folder of public tokenizers: byte strings as ranks.
VOCABULARY = "byte_bpe_50k.tiktoken"
#: Vocabulary entries that are broadcast; a larger vocabulary is refused.
MOST_ENTRIES = 4_000_000

_DEAD = -1


def read_ranks(name: str = VOCABULARY) -> list[bytes]:
    """The byte strings of a public vocabulary."""
    import base64

    import public_tokenizers

    with open(public_tokenizers.path(name), "rb") as lines:
        return [base64.b64decode(line.split()[0]) for line in lines]


class Automaton:
    """Trie with failure links and counts of the tokens popped along them."""

    def __init__(self, vocabulary: Iterable[bytes], lead: bytes = b" ") -> None:
        """``lead`` stands before each word; entries that begin with it start words."""
        children: list[dict[int, int]] = [{}]
        parent, byte, entry = [0], [0], [False]
        for token in vocabulary:
            node = 0
            for c in token:
                at = children[node].get(c)
                if at is None:
                    at = children[node][c] = len(children)
                    children.append({})
                    parent.append(node)
                    byte.append(c)
                    entry.append(False)
                node = at
            entry[node] = node > 0
        n = len(children)
        fail, popped = [_DEAD] * n, [0] * n
        level = list(children[0].values())
        while level:
            for v in level:
                if entry[v]:
                    fail[v], popped[v] = 0, 1
                    continue
                at, count, c = fail[parent[v]], popped[parent[v]], byte[v]
                while at != _DEAD and c not in children[at]:
                    count += popped[at]
                    at = fail[at]
                if at != _DEAD:
                    fail[v], popped[v] = children[at][c], count
            level = [u for v in level for u in children[v].values()]
        keys = np.fromiter(((v << 8) | c for v in range(n) for c in children[v]), np.int64)
        targets = np.fromiter((u for v in range(n) for u in children[v].values()), np.int64)
        order = np.argsort(keys)
        self.keys, self.targets = keys[order], targets[order]
        self.fail, self.popped = np.array(fail, np.int64), np.array(popped, np.int64)
        self.lead = lead

    def _step(self, node: np.ndarray, c: np.ndarray) -> np.ndarray:
        """The child of each node, or _DEAD."""
        key = (node << 8) | c
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.targets[at], _DEAD)

    def count(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Pieces of each word; a word that cannot be split counts as one unknown piece."""
        n = len(start)
        node, total = np.zeros(n, np.int64), np.zeros(n, np.int64)
        unknown = np.zeros(n, bool)
        if not len(self.keys):
            return np.ones(n, np.int64)
        order = np.argsort(start - end, kind="stable")
        start, size = start[order], (end - start)[order]
        lead = len(self.lead)
        for at in range(-lead, int(size[0]) if n else 0):
            # Longest words come first: those with a byte here are the first ones.
            rows = np.arange(n if at < 0 else int(np.searchsorted(-size, -at, side="left")))
            rows = rows[~unknown[rows]]
            if not len(rows):
                break
            c = np.full(len(rows), self.lead[at + lead], np.int64) if at < 0 else data[start[rows] + at].astype(np.int64)
            while len(rows):
                to = self._step(node[rows], c)
                moved = to != _DEAD
                node[rows[moved]] = to[moved]
                rows, c = rows[~moved], c[~moved]
                rows, c = self._pop(rows, c, node, total, unknown)
        rows = np.flatnonzero(~unknown & (node > 0))
        while len(rows):
            rows, _ = self._pop(rows, rows, node, total, unknown)
            rows = rows[node[rows] > 0]
        total[unknown] = 1
        result = np.empty(n, np.int64)
        result[order] = total
        return result

    def _pop(self, rows, c, node, total, unknown):
        to = self.fail[node[rows]]
        lost = to == _DEAD
        unknown[rows[lost]] = True
        rows, c, to = rows[~lost], c[~lost], to[~lost]
        total[rows] += self.popped[node[rows]]
        node[rows] = to
        return rows, c


def count(
    docs: DataFrame, vocabulary: list[bytes] | None = None, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(doc_id, n_words, n_tokens, n_bytes) of each row of ``docs``.

    Words lie between ASCII white spaces; each has a blank put before it and is split
    greedily into the longest entries of the vocabulary (default: a public one that has
    all single bytes). Case is kept. A word that cannot be split counts as one token.

    Null and empty texts have no words and no tokens; texts and words of any length are
    counted whole. Rows that repeat are counted each for itself, and an empty table gives
    no rows. Other columns are not read. The vocabulary is broadcast; it may have
    up to 4,000,000 entries.
    """
    vocabulary = read_ranks() if vocabulary is None else vocabulary
    if len(vocabulary) > MOST_ENTRIES:
        raise ValueError(f"the vocabulary has more than {MOST_ENTRIES} entries")
    sent = share(docs.sparkSession, Automaton(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = shared(sent)
        for batch in batches:
            for part in text_slices(batch, "text"):
                words = Words(part.column("text"), NOT_SPACE, lower=False)
                _, first, which = np.unique(words.hashes(), return_index=True, return_inverse=True)
                counts = automaton.count(words.data, words.start[first], words.end[first])
                tokens = np.bincount(words.doc, weights=counts[which], minlength=words.rows).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(words.count), pa.array(tokens), pa.array(np.diff(words.offsets))],
                    ["doc_id", "n_words", "n_tokens", "n_bytes"])

    read = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = read.schema["doc_id"].dataType.simpleString()
    return read.mapInArrow(run, f"doc_id {kind}, n_words long, n_tokens long, n_bytes long")
