"""Language identification by interpolated Kneser-Ney character models.

Per language, runs of up to ``ORDER`` characters inside words are counted on a bounded
sample of labelled texts and smoothed with absolute discounts and continuation counts.
The models are stored in sorted arrays of hashes, one row of logarithms per run with a
column per language, so one binary search serves all languages. A text gets the
language of the lowest cross-entropy per character; if even that is far above what
most labelled texts of the language show, it is rejected.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.batches import Words, mix, random_words, text_slices
from plumbline.llm.stored import Stored, share, shared

ORDER = 5
#: Labelled texts per language that teach, and as many more that calibrate the rejection.
PER_LANGUAGE = 1500
#: Languages that a model may have.
MOST_LANGUAGES = 1000
#: Rejected: cross-entropy so many times as far above the median of calibration texts as nine tenths
#: of them reach, and then this far on the way from the median to characters drawn at random. Up to
#: a tenth of a language's calibration texts may be garbage without moving it much.
SPREADS, MARGIN = 4.0, 0.3
#: The limit widens by so many standard errors of a text's mean; the log10 probability of a single
#: character has a deviation of about one.
ERRORS = 5.0
#: Letters of the texts that calibrate.
LEAST_LETTERS = 40
#: Characters beyond which the posterior no longer sharpens.
POSTERIOR_LENGTH = 60.0

UNKNOWN = "und"

_LETTER_BYTES = np.zeros(256, dtype=bool)
_LETTER_BYTES[0x61:0x7B] = _LETTER_BYTES[0x80:] = True
_BEGIN, _END = 1, 0
_NOT_LETTER = re.compile(r"[\W\d_]+")
_SALT = random_words(ORDER + 1, 71)


def _spelled(words: Words) -> tuple[np.ndarray, list[str], np.ndarray]:
    """Different words of a batch: (which of each word, letters, owner of each run of letters)."""
    _, first, which = np.unique(words.hashes(), return_index=True, return_inverse=True)
    raw = words.data.tobytes()
    runs, owner = [], []
    for i, (a, b) in enumerate(zip(words.start[first].tolist(), words.end[first].tolist())):
        word = raw[a:b].decode("utf-8", "replace").lower()
        if word.isalpha():
            runs.append(word)
            owner.append(i)
        else:
            for part in _NOT_LETTER.split(word):
                if part:
                    runs.append(part)
                    owner.append(i)
    return which, runs, np.array(owner, np.int64)


def _grams(runs: list[str]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """(symbols, run of each predicted symbol, hashes by order, whether a run of that order ends there).

    A word is a begin mark, its letters and an end mark; all but the begin mark are predicted.
    """
    if not runs:
        none = np.zeros(0, np.int64)
        return none, none, [none.astype(np.uint64)] * ORDER, [none.astype(bool)] * ORDER
    text = "".join(f"{chr(_BEGIN)}{run}{chr(_END)}" for run in runs)
    symbols = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32).astype(np.int64)
    begins = np.flatnonzero(symbols == _BEGIN)
    run = np.searchsorted(begins, np.arange(len(symbols)), side="right") - 1
    place = np.arange(len(symbols)) - begins[run]
    hashes, there = [], []
    value = mix(symbols.astype(np.uint64) ^ _SALT[0])
    for k in range(ORDER):
        if k:
            value = value.copy()
            value[k:] = mix(value[k:] * np.uint64(0x9E3779B97F4A7C15) + mix(symbols[:-k].astype(np.uint64) ^ _SALT[k]))
        hashes.append(value)
        there.append(place >= k)
    return symbols, run, hashes, there


@dataclass
class Model:
    """Sorted hashes of runs per order, log10 probabilities and back-off weights per language."""

    languages: list[str]
    grams: list[np.ndarray]
    probability: list[np.ndarray]
    contexts: list[np.ndarray]
    weight: list[np.ndarray]
    unseen: np.ndarray
    limit: np.ndarray

    def word_scores(self, runs: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(sum of log10 probabilities by language, characters predicted) of each run of letters."""
        symbols, run, hashes, there = _grams(runs)
        n = len(runs)
        total = np.zeros((n, len(self.languages)))
        if not n:
            return total, np.zeros(0)
        asked = np.flatnonzero(symbols != _BEGIN)
        size = np.bincount(run[asked], minlength=n).astype(float)
        score = np.zeros((len(asked), len(self.languages)))
        open_rows = np.arange(len(asked))
        for k in range(ORDER - 1, -1, -1):
            rows = open_rows[there[k][asked[open_rows]]]
            at, found = _find(self.grams[k], hashes[k][asked[rows]])
            score[rows[found]] += self.probability[k][at[found]]
            lost = rows[~found]
            if k:
                before, known = _find(self.contexts[k], hashes[k - 1][asked[lost] - 1])
                score[lost[known]] += self.weight[k][before[known]]
            else:
                score[lost] += self.unseen
            done = np.zeros(len(asked), bool)
            done[rows[found]] = True
            open_rows = open_rows[~done[open_rows]]
        for i in range(total.shape[1]):
            total[:, i] = np.bincount(run[asked], weights=score[:, i], minlength=n)
        return total, size


def _find(table: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(table):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(table, wanted), len(table) - 1)
    return at, table[at] == wanted


def _smoothed(languages: list[str], counts: dict[str, np.ndarray]) -> Model:
    """Interpolated Kneser-Ney probabilities of all counted runs in all languages."""
    n_lang = len(languages)
    grams, tables, contexts, weights = [], [], [], []
    per_order = []
    for k in range(ORDER):
        rows = counts["order"] == k
        names, index = np.unique(counts["gram"][rows], return_inverse=True)
        first = np.zeros(len(names), np.int64)
        first[index] = np.flatnonzero(rows)
        raw = np.zeros((len(names), n_lang))
        np.add.at(raw, (index, counts["lang"][rows]), counts["n"][rows])
        per_order.append((names, raw, counts["context"][first], counts["lower"][first], counts["starts"][first]))
        grams.append(names)
    # Every different symbol and one that was never seen share the rest of the unigrams.
    uniform = 1.0 / (len(grams[0]) + 1)
    unseen = np.full(n_lang, uniform)
    for k in range(ORDER):
        names, raw, context, _, starts = per_order[k]
        if k < ORDER - 1:
            # Below the highest order a run counts once per symbol that precedes it, but
            # those at the begin of words have none and keep their counts.
            _, above, _, lower, _ = per_order[k + 1]
            at, _ = _find(names, lower)
            used = np.zeros_like(raw)
            np.add.at(used, at, (above > 0).astype(float))
            used[starts] = raw[starts]
        else:
            used = raw
        ones, twos = (used == 1).sum(axis=0), (used == 2).sum(axis=0)
        discount = np.where(ones > 0, ones / np.maximum(ones + 2 * twos, 1), 0.5)
        discount = np.clip(discount, 0.1, 0.95)
        if k:
            ctx, of = np.unique(context, return_inverse=True)
        else:
            ctx, of = np.zeros(1, np.uint64), np.zeros(len(names), np.int64)
        total = np.zeros((len(ctx), n_lang))
        kinds = np.zeros((len(ctx), n_lang))
        np.add.at(total, of, used)
        np.add.at(kinds, of, (used > 0).astype(float))
        weight = np.where(total > 0, discount * kinds / np.maximum(total, 1e-9), 1.0)
        own = np.maximum(used - discount, 0) / np.maximum(total[of], 1e-9)
        if k:
            below, _ = _find(grams[k - 1], per_order[k][3])
            prior = tables[k - 1][below]
        else:
            prior = np.full((len(names), n_lang), uniform)
            unseen = weight[0] * uniform
        tables.append(own + weight[of] * prior)
        contexts.append(ctx)
        weights.append(weight)

    def log(x: np.ndarray) -> np.ndarray:
        return np.log10(np.maximum(x, 1e-12)).astype(np.float32)

    return Model(languages, grams, [log(t) for t in tables], contexts, [log(w) for w in weights], log(unseen),
                 np.full(n_lang, np.inf))


_COUNTS = "lang int, order int, gram long, context long, lower long, starts boolean, n double"


def _sample(labelled: DataFrame, per_language: int, stored: Stored) -> tuple[DataFrame, list[str]]:
    """(code, text, teaches, tests) of the texts drawn from (text, lang), and the languages by code.

    Of the different texts of a language, the ``per_language`` with the least hashes teach and
    as many next ones test. Where a language has fewer than that, all teach or test, and those that
    teach test as well.
    """
    spark = labelled.sparkSession
    drawn = labelled.withColumn("drawn", F.shiftrightunsigned(F.xxhash64(F.lit(17), "text"), 1))
    different = stored.table(drawn.select("lang", "drawn").distinct())
    sizes = {r.lang: r.n for r in different.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(MOST_LANGUAGES + 1).collect()}
    if len(sizes) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    languages = sorted(sizes)
    if not languages:
        return labelled, languages
    # Hashes up to a bound that fewer than the wanted ones practically never stay below.
    wanted = 2 * per_language
    bounds = spark.createDataFrame(
        [(c, i, min((1 << 63) - 1, int(2.0**63 * (wanted + 8 * wanted**0.5 + 40) / sizes[c]))) for i, c in enumerate(languages)],
        "lang string, code int, bound long")
    least = different.join(F.broadcast(bounds), "lang").filter("drawn <= bound").select("code", "drawn").toArrow()
    code, hashes = (least.column(c).to_numpy() for c in ("code", "drawn"))
    cuts = []
    for i, c in enumerate(languages):
        own = np.sort(hashes[code == i])
        if len(own) < min(wanted, sizes[c]):
            raise ValueError(f"only {len(own)} of {min(wanted, sizes[c])} texts drawn for language {c}")
        cuts.append((c, i, int(own[min(per_language, len(own)) - 1]), int(own[min(wanted, len(own)) - 1]), sizes[c] < wanted))
    cuts = spark.createDataFrame(cuts, "lang string, code int, teaching long, last long, few boolean")
    chosen = drawn.join(F.broadcast(cuts), "lang").filter("drawn <= last").withColumn("teaches", F.expr("drawn <= teaching")).withColumn(
        "tests", F.expr("drawn > teaching or few"))
    return stored.table(chosen.groupBy("code", "text").agg(F.first("teaches").alias("teaches"), F.first("tests").alias("tests"))), languages


def learn(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", per_language: int = PER_LANGUAGE,
) -> Model:
    """Models of all languages that label ``docs``.

    Of each language ``per_language`` different texts teach and as many others calibrate the
    rejection; they are chosen by a hash of the text, however often a text is repeated. Texts
    that are rejected by what others teach do not teach. Rows
    without text or label do not take part. Without labelled rows the model has no
    language, and every text is ``und``.
    """
    stored = Stored(docs.sparkSession)
    labelled = docs.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    labelled = labelled.filter("text is not null and lang is not null")
    chosen, languages = _sample(labelled, per_language, stored)
    if not languages:
        stored.close()
        empty = {"order": np.zeros(0, int), "lang": np.zeros(0, int), "n": np.zeros(0), "starts": np.zeros(0, bool)}
        return _smoothed([], empty | {c: np.zeros(0, np.uint64) for c in ("gram", "context", "lower")})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text"):
                words = Words(part.column("text"), _LETTER_BYTES)
                which, runs, owner = _spelled(words)
                symbols, run, hashes, there = _grams(runs)
                asked = np.flatnonzero(symbols != _BEGIN)
                lang_of = part.column("code").to_numpy()[words.doc]
                for lang in np.unique(lang_of):
                    times = np.bincount(which[lang_of == lang], minlength=int(which.max(initial=-1)) + 1).astype(float)
                    weight = times[owner][run[asked]]
                    for k in range(ORDER):
                        rows = (weight > 0) & there[k][asked]
                        at = asked[rows]
                        names, first, index = np.unique(hashes[k][at], return_index=True, return_inverse=True)
                        at, n = at[first], len(names)
                        zeros = np.zeros(n, np.uint64)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(n, lang, np.int32)), pa.array(np.full(n, k, np.int32)), pa.array(names.view(np.int64)),
                             pa.array((hashes[k - 1][at - 1] if k else zeros).view(np.int64)),
                             pa.array((hashes[k - 1][at] if k else zeros).view(np.int64)),
                             pa.array(symbols[at - k] == _BEGIN), pa.array(np.bincount(index, weights=weight[rows], minlength=n))],
                            ["lang", "order", "gram", "context", "lower", "starts", "n"])

    def fitted(texts: DataFrame) -> Model:
        counted = (
            texts.select("code", "text").mapInArrow(count, _COUNTS)
            .groupBy("lang", "order", "gram").agg(
                F.first("context").alias("context"), F.first("lower").alias("lower"), F.first("starts").alias("starts"), F.sum("n").alias("n"))
        )
        table = counted.toArrow()
        arrays = {c: table.column(c).to_numpy() for c in table.column_names}
        arrays |= {c: arrays[c].view(np.uint64) for c in ("gram", "context", "lower")}
        return _smoothed(languages, arrays)

    # A text that taught is no surprise to its model: garbage is taken out of the texts that teach
    # by the models of the two halves, each on the other half.
    teaching = chosen.filter("teaches").withColumn("half", F.pmod(F.xxhash64(F.lit(23), "text"), F.lit(2)))
    sound = []
    for half in (0, 1):
        other = teaching.filter(F.col("half") == half)
        sound.append(stored.table(keep_identified(other, _calibrated(fitted(teaching.filter(F.col("half") != half)), other))))
    model = _calibrated(fitted(sound[0].unionByName(sound[1])), chosen.filter("tests"))
    stored.close()
    return model


def _calibrated(model: Model, texts: DataFrame) -> Model:
    """The model with limits from labelled texts (code, text)."""
    scored = _score(texts.select(F.col("code").alias("doc_id"), "text"), model)
    ranges = scored.filter((F.col("letters") >= LEAST_LETTERS) & (F.col("best") == F.col("doc_id"))).groupBy("best").agg(
        F.percentile("entropy", F.lit(0.5)).alias("middle"), F.percentile("entropy", F.lit(0.9)).alias("high")).collect()
    chance = float(np.log10(len(model.grams[0]) + 1))
    for r in ranges:
        model.limit[r.best] = r.middle + SPREADS * (r.high - r.middle) + MARGIN * max(chance - r.middle, 0.0)
    return model


def _judge(texts: pa.Array, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(best language, its cross-entropy, posterior, letters, whether there is no answer) of each text."""
    words = Words(texts, _LETTER_BYTES)
    which, runs, owner = _spelled(words)
    by_run, size_of_run = model.word_scores(runs)
    n_words, n = int(which.max(initial=-1)) + 1, words.rows
    size = np.bincount(owner, weights=size_of_run, minlength=n_words)
    letters = np.bincount(owner, weights=size_of_run - 1, minlength=n_words)
    length = np.bincount(words.doc, weights=size[which], minlength=n)
    letters = np.bincount(words.doc, weights=letters[which], minlength=n).astype(np.int64)
    entropy = np.zeros((n, max(len(model.languages), 1)))
    for i in range(len(model.languages)):
        by_word = np.bincount(owner, weights=by_run[:, i], minlength=n_words)
        entropy[:, i] = -np.bincount(words.doc, weights=by_word[which], minlength=n)
    entropy /= np.maximum(length, 1)[:, None]
    best = entropy.argmin(axis=1)
    gap = entropy - entropy.min(axis=1, keepdims=True)
    odds = 10.0 ** -(gap * np.minimum(length, POSTERIOR_LENGTH)[:, None])
    none = (letters == 0) | (not model.languages)
    return best, entropy[np.arange(n), best], np.where(none, 0.0, 1 / odds.sum(axis=1)), letters, none


def _score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, best, entropy, score, letters) of (doc_id, text); ``best`` is null without letters."""
    sent = share(docs.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        its = shared(sent)
        for batch in batches:
            for part in text_slices(batch, "text"):
                best, entropy, score, letters, none = _judge(part.column("text"), its)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(best.astype(np.int32), mask=none), pa.array(entropy, mask=none),
                     pa.array(score), pa.array(letters)],
                    ["doc_id", "best", "entropy", "score", "letters"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, best int, entropy double, score double, letters long")


def keep_identified(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose language is not rejected by ``predict``'s rule, with all their columns."""
    sent = share(docs.sparkSession, model)
    place = [c.lower() for c in docs.columns].index(text_col.lower())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        its = shared(sent)
        for batch in batches:
            for part in text_slices(batch, place):
                best, entropy, _, letters, none = _judge(part.column(place), its)
                over = entropy > its.limit[best] + ERRORS / np.sqrt(np.maximum(letters, 1)) if its.languages else none
                yield part.filter(pa.array(~(none | over)))

    # Plain names inside, because columns may have any names.
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    return plain.mapInArrow(run, plain.schema).toDF(*docs.columns)


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score, entropy, rejected) of each row of ``docs``, one pass without a shuffle.

    ``score`` is the posterior of the language over the first ``POSTERIOR_LENGTH`` characters'
    worth of evidence. Text that is null or has no letter is ``und`` with score 0 and is rejected;
    otherwise a text is rejected if its cross-entropy is over the limit of its language, widened
    by ``ERRORS`` over the root of its letters. Only the text is looked at, and all of it.

    Rows that repeat are judged each for itself, an empty table gives no rows. Equal
    cross-entropies go to the language that is first by name. Other columns are not read.
    """
    found = _score(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")), model)
    if not model.languages:
        return found.select("doc_id", F.lit(UNKNOWN).alias("lang_pred"), "score", "entropy", F.lit(True).alias("rejected"))
    names = F.array(*(F.lit(c) for c in model.languages))
    limits = F.array(*(F.lit(float(x)) for x in model.limit))
    place = F.col("best") + 1
    return found.select(
        "doc_id", F.when(F.col("best").isNull(), UNKNOWN).otherwise(F.element_at(names, place)).alias("lang_pred"), "score", "entropy",
        (F.col("best").isNull() | (
            F.col("entropy") > F.element_at(limits, place) + ERRORS / F.sqrt(F.greatest(F.col("letters"), F.lit(1))))).alias("rejected"))


def remainder(id_col: str, by: int) -> Column:
    """crc32 of the id as text modulo ``by``; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % by
