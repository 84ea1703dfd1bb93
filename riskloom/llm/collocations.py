"""Phrase collocations by Toivonen's method: a sample proposes phrases and their negative border, full passes count both exactly."""

from __future__ import annotations

import functools
from collections import Counter
from collections.abc import Callable, Iterator
from math import floor, sqrt

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from riskloom.llm.buffers import LOWER, slices, text_bytes
from riskloom.llm.spans import small_batches
from riskloom.session import materialize

#: Longest phrase, least count, and the rows of a language's report.
LONGEST, LEAST, TOP = 5, 100, 2000
#: One row in so many is in the sample.
SAMPLE = 4
#: Bits of a membership table per key, and of the largest one (32 MB). Beyond it, more strings pass than
#: are members; they are counted and do no harm.
BITS_PER_KEY, MOST_BITS = 64, 28
#: Entries that a task collects before it sends them.
HELD = 1 << 20
_BREAK, _BLANK = 2, 1
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = _BLANK
_KIND[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = _BREAK
_STEP, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
_SCHEMA = "lang string, phrase string, key bigint, n bigint"

Members = Callable[[np.ndarray], np.ndarray]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MIX
    return x ^ (x >> np.uint64(29))


class Texts:
    """Words of a batch with, for each, how many words its piece still has from it on, and keys of the phrases there."""

    def __init__(self, column: pa.Array, langs: list[str]):
        raw, offs = text_bytes(column)
        raw = LOWER[raw]
        kind = _KIND[raw]
        solid = kind == 0
        edge = np.append(False, solid[1:] != solid[:-1])
        heads = offs[:-1][offs[:-1] < len(raw)]
        edge[heads] = True
        edges = np.append(np.flatnonzero(edge), len(raw))
        opens = np.flatnonzero(solid[edges[:-1]])
        start, sizes = edges[opens], edges[opens + 1] - edges[opens]
        self.doc = np.searchsorted(offs, start, side="right") - 1
        breaks = np.flatnonzero(kind == _BREAK)
        part = np.searchsorted(breaks, start)
        fresh = np.append(True, (part[1:] != part[:-1]) | (self.doc[1:] != self.doc[:-1]))[: len(start)]
        first = np.flatnonzero(fresh)
        past = np.append(first[1:], len(start))[: len(first)]
        self.room = np.repeat(past, past - first) - np.arange(len(start))
        ends = np.append(0, np.cumsum(sizes)).astype(np.int64)
        listed = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(raw[solid]))])
        coded = listed.dictionary_encode()
        self.ids = np.asarray(coded.indices)
        self.words: list[bytes] = coded.dictionary.to_pylist()
        hashed = np.fromiter(map(xxhash.xxh64_intdigest, self.words), np.uint64, len(self.words))
        self.hashes = hashed[self.ids] if len(self.ids) else np.zeros(0, np.uint64)
        self.langs = langs
        self.tongue = np.array([_tongue(x) for x in langs], np.uint64)

    def words_at(self) -> tuple[np.ndarray, np.ndarray]:
        """The places of all words and their keys."""
        return np.arange(len(self.ids)), _mix(self.hashes ^ self.tongue[self.doc])

    def longer(self, places: np.ndarray, keys: np.ndarray, length: int, part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of the ``places`` whose phrase of ``length - 1`` words has a ``part`` mark at the next place too, those
        with one more word in their piece, and the keys of the phrases of ``length`` words there."""
        follows = np.append(places[1:] == places[:-1] + 1, False)
        follows[:-1] &= part[1:]
        stay = np.flatnonzero(part & follows & (self.room[places] >= length)) if len(places) else np.zeros(0, np.int64)
        return places[stay], _mix(keys[stay] * _STEP + self.hashes[places[stay] + length - 1])

    def named(self, length: int, at: int) -> tuple[str, str]:
        return self.langs[self.doc[at]], b" ".join([self.words[i] for i in self.ids[at : at + length].tolist()]).decode()


@functools.cache
def _tongue(lang: str) -> int:
    return xxhash.xxh64_intdigest(lang.encode(), 7)


class _Counts:
    """Sums per key, in sorted runs that are merged when they outgrow ``HELD``."""

    def __init__(self):
        self.runs: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.runs.append((keys, counts))
        self.size += len(keys)

    def merged(self) -> tuple[np.ndarray, np.ndarray]:
        key, counts = (np.concatenate(x) for x in zip(*self.runs))
        order = np.argsort(key, kind="stable")
        key, counts = key[order], counts[order]
        head = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        self.runs = [(key[head], np.add.reduceat(counts, head))]
        self.size = len(head)
        return self.runs[0]


class _Tally:
    """What a task counts, by key and by name; it leaves in batches, so that what is held has a bound."""

    def __init__(self):
        self.plain, self.known = _Counts(), _Counts()
        self.names: dict[int, tuple[str, str]] = {}
        self.sizes: Counter[str] = Counter()
        self.strangers: Counter[tuple[str, str]] = Counter()

    def count(self, keys: np.ndarray) -> None:
        if len(keys):
            self.plain.add(*np.unique(keys, return_counts=True))

    def count_named(self, texts: Texts, length: int, places: np.ndarray, keys: np.ndarray) -> None:
        """In a batch, equal keys are one phrase only if their words are."""
        if not len(places):
            return
        key, lead, which = np.unique(keys, return_index=True, return_inverse=True)
        first = places[lead][which]
        same = texts.tongue[texts.doc[places]] == texts.tongue[texts.doc[first]]
        for j in range(length):
            same &= texts.ids[places + j] == texts.ids[first + j]
        self.known.add(key, np.bincount(which[same], minlength=len(key)))
        for k, at in zip(key.tolist(), places[lead].tolist()):
            if k not in self.names:
                self.names[k] = texts.named(length, at)
        for at in places[~same].tolist():
            self.strangers[texts.named(length, at)] += 1

    def batches(self, end: bool) -> Iterator[pa.RecordBatch]:
        if self.plain.size > HELD or (end and self.plain.size):
            key, counts = self.plain.merged()
            if end or self.plain.size > HELD // 2:
                none = [None] * len(key)
                yield _rows(none, none, key.view(np.int64), counts)
                self.plain = _Counts()
        if self.known.size > HELD:
            self.known.merged()
        if end or len(self.names) > HELD // 4:
            key, counts = self.known.merged() if self.known.runs else (np.zeros(0, np.uint64),) * 2
            names = [*(self.names[k] for k in key.tolist()), *self.strangers, *((lang, None) for lang in self.sizes)]
            counts = [*counts.tolist(), *self.strangers.values(), *self.sizes.values()]
            yield _rows([x for x, _ in names], [p for _, p in names], [None] * len(names), counts)
            # What is counted by key only may not have left yet.
            self.known, self.names, self.sizes, self.strangers = _Counts(), {}, Counter(), Counter()


def _rows(langs, phrases, keys, counts) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(phrases, pa.string()), pa.array(keys, pa.int64()), pa.array(counts, pa.int64())], ["lang", "phrase", "key", "n"])


def member_table(spark: SparkSession, keys: DataFrame) -> Broadcast:
    """A bit table of the ``key`` values, two bits each, of at most ``MOST_BITS`` whatever their number.

    Bits are set by an aggregation; the driver receives at most one number per 64 bits of the table.
    """
    count = keys.count()
    bits = min(MOST_BITS, max(12, (BITS_PER_KEY * max(count, 1) - 1).bit_length()))
    # Keys are well mixed: their first and their last bits are two places.
    spots = F.array(F.shiftrightunsigned("key", 64 - bits), F.col("key").bitwiseAND(F.lit((1 << bits) - 1)))
    words = keys.select(F.explode(spots).alias("bit")).groupBy(F.shiftright("bit", 6).alias("word"))
    found = words.agg(F.bit_or(F.expr("shiftleft(1L, CAST(bit & 63 AS INT))")).alias("set")).toArrow()
    table = np.zeros(1 << (bits - 6), np.uint64)
    table[np.asarray(found.column("word").combine_chunks())] = np.asarray(found.column("set").combine_chunks()).view(np.uint64)
    return spark.sparkContext.broadcast(table)


def members(table: np.ndarray) -> Members:
    """Whether each key is in a table made by :func:`member_table`; about one other key in a thousand passes too."""
    bits = len(table).bit_length() + 5

    def has(keys: np.ndarray) -> np.ndarray:
        out = np.ones(len(keys), bool)
        for bit in (keys >> np.uint64(64 - bits), keys & np.uint64((1 << bits) - 1)):
            out &= (table[bit >> np.uint64(6)] >> (bit & np.uint64(63))) & np.uint64(1) == 1
        return out

    return has


def _scan(docs: DataFrame, count: Callable[[Texts, _Tally], None]) -> DataFrame:
    """One pass over the texts; what a task's tally holds comes out as rows of ``_SCHEMA``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = _Tally()
        for b in slices(batches, "text", 3 << 20):
            count(Texts(b.column("text"), b.column("lang").to_pylist()), tally)
            yield from tally.batches(False)
        yield from tally.batches(True)

    return docs.select("text", "lang").mapInArrow(run, _SCHEMA)


def _frequent(rows: DataFrame, least: int, label: str) -> DataFrame:
    with small_batches(rows.sparkSession):
        return materialize(rows.groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("key"), label)


def propose(sample: DataFrame, least: int, longest: int) -> DataFrame:
    """``key`` of the phrases that occur ``least`` times in the sample; with a phrase, its parts are there.

    Words and pairs first, then all longer phrases whose pairs were kept.
    """

    def short(texts: Texts, tally: _Tally) -> None:
        places, keys = texts.words_at()
        tally.count(keys)
        tally.count(texts.longer(places, keys, 2, np.ones(len(places), bool))[1])

    pairs = _frequent(_scan(sample, short), least, "phrase-short")
    table = member_table(sample.sparkSession, pairs)

    def long(texts: Texts, tally: _Tally) -> None:
        has = members(table.value)
        places, keys = texts.words_at()
        part = has(keys)
        for length in range(2, longest + 1):
            places, keys = texts.longer(places, keys, length, part)
            part = np.ones(len(places), bool)
            if length == 2:
                part = has(keys)
            else:
                tally.count(keys)

    return pairs.union(_frequent(_scan(sample, long), least, "phrase-long")).distinct()


def frequent_phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, sample: int = SAMPLE) -> tuple[DataFrame, DataFrame]:
    """``lang, phrase, f`` of all phrases of up to ``longest`` words that occur ``least`` times in their language, and ``lang, n`` of its words.

    One row in ``sample``, by hash, proposes phrases at a threshold two standard deviations below
    its share. The full pass counts the proposals by their words, and by 64-bit keys the negative
    border: what occurs and is not proposed though its parts are. Border phrases that reach
    ``least`` are failures. The expansion pass counts them by their words, and with them whatever
    they open: phrases of any length all of whose parts are proposed, failed or so opened, not only
    the next border. So what it counts is closed, and the result does not depend on the sample.
    Keys that two border phrases share can only make a failure that the expansion finds to be none;
    a task tells the phrases it names apart by key, and by words within a batch.
    """
    spark = docs.sparkSession
    source = docs.select(F.coalesce(F.col("text"), F.lit("")).alias("text"), F.coalesce(F.col("lang"), F.lit("und")).alias("lang"), "doc_id")
    share = 1 / sample
    lowered = max(1, floor(share * least - 2 * sqrt(share * (1 - share) * least)))
    some = materialize(source.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(sample)) == 0), "phrase-sample")
    proposed = member_table(spark, propose(some, lowered, longest))

    def full(texts: Texts, tally: _Tally) -> None:
        for lang, n in zip(texts.langs, np.bincount(texts.doc, minlength=len(texts.langs)).tolist()):
            tally.sizes[lang] += n
        has = members(proposed.value)
        places, keys = texts.words_at()
        for length in range(1, longest + 1):
            if length > 1:
                places, keys = texts.longer(places, keys, length, part)
            part = has(keys)
            tally.count_named(texts, length, places[part], keys[part])
            tally.count(keys[~part])

    counts = _exact(source, full, least)
    found, sizes = counts.where("phrase IS NOT NULL"), counts.where("phrase IS NULL AND key IS NULL").select("lang", "n")
    failures = counts.where("key IS NOT NULL").select("key")
    if not failures.isEmpty():
        failed = member_table(spark, failures)

        def expansion(texts: Texts, tally: _Tally) -> None:
            old, fails = members(proposed.value), members(failed.value)
            places, keys = texts.words_at()
            for length in range(1, longest + 1):
                opened = np.zeros(len(places), bool)
                if length > 1:
                    fresh = np.zeros(len(texts.ids) + 1, bool)
                    fresh[places] = new
                    places, keys = texts.longer(places, keys, length, was | new)
                    opened = fresh[places] | fresh[places + 1]
                was = ~opened & old(keys)
                new = opened | (~was & fails(keys))
                tally.count_named(texts, length, places[new], keys[new])

        found = found.union(_exact(source, expansion, least).where("phrase IS NOT NULL"))
    return found.select("lang", "phrase", F.col("n").alias("f")), sizes


def _exact(source: DataFrame, count: Callable[[Texts, _Tally], None], least: int) -> DataFrame:
    """Sums of a pass over all texts: names and keys that reach ``least``, and the sizes of the languages."""
    with small_batches(source.sparkSession):
        sums = _scan(source, count).groupBy("lang", "phrase", "key").agg(F.sum("n").alias("n"))
        return materialize(sums.where((F.col("n") >= least) | (F.col("phrase").isNull() & F.col("key").isNull())), "phrase-counts")


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``top`` phrases of every language whose words occur together more than alone.

    Texts are lower-cased (A-Z), cut at ``.,;:!?`` and line ends, and cut into words at blanks and
    tabs; a phrase lies within one piece. It scores ``floor(1000 a n / (l r))`` at its worst cut
    into two parts, the first of such cuts; all in whole numbers of 38 digits. Phrases inside a
    longer frequent one that occurs as often are left out. Ties go to the larger count, then to
    byte order. A null language is ``und``; null, empty and blank texts have no words; rows that
    repeat an id count each. Other columns are ignored; an empty table gives no rows.
    """
    found, sizes = frequent_phrases(docs, least, longest)
    ws = F.split("phrase", " ")
    frequent = found.select("lang", "phrase", "f", ws.alias("ws"), F.size(ws).alias("words"))
    parts = frequent.select("lang", F.col("phrase").alias("part"), F.col("f").alias("part_f"))

    def joined(first, length):
        return F.concat_ws(" ", F.slice("ws", first, length))

    phrases = frequent.where("words > 1")
    inside = (
        phrases.where("words > 2")
        .select("lang", "ws", "words", "f", F.explode(F.sequence(F.lit(2), F.col("words") - 1)).alias("len"))
        .select("lang", "f", "ws", "len", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("len") + 1)).alias("at"))
        .select("lang", joined(F.col("at"), F.col("len")).alias("phrase"), "f")
        .groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    )
    kept = phrases.join(inside, ["lang", "phrase"], "left").where("longer IS NULL OR 100 * longer < 100 * f").drop("longer")
    cuts = kept.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cuts = cuts.withColumns({"left": joined(F.lit(1), F.col("k")), "right": joined(F.col("k") + 1, F.col("words") - F.col("k"))})
    cuts = cuts.select("lang", "phrase", "f", "k", "left", "right")
    for side, name in (("left", "l"), ("right", "r")):
        cuts = cuts.join(parts.select("lang", F.col("part").alias(side), F.col("part_f").alias(name)), ["lang", side])
    # Fixed-point types keep the products exact beyond 64 bits.
    score = F.expr("(1000 * CAST(f AS DECIMAL(17, 0)) * CAST(n AS DECIMAL(17, 0))) div (CAST(l AS DECIMAL(19, 0)) * CAST(r AS DECIMAL(19, 0)))")
    scored = cuts.join(sizes, "lang").withColumn("score", score)
    worst = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "f", "l", "r", "n")).alias("w"))
    order = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    out = worst.select("lang", "phrase", F.col("w.f").alias("a"), "w.l", "w.r", "w.n", "w.score").withColumn("rank", F.row_number().over(order))
    return out.where(F.col("rank") <= top).select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


COLLOCATIONS_SQL = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), split AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces
), sizes AS (
    SELECT lang, sum(len(ws))::BIGINT AS n FROM split GROUP BY lang
), grams AS (
    SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase FROM (
        SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM split, (SELECT unnest(range(1, 6)) AS k) WHERE len(ws) >= k)
), f AS (
    SELECT lang, k::BIGINT AS words, phrase, string_split(phrase, ' ') AS ws, count(*) AS f FROM grams GROUP BY lang, k, phrase HAVING count(*) >= 100
), inside AS (
    SELECT lang, array_to_string(ws[i:i + m - 1], ' ') AS phrase, max(f) AS longer FROM (
        SELECT lang, ws, f, m, unnest(range(1, words - m + 2)) AS i FROM (SELECT *, unnest(range(2, words)) AS m FROM f)) GROUP BY 1, 2
), cuts AS (
    SELECT f.lang, f.phrase, f.f AS a, f.ws, f.words, unnest(range(1, f.words)) AS k FROM f
    LEFT JOIN inside USING (lang, phrase) WHERE f.words > 1 AND (longer IS NULL OR 100 * longer < 100 * f.f)
), scored AS (
    SELECT c.lang, c.phrase, a, k, x.f AS l, y.f AS r, n, ((1000::HUGEINT * a * n) // (x.f::HUGEINT * y.f))::BIGINT AS score FROM cuts c
    JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.ws[1:c.k], ' ')
    JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.ws[c.k + 1:c.words], ' ') JOIN sizes ON sizes.lang = c.lang
), worst AS (
    SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM worst QUALIFY rank <= 2000
"""
