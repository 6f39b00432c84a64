"""Phrase collocations by Rabin-Karp fingerprints.

Texts (A-Z lower-cased) fall into pieces at punctuation and line ends, pieces
into words at blanks and tabs; everything is counted per language. Inside a
task numpy prefix polynomials hash every word from its bytes and every run of 1
to 4 words from its words: a fingerprint is a difference of two prefix sums.

1. Runs of one and two words, then of three words whose word pairs may be
   frequent: the first 32 bits of fingerprints with partial counts are shuffled and
   summed. Those that reach ``least`` are marked in a bit table of fixed size. A sum
   is never under the count of any phrase that begins so and marks have no false
   negatives, so nothing frequent is lost; a full bit table only prunes less.
2. Marked runs, and runs of four words made of marked ones: each task sends the
   fingerprint, a second one by tables of random numbers instead of powers
   (together 128 bits), a count, and one number that points to an occurrence: 32
   bits of a hash of the text, and the byte. Spark sums the counts and keeps the
   least pointer. A task reads up to four splits here, since each task sends every
   frequent phrase that it meets.
3. Only what reaches ``least`` then meets the texts, and only the texts that are
   pointed at (the least hashes): the run of words at that byte must have the second
   fingerprint, so that of texts with one hash the right one answers. Phrases that
   collide in one fingerprint have met apart by the other.

Repeated texts are grouped before they are shuffled, so a text copied a million
times is shuffled once per task; a language or a word of any share is split by
the fingerprint.

A candidate (2 to 4 words, ``least`` occurrences) is cut after each of its
words; all parts are frequent too, so the counts of both parts come by
equi-joins. Scores are exact integer divisions of decimals. The candidates
inside longer ones are found by splitting the longer ones. The best rows of a
language are taken in two steps, per salt and then in all.

Defined results: null text is empty, null lang is ``und``; ids are not read;
repeated rows count each; languages without a candidate have no rows; ties in
score and count are ordered by the phrase's UTF-8 bytes; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotefuse.llm.common import saved, text_slices

MOST = 4                  # words of the longest phrase
BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64
HELD = 1 << 22            # fingerprints that a task holds before it writes counts out
SPOTS = 3 << 19           # pointers that a task holds
SPLITS = 4                # splits that a task reads for pointers, if there are tasks enough
LOW = np.uint64(0xFFFFFFFF)
BITS = 26                 # the bit table has 2**BITS bits (8 MB)
TABLE = np.random.default_rng(12).integers(0, 1 << 63, (64, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
KIND = np.zeros(256, dtype=np.uint8)  # 0: of a word, 1: between words, 2: ends a piece
KIND[[0x20, 0x09]] = 1
KIND[[ord(c) for c in ".,;:!?"] + [0x0A, 0x0B, 0x0C, 0x0D]] = 2


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit numbers (multiply and shift, a bijection)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def powers(base: int, size: int) -> np.ndarray:
    out = np.full(size, base, dtype=np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


class Prefix:
    """Prefix polynomial of a sequence of numbers: the span [s, e) has hash (P[e] - P[s]) * base**-s."""

    def __init__(self, values: np.ndarray, base: int = BASE):
        self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values * powers(base, len(values)))))
        self.down = powers(pow(base, -1, 1 << 64), len(values))

    def spans(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return (self.sums[stop] - self.sums[start]) * self.down[start]


class Words:
    """The words of a batch of texts: where they stand, their hashes, their pieces.

    ``row`` is the text of each word, ``start`` and ``stop`` are bytes within
    the batch; ``base`` is where each text begins there."""

    def __init__(self, texts: pa.Array, salt: np.ndarray):
        raw = texts.cast(pa.binary())
        offsets = np.frombuffer(raw.buffers()[1], dtype=np.int32)[raw.offset: raw.offset + len(raw) + 1].astype(np.int64)
        data = np.frombuffer(raw.buffers()[2] or b"", dtype=np.uint8)[offsets[0]: offsets[-1]]
        self.base = offsets[:-1] - offsets[0]
        self.data = LOWER[data]
        kind = KIND[data]
        inside = kind == 0
        # a text's first byte begins a word even if the text before ends in one
        joint = np.zeros(len(data) + 1, dtype=bool)
        joint[self.base] = True
        begins = inside & (np.concatenate(([True], ~inside[:-1])) | joint[:-1])
        ends = inside & (np.concatenate((~inside[1:], [True])) | joint[1:])
        self.start, self.stop = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        self.row = np.searchsorted(self.base, self.start, side="right") - 1
        # pieces: a new one wherever a piece's end or a text's end lies before the word
        self.piece = np.cumsum(kind == 2)[self.start] + self.row if len(data) else np.zeros(0, np.int64)
        self.salt = salt[self.row] if len(self.row) else np.zeros(0, np.uint64)
        letters = Prefix(self.data.astype(np.uint64) + np.uint64(1))
        self.words = Prefix(mixed(letters.spans(self.start, self.stop) + (self.stop - self.start).astype(np.uint64)))

    def runs(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """First word and fingerprint (language and length included) of all runs of ``n`` words of one piece."""
        size = max(len(self.start) - n + 1, 0)
        at = np.flatnonzero(self.piece[:size] == self.piece[n - 1: n - 1 + size])
        return at, mixed(self.words.spans(at, at + n) ^ (self.salt[at] + np.uint64(n)))

    def second(self) -> Prefix:
        """Prefixes for a second fingerprint: a word is the sum of a random number per byte and place in the word."""
        begins = np.concatenate(([0], self.start))
        place = np.arange(len(self.data)) - np.repeat(begins, np.diff(np.append(begins, len(self.data))))
        values = TABLE[place & 63, self.data] * (mixed((place >> 6).astype(np.uint64)) | np.uint64(1))
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values)))
        return Prefix(mixed(sums[self.stop] - sums[self.start]), BASE ^ 0x5DEECE66C)


def summed(packed: np.ndarray) -> np.ndarray:
    """Numbers of 32 bits of a fingerprint and 32 of a count: one for each fingerprint, counts summed."""
    packed = np.sort(packed)
    fp = packed & ~LOW
    heads = np.flatnonzero(np.concatenate(([True], fp[1:] != fp[:-1])))[: len(fp)]
    return fp[heads] | np.add.reduceat(packed & LOW, heads) if len(fp) else packed


def salts(langs: list[str]) -> np.ndarray:
    """A 64-bit number per row from its language."""
    known = {x: np.uint64(int.from_bytes(x.encode("utf-8", "replace"), "little") % ((1 << 61) - 1)) for x in set(langs)}
    return mixed(np.array([known[x] for x in langs], dtype=np.uint64))


def _rows(docs: DataFrame) -> DataFrame:
    """(lang, text, k): nulls replaced, and 32 bits of a hash that point to the text."""
    text, lang = F.coalesce("text", F.lit("")), F.coalesce("lang", F.lit("und"))
    return docs.select(lang.alias("lang"), text.alias("text"),
                       F.shiftright(F.xxhash64(text, lang), 32).cast("int").alias("k"))


def fewer_tasks(rows: DataFrame) -> DataFrame:
    """``rows`` in tasks of up to SPLITS splits, as long as that leaves two tasks a core."""
    splits = rows.rdd.getNumPartitions()
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.coalesce(max(1, min(splits, max(-(-splits // SPLITS), 2 * cores))))


def fingerprint_counts(rows: DataFrame, sizes: tuple[int, ...], marks: list[np.ndarray], bits: int) -> DataFrame:
    """(part, n): partial counts of the first 32 bits of the fingerprints of runs of some sizes;
    with ``marks`` (tables of shorter sizes) of the runs whose parts are all marked."""
    known = rows.sparkSession.sparkContext.broadcast(marks)

    def run(batches):
        held, size = [], 0

        def out():
            got = summed(np.concatenate(held))
            for at in range(0, len(got), 1 << 17):
                some = got[at: at + (1 << 17)]
                yield pa.RecordBatch.from_arrays([pa.array((some >> np.uint64(32)).astype(np.uint32).view(np.int32)),
                                                  pa.array((some & LOW).view(np.int64))], ["part", "n"])

        for b in text_slices(batches, "text"):
            words = Words(b.column("text"), salts(b.column("lang").to_pylist()))
            fp = np.concatenate([x for _, x in candidates(words, known.value, max(sizes), bits)[min(sizes) - 1:]])
            held.append(summed(fp & ~LOW | np.uint64(1)))
            size += len(held[-1])
            if size > HELD:
                yield from out()
                held, size = [], 0
        if held:
            yield from out()

    return rows.select("lang", "text").mapInArrow(run, "part int, n long")


def candidates(words: Words, marks: list[np.ndarray], most: int, bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(first word, fingerprint) of the runs of 1 to ``most`` words that are marked, as far as
    there are tables (the first one is of one and two words), and whose parts are."""
    out, before = [], None
    for n in range(1, most + 1):
        at, fp = words.runs(n)
        keep = np.ones(len(at), dtype=bool) if before is None else before[at] & before[at + 1]
        table = max(n - 2, 0)
        if table < len(marks):
            keep &= marked(marks[table], fp, bits)
        out.append((at[keep], fp[keep]))
        before = np.zeros(len(words.start) + 1, dtype=bool)
        before[at[keep]] = True
    return out


def bit_table(fps: DataFrame, bits: int) -> np.ndarray:
    """Marks of all fingerprints of ``fps``: at most 2**bits / 64 words are gathered."""
    place = F.shiftrightunsigned("fp", 64 - bits)
    got = fps.groupBy(F.shiftright(place, 6).alias("word")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned(fp, {64 - bits}) & 63 as int))")).alias("mask")).toPandas()
    out = np.zeros(max(1, 1 << (bits - 6)), dtype=np.uint64)
    out[got["word"].to_numpy(dtype=np.int64)] = got["mask"].to_numpy(dtype=np.int64).view(np.uint64)
    return out


def marked(table: np.ndarray, fp: np.ndarray, bits: int) -> np.ndarray:
    place = (fp >> np.uint64(64 - bits)).astype(np.int64)
    return (table[place >> 6] >> (place & 63).astype(np.uint64)) & np.uint64(1) == 1


NAMES = ["fp", "check", "words", "n", "spot"]


def merged(parts: list[list[np.ndarray]]) -> list[np.ndarray]:
    """One row per (fp, check): counts summed, the first pointer kept."""
    cols = [np.concatenate(x) for x in zip(*parts)]
    order = np.argsort(cols[0], kind="stable")
    fp, check = cols[0][order], cols[1][order]
    if ((fp[1:] == fp[:-1]) & (check[1:] != check[:-1])).any():  # phrases that share a fingerprint
        order = np.lexsort((cols[1], cols[0]))
        fp, check = cols[0][order], cols[1][order]
    heads = np.flatnonzero(np.concatenate(([True], (fp[1:] != fp[:-1]) | (check[1:] != check[:-1]))))[: len(fp)]
    counts = np.add.reduceat(cols[3][order], heads) if len(fp) else cols[3]
    return [counts if i == 3 else x[order[heads]] for i, x in enumerate(cols)]


def checks(words: Words, second: Prefix, at: np.ndarray, n: np.ndarray | int) -> np.ndarray:
    """Second fingerprints (language and length included) of the runs of ``n`` words from ``at``."""
    return mixed(second.spans(at, at + n) + words.salt[at] + mixed(np.full(len(at), n, dtype=np.uint64)))


def pointers(rows: DataFrame, marks: list[np.ndarray], bits: int) -> DataFrame:
    """Partial counts of the runs that may be frequent, each with one occurrence: ``spot``
    has the text's hash in its upper and the first byte there in its lower half."""
    known = rows.sparkSession.sparkContext.broadcast(marks)

    def run(batches):
        held, size = [], 0

        def out():
            cols = merged(held)
            for at in range(0, len(cols[0]), 1 << 17):
                part = [x[at: at + (1 << 17)] for x in cols]
                yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in part], NAMES)

        for b in text_slices(batches, "text"):
            b = b.take(pc.sort_indices(b.column("k")))  # so that the least hash is met first
            words = Words(b.column("text"), salts(b.column("lang").to_pylist()))
            second = words.second()
            key = b.column("k").to_numpy(zero_copy_only=False).astype(np.int64) << 32
            found = []
            for n, (at, fp) in enumerate(candidates(words, known.value, MOST, bits), 1):
                row = words.row[at]
                found.append([fp, checks(words, second, at, n), np.full(len(at), n, np.int64), np.ones(len(at), np.int64),
                              key[row] + words.start[at] - words.base[row]])
            held.append(merged(found))
            size += len(held[-1][0])
            if size > SPOTS:
                held = [merged(held)]
                size = len(held[0][0])
                if size > SPOTS * 2 // 3:
                    yield from out()
                    held, size = [], 0
        if held:
            yield from out()

    return fewer_tasks(rows).mapInArrow(run, ", ".join(f"{x} long" for x in NAMES))


def pointed(rows: DataFrame, spots: DataFrame, bits: int = 20) -> DataFrame:
    """(k, texts): the different texts with a hash that ``spots`` point at, and a few others:
    a bit table of fixed size spares the others the shuffle."""
    known = rows.sparkSession.sparkContext.broadcast(bit_table(spots.select(F.col("spot").alias("fp")), bits))

    def run(batches):
        for b in batches:
            k = b.column("k").to_numpy(zero_copy_only=False).astype(np.int64) << 32
            yield b.filter(pa.array(marked(known.value, k.view(np.uint64), bits)))

    texts = rows.mapInArrow(run, rows.schema)
    return texts.groupBy("k").agg(F.collect_set(F.struct("lang", "text")).alias("texts"))


def cut_out(data: DataFrame) -> DataFrame:
    """(lang, words, phrase, n) from texts with ``spots``: the words at a byte of the text
    (lower case, one space between them), where they have the second fingerprint."""

    def run(batches):
        for b in text_slices(batches, "text"):
            words = Words(b.column("text"), salts(b.column("lang").to_pylist()))
            second, raw = words.second(), words.data.tobytes()
            spots = b.column("spots")
            row = np.repeat(np.arange(b.num_rows), pc.list_value_length(spots).to_numpy(zero_copy_only=False))
            check, n, count, at = (spots.flatten().field(x).to_numpy(zero_copy_only=False) for x in ("check", "words", "n", "at"))
            place = words.base[row] + at
            first = np.searchsorted(words.start, place)
            fits = np.flatnonzero(first + n <= len(words.start))
            fits = fits[(words.start[first[fits]] == place[fits]) & (words.row[first[fits]] == row[fits])]
            fits = fits[words.piece[first[fits]] == words.piece[first[fits] + n[fits] - 1]]
            fits = fits[checks(words, second, first[fits], n[fits]) == check[fits].view(np.uint64)]
            lang = b.column("lang").take(pa.array(row[fits]))
            phrases = [b" ".join(raw[words.start[i]: words.stop[i]] for i in range(first[x], first[x] + n[x])).decode("utf-8", "replace")
                       for x in fits]
            yield pa.RecordBatch.from_arrays([lang, pa.array(n[fits]), pa.array(phrases, pa.string()), pa.array(count[fits])],
                                             ["lang", "words", "phrase", "n"])

    return data.select("lang", "text", "spots").mapInArrow(run, "lang string, words long, phrase string, n long")


WORD = r"[^.,;:!?\n-\r \t]+"


def phrase_counts(docs: DataFrame, least: int = 30, bits: int = BITS) -> DataFrame:
    """(lang, words, phrase, f) of all runs of 1 to 4 words with f >= ``least``."""
    rows, marks = _rows(docs), []
    for sizes in ((1, 2), (3,)):
        often = fingerprint_counts(rows, sizes, marks, bits).groupBy("part").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
        marks.append(bit_table(often.select(F.shiftleft(F.col("part").cast("long"), 32).alias("fp")), bits))
    spots = saved(pointers(rows, marks, bits).groupBy("fp", "check", "words").agg(F.sum("n").alias("n"), F.min("spot").alias("spot"))
                  .where(F.col("n") >= least).select("check", "words", "n", "spot"), "phrase-pointers")
    # all that points at one hash: at most the runs of a text or two
    by_text = (spots.withColumn("k", F.shiftright("spot", 32).cast("int"))
               .withColumn("at", F.col("spot").bitwiseAND(F.lit((1 << 31) - 1)))
               .groupBy("k").agg(F.collect_list(F.struct("check", "words", "n", "at")).alias("spots")))
    data = pointed(rows, spots).join(by_text, "k").select("spots", F.explode("texts").alias("t")).select("t.*", "spots")
    # texts of one hash may both begin with the phrase: it is one row all the same
    counted = cut_out(data).groupBy("lang", "words", "phrase").agg(F.max("n").alias("f"))
    return saved(counted, "phrase-counts")


def word_totals(docs: DataFrame) -> DataFrame:
    """(lang, n): all word occurrences of each language."""
    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.groupBy("lang").agg(F.sum(F.regexp_count("text", F.lit(WORD))).cast("long").alias("n"))


def part(start: Column | int, size: Column | int) -> Column:
    """Words ``start`` (from 1) to start + size - 1 of the phrase."""
    return F.array_join(F.slice(F.split("phrase", " "), start, size), " ")


def exact(x: Column) -> Column:
    return x.cast("decimal(20,0)")


def mine(docs: DataFrame, least: int = 30, top: int = 2000, inside: int = 80, scale: int = 2_000_000, salts: int = 64,
         bits: int = BITS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``top`` collocations of each language."""
    counted, totals = phrase_counts(docs, least, bits), word_totals(docs)
    parts = counted.select("lang", F.col("phrase").alias("part"), "f")
    whole = counted.where(F.col("words") > 1).select("lang", "phrase", "words", F.col("f").alias("a"))
    cuts = whole.withColumn("k", F.explode(F.sequence(F.lit(1).cast("long"), F.col("words") - 1)))
    cuts = cuts.select("lang", "phrase", "words", "a", "k", part(1, F.col("k").cast("int")).alias("left"),
                       part((F.col("k") + 1).cast("int"), (F.col("words") - F.col("k")).cast("int")).alias("right"))
    cuts = (cuts.join(parts.select("lang", F.col("part").alias("left"), F.col("f").alias("l")), ["lang", "left"])
            .join(parts.select("lang", F.col("part").alias("right"), F.col("f").alias("r")), ["lang", "right"]))
    product = exact(F.col("a")) * F.lit(scale).cast("decimal(10,0)")
    cuts = cuts.withColumn("score", F.call_function("div", product, exact(F.col("l")) + exact(F.col("r"))))
    best = cuts.groupBy("lang", "phrase", "words", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    longer = whole.where(F.col("words") > 2).select(
        "lang", "a", "words", "phrase", F.explode(F.sequence(F.lit(2).cast("long"), F.col("words") - 1)).alias("m"))
    longer = longer.withColumn("start", F.explode(F.sequence(F.lit(1).cast("long"), F.col("words") - F.col("m") + 1)))
    longer = (longer.select("lang", part(F.col("start").cast("int"), F.col("m").cast("int")).alias("phrase"), "a")
              .groupBy("lang", "phrase").agg(F.max("a").alias("longer")))
    swallowed = exact(F.col("longer")) * 100 >= exact(F.col("a")) * inside
    kept = (best.join(longer, ["lang", "phrase"], "left").where(~F.coalesce(swallowed, F.lit(False)))
            .select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), F.col("cut.score").alias("score")))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salt = F.pmod(F.xxhash64("phrase"), F.lit(salts))
    few = (kept.withColumn("salt", salt).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order)))
           .where(F.col("rank") <= top).drop("salt", "rank"))
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return (ranked.where(F.col("rank") <= top).join(totals, "lang")
            .select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))
