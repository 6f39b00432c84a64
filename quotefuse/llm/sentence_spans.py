"""Substring dedup by sliding sentence spans.

A sentence ends after a run of . ! or ? before white space, or at a line end.
A span starts at every sentence and runs over the fewest consecutive sentences
that are at least ``sentences`` many and hold at least ``words`` words; where
it starts it depends on nothing before it, so a repeated passage has the same
spans wherever it stands. With ``whole`` a span also ends at every sentence,
over the fewest sentences before it; so every sentence of a repeated passage
that holds that much lies in a span within the passage (from its start, or to
the passage's end). A text that holds less is one span. Stops beyond ASCII end
a sentence as well, each code point of a script without white space between
words is a word, and a sentence of more than ``words`` words counts as pieces:
one begins at each word whose hash (16 bytes from it) is the least of the three
words on both sides in its sentence, so that copies are cut alike whatever
stands around them; where no hash stands out, at every ``words`` words. Every span is hashed, the hashes are joined over all
documents, and every sentence that is covered by an occurrence of a repeated
span other than its first is removed with the white space after it. First is
the least document (by id, a null id last, then text hash), then the least
place in it.

Spans are equal if their 128-bit hashes are. A span's occurrences are never
gathered: its count and first document are partially aggregated, and the
occurrences meet them in an equi-join; those of a very frequent span meet it by
broadcast, so that no task has to read them all.

Defined results: null text stays null and has no sentences; a text shorter
than a span is kept whole (with ``whole`` its first copy only); rows equal in id and text are one document; a
document whose every sentence is removed becomes an empty text; other columns
pass through; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotefuse.llm.common import fresh, order_key, saved

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, *range(9, 14)]] = True
_STOP = np.zeros(256, dtype=bool)
_STOP[[33, 46, 63]] = True
_MULT = np.uint64(0x9E3779B97F4A7C15)
_MULTS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], dtype=np.uint64)
# stops that need no white space after them (CJK, half width, Arabic, Indic, Ethiopic, Myanmar, Khmer)
_WIDE_STOPS = np.array([0x61F, 0x6D4, 0x964, 0x965, 0x104A, 0x104B, 0x1362, 0x17D4, 0x17D5, 0x3002, 0xFF01, 0xFF0E, 0xFF1F, 0xFF61])
_WIDE_SPACES = np.array([0xA0, 0x3000])
# scripts without white space between words: first and last code point
_UNSPACED = np.array([(0xE00, 0xFFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x2E80, 0x2FDF), (0x3005, 0x3007), (0x3040, 0x312F), (0x31F0, 0x31FF),
                      (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x20000, 0x3FFFF)])
_FIRST = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=np.uint64)  # masks of the first bytes
# a piece begins at a word whose hash is the least among so many words on both sides
_NEAR = 3


def sentence_starts(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end (without white space after it) of every sentence, and its number of words."""
    b = np.frombuffer(data, dtype=np.uint8)
    if not len(b):
        return (np.zeros(0, np.int64),) * 3
    space = _SPACE[b]
    starts = np.flatnonzero(~space & np.concatenate(([True], space[:-1])))  # of words
    if not len(starts):
        return (np.zeros(0, np.int64),) * 3
    ends = np.flatnonzero(~space & np.concatenate((space[1:], [True]))) + 1
    newlines = np.concatenate(([0], np.cumsum(b == 10)))
    new_line = newlines[starts[1:]] > newlines[ends[:-1]]
    opens = np.flatnonzero(np.concatenate(([True], _STOP[b[ends[:-1] - 1]] | new_line)))
    last = np.concatenate((opens[1:], [len(starts)])) - 1
    return starts[opens], ends[last], last - opens + 1


def wide_words(b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word of a text beyond ASCII, and whether a stop beyond ASCII ends it (of all but the last)."""
    place = np.flatnonzero((b & 0xC0) != 0x80)  # of characters
    code = b[place].astype(np.int64)
    for lead, size in ((0xC0, 2), (0xE0, 3), (0xF0, 4)):
        at = np.flatnonzero((code >= lead) & (code < (lead >> 1 | 0x80)))
        wide = code[at] & (0xFF >> (size + 1))
        for k in range(1, size):
            wide = wide << 6 | (b[place[at] + k] & 0x3F)
        code[at] = -wide  # negative, so that no later lead takes it
    code = np.abs(code)
    side = np.searchsorted(_UNSPACED[:, 0], code, side="right") - 1
    alone = (side >= 0) & (code <= _UNSPACED[np.maximum(side, 0), 1])
    stop = np.isin(code, _WIDE_STOPS)
    space = _SPACE[b[place]] | np.isin(code, _WIDE_SPACES)
    before = lambda x, first: np.concatenate(([first], x[:-1]))
    opens = ~space & (before(space, True) | alone | before(alone, False) | before(stop, False))
    closes = ~space & np.concatenate(((space | opens)[1:], [True]))
    return place[opens], np.concatenate((place[1:], [len(b)]))[closes], stop[closes][:-1] & ~stop[opens][1:]


def words_of(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word (a code point in scripts without white space
    between words), and whether it begins a sentence; stops beyond ASCII count."""
    b = np.frombuffer(data, dtype=np.uint8)
    if data.isascii():
        space = _SPACE[b]
        start = np.flatnonzero(~space & np.concatenate(([True], space[:-1])))
        end = np.flatnonzero(~space & np.concatenate((space[1:], [True]))) + 1
        wide = False
    else:
        start, end, wide = wide_words(b)
    if not len(start):
        return start, end, np.zeros(0, dtype=bool)
    newlines = np.concatenate(([0], np.cumsum(b == 10)))
    ended = wide | (start[1:] > end[:-1]) & _STOP[b[end[:-1] - 1]] | (newlines[start[1:]] > newlines[end[:-1]])
    return start, end, np.concatenate(([True], ended))


def pieces(data: bytes, words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``sentence_starts`` with every sentence of more than ``words`` words cut into pieces."""
    start, end, opens = words_of(data)
    n = len(start)
    if not n:
        return start, end, start
    sentence = np.cumsum(opens) - 1
    first = np.flatnonzero(opens)
    count = np.diff(np.concatenate((first, [n])))
    if (count > words).any():
        limit = np.concatenate((end[first[1:] - 1], end[-1:]))[sentence]
        # of the 16 bytes from the word on, within its sentence
        eight, left = np.ndarray((len(data) + 9,), "<u8", data + bytes(16), strides=(1,)), limit - start
        h = (eight[start] & _FIRST[np.minimum(left, 8)]) * _MULT
        h ^= h >> np.uint64(29)
        h = (h ^ eight[start + 8] & _FIRST[np.clip(left - 8, 0, 8)]) * _MULT
        h ^= h >> np.uint64(29)
        least = count[sentence] > words
        for d in range(1, min(_NEAR, n - 1) + 1):
            other = sentence[d:] != sentence[:-d]
            least[d:] &= other | (h[d:] < h[:-d])
            least[:-d] &= other | (h[:-d] <= h[d:])
        opens = opens | least
        # where no hash stands out (the same words again and again): by number from the piece's start
        first = np.flatnonzero(opens)
        count = np.diff(np.concatenate((first, [n])))
        piece = np.cumsum(opens) - 1
        opens |= (count[piece] > 2 * words) & ((np.arange(n) - first[piece]) % words == 0)
        first = np.flatnonzero(opens)
        count = np.diff(np.concatenate((first, [n])))
    return start[first], end[first + count - 1], count


def runs(n_words: np.ndarray, sentences: int, words: int, whole: bool) -> tuple[np.ndarray, np.ndarray]:
    """First sentence and end of every hashed run, in order of place."""
    n = len(n_words)
    total = np.concatenate(([0], np.cumsum(n_words)))
    at = np.arange(n)
    stop = np.maximum(at + sentences, np.searchsorted(total, total[:-1] + words))
    first, stop = at[stop <= n], stop[stop <= n]
    if not whole or not n:
        return first, stop
    if not len(first):
        return np.zeros(1, np.int64), np.full(1, n)
    back = np.minimum(at + 1 - sentences, np.searchsorted(total, total[1:] - words, side="right") - 1)
    # as one number each: first, stop
    both = np.unique(np.concatenate((first * (n + 1) + stop, back[back >= 0] * (n + 1) + at[back >= 0] + 1)))
    return both // (n + 1), both % (n + 1)


def run_hashes(data: bytes, start: np.ndarray, end: np.ndarray, first: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Two 64-bit hashes of every run, from the two halves of its sentences' 128-bit hashes and their number."""
    one = np.frombuffer(b"".join([xxhash.xxh3_128_digest(data[s:e]) for s, e in zip(start.tolist(), end.tolist())]), "<u8").reshape(-1, 2)
    out, size = np.zeros((len(first), 2), dtype=np.uint64), stop - first
    for k in np.unique(size).tolist():
        which = np.flatnonzero(size == k)
        at = first[which]
        h = np.full((len(at), 2), k, dtype=np.uint64)
        for j in range(k):
            h = (h ^ one[at + j]) * _MULTS
            h ^= h >> np.uint64(29)
        out[which] = h
    return out


def occurrences(docs: DataFrame, sentences: int, words: int, whole: bool) -> DataFrame:
    """ord, hash, check, pos (its number in the document), again (not the first place of the two hashes in the document) of every span."""

    def run(batches):
        for b in batches:
            take, hashes, places, again = [], [], [], []
            for i, t in enumerate(b.column("text").to_pylist()):
                data = (t or "").encode("utf-8", "replace")
                start, end, n_words = pieces(data, words) if whole else sentence_starts(data)
                at, stop = runs(n_words, sentences, words, whole)
                if not len(at):
                    continue
                h = run_hashes(data, start, end, at, stop)
                first = np.zeros(len(at), dtype=bool)
                first[np.unique(h.view("V16").ravel(), return_index=True)[1]] = True
                take.append(np.full(len(at), i))
                hashes.append(h.view(np.int64))
                places.append(np.arange(len(at)))
                again.append(~first)
            if take:
                both = np.concatenate(hashes)
                yield pa.RecordBatch.from_arrays(
                    [b.column("ord").take(pa.array(np.concatenate(take))), pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy()),
                     pa.array(np.concatenate(places).astype(np.int32)), pa.array(np.concatenate(again))],
                    ["ord", "hash", "check", "pos", "again"])

    rows = docs.select(order_key(F.col("doc_id"), F.col("text")).alias("ord"), "text")
    return rows.mapInArrow(run, "ord decimal(38,0), hash long, check long, pos int, again boolean")


def repeated_places(found: DataFrame, hot_share: int) -> DataFrame:
    """ord and pos of every occurrence of a repeated span but the first.

    Spans are equal if both hashes are. They are grouped and joined by the first
    alone; where it stands for several of the second (``torn``) they are told apart
    by both. Hashes with more than one of ``hot_share`` of all occurrences, so fewer
    than ``hot_share`` hashes, are broadcast and their occurrences stay where they are."""
    groups = saved(found.groupBy("hash").agg(F.count("*").alias("n"), F.min("ord").alias("first"), F.min("check").alias("least"),
                                             F.max("check").alias("greatest")).where(F.col("n") > 1), "span_groups")
    torn = groups.where(F.col("least") != F.col("greatest")).select("hash")
    parts = found.join(torn, "hash", "left_semi")
    parts = (parts.groupBy("hash", "check").agg(F.count("*").alias("n"), F.min("ord").alias("first")).where(F.col("n") > 1)
             .join(found, ["hash", "check"]))
    later = F.col("again") | (F.col("ord") != F.col("first"))
    whole = groups.where(F.col("least") == F.col("greatest"))
    hot = F.col("n") > F.lit(found.count() // hot_share + 1)
    often = F.broadcast(whole.where(hot).select("hash", "first"))
    frequent = found.join(often, "hash")
    rest = found.join(F.broadcast(whole.where(hot).select("hash")), "hash", "left_anti").join(whole.where(~hot).select("hash", "first"), "hash")
    out = frequent.where(later).select("ord", "pos").unionByName(rest.where(later).select("ord", "pos"))
    return out.unionByName(parts.where(later).select("ord", "pos")) if torn.take(1) else out


def dedup(docs: DataFrame, sentences: int = 2, words: int = 16, whole: bool = False, hot_share: int = 1000) -> DataFrame:
    """``docs`` with the text cut, and n_sentences, n_removed of every row. With ``whole``
    both count the pieces that long sentences are cut into."""
    ord_, cut_ord, places, n_all, n_cut = fresh(docs, "ord", "cut_ord", "places", "n_sentences", "n_removed")
    found = saved(occurrences(docs.select("doc_id", "text"), sentences, words, whole), "spans")
    cuts = repeated_places(found, hot_share).groupBy(F.col("ord").alias(cut_ord)).agg(F.collect_set("pos").alias(places))
    rows = docs.withColumn(ord_, order_key(F.col("doc_id"), F.col("text")))
    rows = rows.join(cuts, F.col(ord_) == F.col(cut_ord), "left")
    names = docs.columns
    text_at = names.index("text")

    def rewrite(batches):
        for b in batches:
            texts, total, cut = [], [], []
            for t, at in zip(b.column("text").to_pylist(), b.column(places).to_pylist()):
                data = (t or "").encode("utf-8", "replace")
                start, _, n_words = pieces(data, words) if whole else sentence_starts(data)
                gone = np.zeros(len(start), dtype=bool)
                if at:
                    first, stop = runs(n_words, sentences, words, whole)
                    mark = np.zeros(len(start) + 1, dtype=np.int64)
                    at = np.array(at)
                    np.add.at(mark, first[at], 1)
                    np.add.at(mark, stop[at], -1)
                    gone = np.cumsum(mark)[:-1] > 0
                    edge = np.concatenate((start, [len(data)]))
                    kept = [data[edge[i]:edge[i + 1]] for i in np.flatnonzero(~gone).tolist()]
                    t = (b"" if whole and not kept else data[:edge[0]] + b"".join(kept)).decode()
                texts.append(t)
                total.append(len(start))
                cut.append(int(gone.sum()))
            columns = [b.column(c) for c in names]
            columns[text_at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays([*columns, pa.array(total, pa.int64()), pa.array(cut, pa.int64())], [*names, n_all, n_cut])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return rows.select(*names, places).mapInArrow(rewrite, f"{schema}, {n_all} long, {n_cut} long")
