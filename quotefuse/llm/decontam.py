"""Benchmark decontamination as a prefix-filtered set join.

Words are runs outside ASCII non-alphanumerics with A-Z lower-cased. A window
is ``window`` consecutive words of an item (the whole item if it has fewer); it
is contained in a document if its words stand there consecutively.

Every window is the set of its shingles (``shingle`` consecutive words, fewer
in a shorter window). Shingles are ordered by rarity, counted over all
documents. Containment asks for every shingle of a window, so its rarest one
is the necessary prefix: document shingles are joined with the prefixes only.
A joined pair must pass the length bound (the document has at least the
window's words) and the positional bound (the window, laid at the prefix's
position, starts and ends inside the document), and is then verified word for
word over the window.

The benchmark is joined in blocks of whole items, each at most ``block_words``
words (a longer item is a block of its own windows), so what is broadcast has
that bound whatever the benchmark's size; every block meets all documents.

Defined results: null text has no words; an item without words has no
windows; rows with a null item_id are hit words too but are not listed or
counted; an item_id on several rows is one item; repeated documents are scored
one by one; an empty benchmark hits nothing; other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quotefuse.llm.common import fresh, saved

_WORD = bytes(ord(chr(c).lower()) if c < 128 and chr(c).isalnum() else c if c >= 128 else 32 for c in range(256))
_MULT = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").translate(_WORD).split()


class Index:
    """Windows and shingles of one block of items, with words as numbers."""

    def __init__(self, items: list[tuple], window: int, shingle: int):
        self.ids: dict[bytes, int] = {}
        self.shingle = shingle
        found: dict[tuple, set] = defaultdict(set)
        for item_id, text in items:
            got = [self.ids.setdefault(w, len(self.ids)) for w in words_of(text)]
            for at in range(max(1, len(got) - window + 1) if got else 0):
                found[tuple(got[at: at + window])].add(item_id)
        self.windows = sorted(found)
        self.items = [sorted(str(i) for i in found[w] if i is not None) for w in self.windows]
        self.lengths = sorted({min(shingle, len(w)) for w in self.windows})
        keys = [self.keys(np.array(w, dtype=np.int64), min(shingle, len(w))) for w in self.windows]
        self.window_keys = keys
        self.vocabulary = np.unique(np.concatenate(keys)) if keys else np.zeros(0, np.uint64)

    def numbers(self, text: str | None) -> np.ndarray:
        get = self.ids.get
        words = words_of(text)
        return np.fromiter((get(w, -1) for w in words), dtype=np.int64, count=len(words))

    @staticmethod
    def keys(ids: np.ndarray, n: int) -> np.ndarray:
        """A hash of every n consecutive numbers; also of n, so lengths differ."""
        u = (ids + 2).astype(np.uint64)
        h = np.full(max(0, len(u) - n + 1), n, dtype=np.uint64)
        for i in range(n):
            h = (h ^ u[i: i + len(h)]) * _MULT
            h ^= h >> np.uint64(31)
        return h

    def positions(self, ids: np.ndarray, n: int) -> np.ndarray:
        """Starts of shingles of length n whose words the block knows."""
        if len(ids) < n:
            return np.zeros(0, np.int64)
        known = np.concatenate(([0], np.cumsum(ids >= 0)))
        return np.flatnonzero(known[n:] - known[:-n] == n)


def shingle_counts(docs: DataFrame, index) -> dict[int, int]:
    """Occurrences over all documents of each shingle of the block."""

    def run(batches):
        ix = index.value
        total = np.zeros(len(ix.vocabulary), dtype=np.int64)
        for b in batches:
            for t in b.column("text").to_pylist():
                ids = ix.numbers(t)
                for n in ix.lengths:
                    keys = ix.keys(ids, n)[ix.positions(ids, n)]
                    if len(keys) and len(total):
                        at = np.minimum(np.searchsorted(ix.vocabulary, keys), len(total) - 1)
                        np.add.at(total, at[ix.vocabulary[at] == keys], 1)
        got = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(got, pa.int64()), pa.array(total[got], pa.int64())], ["key", "n"])

    rows = docs.select("text").mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    return {r["key"]: r["n"] for r in rows.collect()}


def prefixes(ix: Index, counted: dict[int, int]) -> tuple[np.ndarray, dict[int, list]]:
    """Sorted prefix keys, and for each the (window, offset) pairs it stands for."""
    found: dict[int, list] = defaultdict(list)
    for w, keys in enumerate(ix.window_keys):
        ranks = [(counted.get(int(at), 0), int(k), off) for off, (k, at) in enumerate(zip(keys, np.searchsorted(ix.vocabulary, keys)))]
        _, key, off = min(ranks)
        found[key].append((w, off))
    return np.array(sorted(found), dtype=np.uint64), dict(found)


def occurrences(ix: Index, prefix_keys: np.ndarray, prefix_of: dict, ids: np.ndarray):
    """(window numbers, starts) of every verified occurrence in a document."""
    at_windows, at_starts = [], []
    for n in ix.lengths:
        pos = ix.positions(ids, n)
        if not len(pos):
            continue
        keys = ix.keys(ids, n)[pos]
        at = np.minimum(np.searchsorted(prefix_keys, keys), len(prefix_keys) - 1)
        hit = prefix_keys[at] == keys
        pos, at = pos[hit], at[hit]
        for key in np.unique(at):
            here = pos[at == key]
            for w, off in prefix_of[int(prefix_keys[key])]:
                want = np.array(ix.windows[w], dtype=np.int64)
                start = here - off
                start = start[(start >= 0) & (start + len(want) <= len(ids))]  # length and positional bounds
                if len(start):
                    start = start[(ids[start[:, None] + np.arange(len(want))] == want).all(axis=1)]
                    at_starts.append(start)
                    at_windows.append(np.full(len(start), w))
    if not at_starts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(at_windows), np.concatenate(at_starts)


def item_blocks(benchmark: DataFrame, block_words: int):
    """Whole items in lists of at most ``block_words`` words, read one block at a time."""
    words = F.greatest(F.length(F.coalesce("text", F.lit(""))), F.lit(1))
    rows = benchmark.select("item_id", "text").where(F.col("text").isNotNull()).withColumn("n", words)
    total = rows.agg(F.sum("n").alias("n")).first()["n"] or 0
    parts = max(1, -(-total // max(1, 2 * block_words)))
    for part in range(parts):
        here = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part) if parts > 1 else rows
        got, size = [], 0
        for r in here.select("item_id", "text").toLocalIterator():
            n = len(words_of(r["text"]))
            if got and size + n > block_words:
                yield got
                got, size = [], 0
            got.append((r["item_id"], r["text"]))
            size += n
        if got:
            yield got


def spans(docs: DataFrame, benchmark: DataFrame, window: int = 10, shingle: int = 5,
          block_words: int = 500_000) -> list[DataFrame]:
    """For each block of the benchmark, rows of ``docs`` (doc_id, text) as doc_id, n_words,
    runs (array of [start, end) word runs that are hit), items: all of them for the first
    block, those with hits for the others. Of several blocks each is written, and its
    broadcasts freed, before the index of the next is built."""
    sc = docs.sparkSession.sparkContext
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, h long, n_words long, runs array<struct<s:long,e:long>>, items array<string>"
    rows = docs.select("doc_id", F.xxhash64("text").alias("h"), "text")
    out = []
    left = item_blocks(benchmark, block_words)
    items, more = next(left, None), next(left, None)
    while items is not None:
        ix, items, more = Index(items, window, shingle), more, next(left, None)
        if not ix.windows:
            continue
        index = sc.broadcast(ix)
        ready = sc.broadcast(prefixes(ix, shingle_counts(docs, index)))

        def run(batches, index=index, ready=ready):
            ix, (prefix_keys, prefix_of) = index.value, ready.value
            for b in batches:
                n, runs, items = [], [], []
                for t in b.column("text").to_pylist():
                    ids = ix.numbers(t)
                    w, start = occurrences(ix, prefix_keys, prefix_of, ids)
                    n.append(len(ids))
                    mark = np.zeros(len(ids) + 2, dtype=np.int64)
                    if len(w):
                        np.add.at(mark, start + 1, 1)
                        np.add.at(mark, start + 1 + np.array([len(ix.windows[i]) for i in w]), -1)
                    edge = np.diff((np.cumsum(mark) > 0).astype(np.int8), append=0)
                    runs.append([{"s": s, "e": e} for s, e in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist())])
                    items.append(sorted({i for k in set(w.tolist()) for i in ix.items[k]}))
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), b.column("h"), pa.array(n, pa.int64()),
                     pa.array(runs, pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())]))), pa.array(items, pa.list_(pa.string()))],
                    ["doc_id", "h", "n_words", "runs", "items"])

        part = rows.mapInArrow(run, schema)
        if out or items is not None:
            part = saved(part.where(F.size("runs") > 0) if out else part, "block_hits")
            index.destroy()
            ready.destroy()
        out.append(part)
    if not out:
        def count(batches):
            for b in batches:
                n = [len(words_of(t)) for t in b.column("text").to_pylist()]
                none = pa.array([[]] * len(n), pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())])))
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), b.column("h"), pa.array(n, pa.int64()), none, pa.array([[]] * len(n), pa.list_(pa.string()))],
                    ["doc_id", "h", "n_words", "runs", "items"])

        out.append(rows.mapInArrow(count, schema))
    return out


def hits(docs: DataFrame, benchmark: DataFrame, **params) -> DataFrame:
    """doc_id, h, n_words, runs, items of every row, over all blocks."""
    parts = spans(docs, benchmark, **params)
    if len(parts) == 1:
        return parts[0]
    # the same rows once for each block: equal rows are told apart by a turn number, which may pair them in any order
    turn = Window.partitionBy("block", "doc_id", "h").orderBy("n_words")
    rows = None
    for i, p in enumerate(parts):
        p = p.withColumn("block", F.lit(i))
        rows = p if rows is None else rows.unionByName(p)
    rows = rows.withColumn("turn", F.row_number().over(turn))
    merged = rows.groupBy("doc_id", "h", "turn").agg(
        F.max("n_words").alias("n_words"),  # the first block has every row, the others those with hits
        F.flatten(F.collect_list("runs")).alias("runs"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))
    return merged.drop("turn")


def decontaminate(docs: DataFrame, benchmark: DataFrame, **params) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every row."""
    rows = hits(docs.select("doc_id", "text"), benchmark, **params)
    # runs of several blocks may overlap: add what each run adds beyond the furthest end so far
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("to"))
    n_hit = F.aggregate(F.array_sort("runs"), start, lambda acc, r: F.struct(
        (acc["n"] + F.greatest(F.lit(0).cast("long"), r["e"] - F.greatest(r["s"], acc["to"]))).alias("n"),
        F.greatest(acc["to"], r["e"]).alias("to")), lambda acc: acc["n"])
    return rows.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("items")).cast("binary"), 256).alias("items_sha256"),
        (F.size("runs") > 0).alias("contaminated"))


def clean(docs: DataFrame, benchmark: DataFrame, **params) -> DataFrame:
    """``docs`` without the rows that hold a benchmark window."""
    h, bad_id, bad_h = fresh(docs, "text_hash", "bad_id", "bad_hash")
    bad = hits(docs.select("doc_id", "text"), benchmark, **params).where(F.size("runs") > 0).select(
        F.col("doc_id").alias(bad_id), F.col("h").alias(bad_h)).distinct()
    return docs.withColumn(h, F.xxhash64("text")).join(
        bad, F.col("doc_id").eqNullSafe(F.col(bad_id)) & (F.col(h) == F.col(bad_h)), "left_anti").drop(h)


