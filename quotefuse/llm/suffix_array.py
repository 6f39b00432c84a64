"""Removal of repeated 200-byte strings by suffix arrays (difference cover).

Texts are UTF-8 bytes; a byte goes if it is covered by a string of ``length``
bytes that also starts anywhere else, in this or another document.

Distribution. Winnowing picks anchors: in every ``window`` consecutive places
the place whose 8-byte hash is least. Two equal strings of ``length`` bytes
have an anchor at one and the same offset under ``window``, and the ``length -
window`` bytes after it agree. So anchors that agree on these bytes (a class)
hold all repeats between them, each at equal offsets from its anchors. Anchors
of a class of one cannot be in a repeat.

Suffix sorting. Each string belongs to one anchor, the least place of its first
``window``; the context of an anchor is all that its strings reach. Equal contexts collapse first: such strings are repeats without more
work. The different contexts of the classes are laid end to end in batches,
and each batch gets its suffix array by the difference cover modulo 3: sort
the triples at the sampled places (1 and 2 mod 3), name them, recurse on the
names until they are unique or as long as the strings asked for, then merge
the remaining suffixes (0 mod 3) by their first letter and the rank after it.
Adjacent prefixes of ``length`` bytes are then compared byte for byte.

A class with over ``class_rows`` different contexts is not gathered: its
strings are counted by 128-bit hash in a partially aggregated group-by.

Sorting every suffix of the corpus as a row of its own would shuffle tens of
times the input; the classes give the same repeats from a small part of it.

Defined results: null is an empty text; texts under ``length`` bytes stay
whole; repeated rows are repeats of each other; a null id is a document like
others; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotefuse.llm.common import order_key, saved, slices

GRAM = 8
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_LOW = np.uint64((1 << 24) - 1)
PART = 1 << 23  # places winnowed at once


def anchors(data: bytes, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places that are the least (of equal ones the last) of some ``window``
    consecutive places, and the first and last start of the windows they are least of."""
    n = len(data) - GRAM + 1
    if n < window:
        return (np.zeros(0, np.int64),) * 3
    found = []
    for at in range(0, n - window + 1, PART):
        m = min(n - at, PART + window - 1)
        raw = np.frombuffer(data, dtype=np.uint8, count=m + GRAM - 1, offset=at)
        h = np.lib.stride_tricks.as_strided(raw.view(), (m, GRAM), (1, 1)).copy().view(np.uint64)[:, 0]
        h *= _M1
        h ^= h >> np.uint64(32)
        h *= _M2
        v = (h & ~_LOW) | (_LOW - np.arange(m, dtype=np.uint64))
        # least of every window from running minima over blocks of the window's size
        full = np.full(-(-m // window) * window, np.iinfo(np.uint64).max, dtype=np.uint64)
        full[:m] = v
        grid = full.reshape(-1, window)
        ahead = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
        behind = np.minimum.accumulate(grid, axis=1).ravel()
        least = np.minimum(ahead[: m - window + 1], behind[window - 1: m])
        found.append(at + (_LOW - (least & _LOW)).astype(np.int64))
    least = np.concatenate(found)  # never falls, so each anchor has one run
    first = np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1])))
    return least[first], first, np.concatenate((first[1:], [len(least)])) - 1


def order_of(keys: np.ndarray) -> np.ndarray:
    """A stable order of the keys; packed with the places and sorted as numbers where 64 bits hold both."""
    bits = len(keys).bit_length()
    if len(keys) and int(keys.max()).bit_length() + bits <= 64:
        packed = np.sort((keys.astype(np.uint64) << np.uint64(bits)) | np.arange(len(keys), dtype=np.uint64))
        return (packed & np.uint64((1 << bits) - 1)).astype(np.int64)
    return np.argsort(keys, kind="stable")


def named(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Rank of each key among the different keys, an order of the keys, and their number."""
    order = order_of(keys)
    up = keys[order]
    new = np.concatenate(([0], np.cumsum(up[1:] != up[:-1])))
    name = np.empty(len(keys), dtype=np.int64)
    name[order] = new
    return name, order, int(new[-1]) + 1


def suffix_order(s: np.ndarray, asked: int, covered: int = 1) -> np.ndarray:
    """Order of the suffixes of ``s`` (positive integers) by their first
    ``asked`` letters at least; a letter stands for ``covered`` of them."""
    n = len(s)
    if n < 6:
        return np.array(sorted(range(n), key=lambda i: s[i:].tolist()), dtype=np.int64)
    t = np.concatenate((s, np.zeros(3, dtype=np.int64))).astype(np.uint64)
    top = np.uint64(int(t.max()) + 1)
    sampled = np.concatenate((np.arange(1, n + (n % 3 == 1), 3), np.arange(2, n, 3)))
    triples = (t[sampled] * top + t[sampled + 1]) * top + t[sampled + 2]
    order = None
    if int(top) ** 3 <= 1 << 24:  # few letters: a table of the triples in use names them without a sort
        used = np.zeros(int(top) ** 3, dtype=bool)
        used[triples] = True
        name, names = (np.cumsum(used, dtype=np.int32)[triples] - 1).astype(np.int64), int(np.count_nonzero(used))
    else:
        name, order, names = named(triples)
    if names == len(sampled) or 3 * covered >= asked:
        order = order_of(name) if order is None else order
    else:
        order = suffix_order(name + 1, asked, 3 * covered)
    rank = np.zeros(n + 3, dtype=np.uint64)
    rank[sampled[order]] = np.arange(1, len(sampled) + 1, dtype=np.uint64)
    rank[n:] = 0
    order = sampled[order]
    order = order[order < n]
    rest = np.arange(0, n, 3)
    size = np.uint64(n + 3)
    rest_one = t[rest] * size + rank[rest + 1]
    by = order_of(rest_one)
    rest, rest_one = rest[by], rest_one[by]

    def two(at):
        return (t[at] * top + t[at + 1]) * size + rank[at + 2]

    # keys rise along each order, but for suffixes alike in all letters asked for
    rest_two = np.maximum.accumulate(two(rest))
    is_one = order % 3 == 1
    ones, twos = order[is_one], order[~is_one]
    key_one = np.maximum.accumulate(t[ones] * size + rank[ones + 1])
    key_two = np.maximum.accumulate(two(twos))
    # places in the merged order: how many of each kind come before
    place = np.empty(n, dtype=np.int64)
    place[rest] = np.arange(len(rest)) + np.searchsorted(key_one, rest_one) + np.searchsorted(key_two, rest_two)
    own = np.arange(len(order))
    place[ones] = own[is_one] + np.searchsorted(rest_one, key_one, side="right")
    place[twos] = own[~is_one] + np.searchsorted(rest_two, key_two, side="right")
    out = np.full(n, -1, dtype=np.int64)
    place = np.minimum(place, n - 1)
    out[place] = np.arange(n)
    return out if out.min() >= 0 else np.argsort(place, kind="stable")


def repeats(contexts: list[bytes], lefts: list[int], classes: list, length: int) -> list[np.ndarray]:
    """For each context the offsets (from anchor back to string start) of the
    strings that another context of its class has at the same offset."""
    data = np.frombuffer(b"".join(contexts) + bytes(length), dtype=np.uint8)
    edges = np.concatenate(([0], np.cumsum([len(c) for c in contexts])))
    total = int(edges[-1])
    letters = np.zeros(256, dtype=np.int64)
    here = np.unique(data[:total])
    letters[here] = np.arange(1, len(here) + 1)
    order = suffix_order(letters[data[:total]], length)
    owner = np.repeat(np.arange(len(contexts)), np.diff(edges))
    offset = np.array(lefts)[owner] - (np.arange(total) - edges[owner])
    whole = np.arange(total) + length <= edges[owner + 1]
    order = order[whole[order]]
    out = [np.zeros(0, np.int64)] * len(contexts)
    if len(order) < 2:
        return out
    # compare adjacent prefixes: some words first, then all bytes of those that pass
    a, b = order[:-1], order[1:]
    same = np.ones(len(a), dtype=bool)
    words = np.lib.stride_tricks.as_strided(data, (total + length - 8, 8), (1, 1))
    for at in (0, length - 8, length // 2):
        here = np.flatnonzero(same)
        same[here] = (words[a[here] + at] == words[b[here] + at]).all(axis=1)
    rows = np.lib.stride_tricks.as_strided(data, (total, length), (1, 1))
    here = np.flatnonzero(same)
    for at in range(0, len(here), 1 << 14):
        part = here[at: at + (1 << 14)]
        same[part] = (rows[a[part]] == rows[b[part]]).all(axis=1)
    group = np.concatenate(([0], np.cumsum(~same)))
    number = {c: i for i, c in enumerate(dict.fromkeys(classes))}
    kind = np.array([number[c] for c in classes])[owner[order]]
    off = offset[order]
    least, span = int(off.min()), int(off.max() - off.min()) + 1
    key = (group * len(number) + kind) * span + (off - least)
    _, at, counted = np.unique(key, return_inverse=True, return_counts=True)
    hit = order[counted[at] > 1]
    hit = hit[np.argsort(owner[hit], kind="stable")]
    cut = np.searchsorted(owner[hit], np.arange(len(contexts) + 1))
    return [np.unique(offset[hit[cut[i]:cut[i + 1]]]) for i in range(len(contexts))]


def runs_of(places: np.ndarray) -> list[tuple[int, int]]:
    """[from, to) runs of sorted distinct integers."""
    if not len(places):
        return []
    edge = np.flatnonzero(np.diff(places) > 1)
    return list(zip(places[np.concatenate(([0], edge + 1))].tolist(), (places[np.concatenate((edge, [len(places) - 1]))] + 1).tolist()))


def joined(docs: DataFrame, side: DataFrame, rows: int, most: int, how: str) -> DataFrame:
    """``docs`` joined with a written ``side`` on ord, broadcast if it has at most ``most`` values."""
    return docs.join(F.broadcast(side) if rows <= most else side, "ord", how)


def mark_anchors(docs: DataFrame, length: int, window: int) -> DataFrame:
    """ord, a, far and near (offsets of its first and last string), ck (hash of
    the bytes after the anchor), x (hash of its context) of every anchor."""
    after = length - window

    def run(batches):
        for b in slices(batches):
            take, at, far, near, ck, x = [], [], [], [], [], []
            for i, t in enumerate(b.column("text").to_pylist()):
                data = (t or "").encode("utf-8", "replace")
                if len(data) < length:
                    continue
                places, first, last = anchors(data, window)
                last = np.minimum(last, len(data) - length)
                mine = first <= last
                places, first, last = places[mine], first[mine], last[mine]
                take.append(np.full(len(places), i))
                at.append(places)
                far.append(places - first)
                near.append(places - last)
                ck += [xxhash.xxh64_intdigest(data[a:a + after]) for a in places.tolist()]
                x += [xxhash.xxh64_intdigest(data[lo:hi + length], a - lo) for a, lo, hi in zip(places.tolist(), first.tolist(), last.tolist())]
            if take:
                yield pa.RecordBatch.from_arrays(
                    [b.column("ord").take(pa.array(np.concatenate(take))), pa.array(np.concatenate(at).astype(np.int32)),
                     *(pa.array(np.concatenate(v).astype(np.int16)) for v in (far, near)),
                     *(pa.array(np.array(v, dtype=np.uint64).view(np.int64)) for v in (ck, x))], ["ord", "a", "far", "near", "ck", "x"])

    return docs.mapInArrow(run, "ord decimal(38,0), a int, far short, near short, ck long, x long")


def covered_runs(docs: DataFrame, length: int, window: int, class_rows: int, broadcast_values: int, batch_bytes: int) -> DataFrame:
    """ord and the byte runs that go; ``docs`` has ord and text."""
    marks = saved(mark_anchors(docs, length, window), "anchors")
    shared = marks.groupBy("ck").agg(F.count("*").alias("m")).where(F.col("m") > 1).select("ck")
    marks = saved(marks.join(shared, "ck"), "shared_anchors")
    contexts = saved(marks.groupBy("ck", "x").agg(F.count("*").alias("n"), F.min("ord").alias("ord")), "contexts")
    # classes with a context of its own kind to compare: the others are settled by their counts
    classes = contexts.groupBy("ck").agg(F.count("*").alias("kinds"), F.min("n").alias("least")).where(
        (F.col("kinds") > 1) & (F.col("least") == 1)).select("ck", "kinds")
    chosen = contexts.join(classes, "ck")
    places = marks.join(chosen, ["ck", "x", "ord"]).groupBy("ord", "ck", "x").agg(
        F.min("a").alias("a"), F.max("far").alias("far"), F.min("near").alias("near"), F.max("kinds").alias("kinds"))
    wanted = saved(places.groupBy("ord").agg(F.collect_list(F.struct("a", "far", "near", "ck", "x", "kinds")).alias("want")), "wanted")
    held = wanted.select(F.size("want").alias("n"), F.array_max(F.transform("want", lambda w: w["kinds"])).alias("k")).agg(
        F.sum("n").alias("n"), F.max("k").alias("k")).first()
    values = held["n"] or 0

    def cut(batches):
        for b in slices(batches):
            out = []
            for t, want in zip(b.column("text").to_pylist(), b.column("want").to_pylist()):
                data = (t or "").encode("utf-8", "replace")
                out += [(w["ck"], w["x"], w["kinds"], w["far"], data[w["a"] - w["far"]:w["a"] - w["near"] + length]) for w in want]
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, k) for v, k in zip(zip(*out), (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()))],
                    ["ck", "x", "kinds", "left", "bytes"])

    pieces = joined(docs, wanted, values, broadcast_values, "inner").mapInArrow(
        cut, "ck long, x long, kinds long, left int, bytes binary")
    usual = pieces.where(F.col("kinds") <= class_rows)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def sort(batches):
        held, size, last, kind = [], 0, None, None

        def close():
            got = repeats([h[3] for h in held], [h[2] for h in held], [h[0] for h in held], length)
            rows = [(h[0], h[1], lo, hi) for h, offs in zip(held, got) for lo, hi in runs_of(offs)]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, k) for v, k in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int32(), pa.int32()))], ["ck", "x", "lo", "hi"])

        for b in slices(batches, 2048):
            for row in zip(*(b.column(c).to_pylist() for c in ("ck", "x", "left", "bytes"))):
                if size > batch_bytes and row[0] != last:
                    yield from close()
                    held, size = [], 0
                if (row[0], row[1]) != (last, kind):  # of rows equal in id and text one is enough
                    held.append(row)
                    size += len(row[3])
                last, kind = row[0], row[1]
        if held:
            yield from close()

    found = (usual.select("ck", "x", "left", "bytes").repartition(parts, "ck").sortWithinPartitions("ck", "x")
             .mapInArrow(sort, "ck long, x long, lo int, hi int"))

    def windows(batches):
        for b in batches:
            for ck, x, left, data in zip(*(b.column(c).to_pylist() for c in ("ck", "x", "left", "bytes"))):
                offs = list(range(left - (len(data) - length), left + 1))
                hashes = [xxhash.xxh128_digest(data[left - o:left - o + length]) for o in offs]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([ck] * len(offs), pa.int64()), pa.array([x] * len(offs), pa.int64()), pa.array(offs, pa.int32()),
                     pa.array(hashes, pa.binary())], ["ck", "x", "o", "w"])

    if (held["k"] or 0) > class_rows:
        crowded = pieces.where(F.col("kinds") > class_rows).select("ck", "x", "left", "bytes").mapInArrow(
            windows, "ck long, x long, o int, w binary").distinct()
        often = crowded.groupBy("ck", "o", "w").agg(F.count("*").alias("k")).where(F.col("k") > 1).select("ck", "o", "w")
        more = crowded.join(often, ["ck", "o", "w"]).select("ck", "x", F.col("o").alias("lo"), (F.col("o") + 1).alias("hi"))
        found = found.unionByName(more)
    copied = contexts.where(F.col("n") > 1).select("ck", "x", F.lit(None).cast("int").alias("lo"), F.lit(None).cast("int").alias("hi"))
    singles = found.join(contexts.where(F.col("n") == 1).select("ck", "x"), ["ck", "x"], "left_semi")
    starts = marks.join(copied.unionByName(singles), ["ck", "x"]).groupBy("ord").agg(
        F.collect_set(F.struct((F.col("a") - F.coalesce(F.col("hi") - 1, F.col("far"))).alias("lo"),
                               (F.col("a") - F.coalesce("lo", F.col("near")) + 1).alias("hi"))).alias("runs"))

    def merge(batches):
        for b in batches:
            out = []
            for runs in b.column("runs").to_pylist():
                merged = []
                for lo, hi in sorted((max(0, r["lo"]), r["hi"]) for r in runs):
                    if merged and lo <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], hi)
                    else:
                        merged.append([lo, hi])
                out.append([v for run in merged for v in run])
            yield pa.RecordBatch.from_arrays([b.column("ord"), pa.array(out, pa.list_(pa.int32()))], ["ord", "starts"])

    return saved(starts.mapInArrow(merge, "ord decimal(38,0), starts array<int>"), "starts")


def dedup(docs: DataFrame, length: int = 200, window: int = 150, class_rows: int = 4000,
          broadcast_values: int = 1_000_000, batch_bytes: int = 1 << 18) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (bytes) of every row."""
    rows = docs.select("doc_id", "text", order_key(F.col("doc_id"), F.col("text")).alias("ord"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    starts = covered_runs(rows.select("ord", "text"), length, window, class_rows, broadcast_values, batch_bytes)
    values = starts.agg(F.sum(F.size("starts"))).first()[0] or 0

    def remove(batches):
        for b in slices(batches):
            out = []
            for t, runs in zip(b.column("text").to_pylist(), b.column("starts").to_pylist()):
                data = (t or "").encode("utf-8", "replace")
                cut, kept, at = [], [], 0
                for lo, hi in zip((runs or [])[::2], (runs or [])[1::2]):
                    hi = min(hi, len(data) - length + 1)  # strings that end in the text
                    if hi <= lo:
                        continue
                    if cut and lo <= cut[-1][1]:
                        cut[-1][1] = hi - 1 + length
                    else:
                        cut.append([lo, hi - 1 + length])
                for lo, hi in cut:
                    kept.append(data[at:lo])
                    at = hi
                kept.append(data[at:])
                out.append((len(data), sum(hi - lo for lo, hi in cut), len(cut), b"".join(kept)))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), *(pa.array(v, k) for v, k in zip(zip(*out), (pa.int64(), pa.int64(), pa.int64(), pa.binary())))],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return joined(rows, starts, values, broadcast_values, "left").select("doc_id", "text", "starts").mapInArrow(
        remove, f"doc_id {id_type}, n_bytes long, n_removed long, n_spans long, kept binary")


def digest(docs: DataFrame, **params) -> DataFrame:
    """The kept bytes as their digest."""
    return dedup(docs, **params).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


