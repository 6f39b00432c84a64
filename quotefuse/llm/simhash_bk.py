"""SimHash near-duplicates found with BK-trees.

Fingerprint: words are runs outside ASCII white space of the text with A-Z
lower-cased; shingles are ``size`` consecutive words joined by a space (fewer
words: the whole sequence; none: fingerprint zero); each shingle counts with
its XXH64 (seed 42), and a bit is set if more than half of the hashes set it.

Links: fingerprints within ``radius`` bits. Copies collapse first: the graph
has one node per distinct fingerprint. The 64 bits are cut into radius + 1
bands; two linked fingerprints agree on at least one band, so a shard is (band,
value of the band). In each shard the fingerprints form a BK-tree - children
keyed by their integer distance to the parent - and each member follows only
edges within the radius. A shard over ``shard_rows`` fingerprints is cut again
by bands of its remaining bits (second level); one that is still over it is
served in pieces, each piece's tree against every piece of the shard. A shard
reports a spanning set of its links, never all pairs, and connected components
of these give the groups. Shard trees reach their tasks by the shuffle instead
of a broadcast variable, because fingerprints of all documents have no size
bound.

Defined results: null text is a text without words; texts without words link
to each other; a null id gets a row and the group's least non-null id (null if
there is none); repeated rows each get a row; other columns are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotefuse.llm.common import fresh, saved
from quotefuse.llm.components import components

CHUNK = 1 << 22


def word_blocks(data: bytes, keep: int, chunk: int = CHUNK):
    """Lists of words of ``data``, block by block; each block repeats the
    last ``keep`` words of the one before."""
    at, tail = 0, []
    while at < len(data):
        end = at + chunk
        if end < len(data):
            while end < len(data) and data[end] not in b" \t\n\r\x0b\x0c":
                end += 1
        words = tail + data[at:end].split()
        if len(words) > len(tail):
            yield words
            tail = words[-keep:] if keep else []
        at = end


def fingerprint(text: str | None, size: int) -> int:
    """Signed 64-bit fingerprint of a whole text."""
    data = (text or "").encode("utf-8", "replace").lower()
    ones, total, short = np.zeros(64, dtype=np.int64), 0, []
    digest = xxhash.xxh64_intdigest
    for words in word_blocks(data, size - 1):
        if len(words) < size:
            short = words
            continue
        line = b" ".join(words)
        stops = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1)
        starts = np.concatenate(([0], stops[:-1]))
        n = len(words) - size + 1
        h = np.array([digest(line[s:e], 42) for s, e in zip(starts[:n].tolist(), (stops[size - 1:] - 1).tolist())],
                     dtype=np.uint64)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        total += n
    if not total:
        if not short:
            return 0
        one = np.array([digest(b" ".join(short), 42)], dtype=np.uint64)
        return int(one.view(np.int64)[0])
    bits = np.packbits((2 * ones > total).astype(np.uint8), bitorder="little")
    return int(bits.view(np.int64)[0])


def fingerprints(docs: DataFrame, size: int = 3) -> DataFrame:
    """doc_id, text hash and fingerprint (long) of every row."""

    def run(batches):
        for b in batches:
            fp = [fingerprint(t, size) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("h"), pa.array(fp, pa.int64())],
                                             ["doc_id", "h", "fp"])

    rows = docs.select("doc_id", F.xxhash64("text").alias("h"), "text")
    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {id_type}, h long, fp long")


class BKTree:
    """Distinct integers; each child hangs on the edge of its distance to the parent."""

    def __init__(self, values):
        self.root, self.children = None, {}
        for v in values:
            self.add(v)

    def add(self, v: int) -> None:
        if self.root is None:
            self.root = v
            self.children[v] = {}
            return
        at = self.root
        while True:
            d = (at ^ v).bit_count()
            if d == 0:
                return
            down = self.children[at].get(d)
            if down is None:
                self.children[at][d] = v
                self.children[v] = {}
                return
            at = down

    def within(self, v: int, radius: int) -> list[int]:
        """Members at most ``radius`` bits from ``v``."""
        out, todo = [], [self.root] if self.root is not None else []
        while todo:
            at = todo.pop()
            d = (at ^ v).bit_count()
            if d <= radius:
                out.append(at)
            for edge, child in self.children[at].items():
                if -radius <= edge - d <= radius:
                    todo.append(child)
        return out


def spanning(tree_values: list[int], queries: list[int], radius: int) -> list[tuple[int, int]]:
    """Edges that connect what the links of ``queries`` into the tree connect."""
    parent: dict[int, int] = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    tree = BKTree(tree_values)
    for q in queries:
        for hit in tree.within(q, radius):
            a, b = find(q), find(hit)
            if a != b:
                parent[max(a, b)] = min(a, b)
    return [(x, r) for x in parent if (r := find(x)) != x]


def bands(width: int, parts: int) -> list[tuple[int, int]]:
    """(first bit, number of bits) of ``parts`` near-equal bands."""
    edge = [width * i // parts for i in range(parts + 1)]
    return [(a, b - a) for a, b in zip(edge, edge[1:])]


def band_value(fp: Column, at: int, n: int) -> Column:
    return F.shiftrightunsigned(fp, at).bitwiseAND(F.lit((1 << n) - 1))


def shard_rows_level1(fps: DataFrame, radius: int) -> DataFrame:
    """fp with its shard key at each of the radius + 1 bands."""
    keys = [F.struct(F.lit(i).cast("long").alias("band"), band_value(F.col("fp"), a, n).alias("value"))
            for i, (a, n) in enumerate(bands(64, radius + 1))]
    return fps.select("fp", F.explode(F.array(*keys)).alias("k")).select("fp", "k.band", "k.value")


def shard_rows_level2(rows: DataFrame, radius: int) -> DataFrame:
    """Shards cut again: bands of the 64 bits without the first band's."""
    cut = bands(64, radius + 1)
    keys = []
    for i, (a, n) in enumerate(cut):
        rest = F.shiftrightunsigned(F.col("fp"), a + n) if a + n < 64 else F.lit(0).cast("long")
        rest = F.shiftleft(rest, a).bitwiseOR(F.col("fp").bitwiseAND(F.lit((1 << a) - 1)))
        for j, (b, m) in enumerate(bands(64 - n, radius + 1)):
            keys.append(F.when(F.col("band") == i, F.struct(
                (F.lit((i + 1) * 1000 + j)).cast("long").alias("band"),
                F.col("value").bitwiseOR(F.shiftleft(band_value(rest, b, m), n)).alias("value"))))
    return (rows.select("fp", F.explode(F.array(*keys)).alias("k")).where(F.col("k").isNotNull())
            .select("fp", "k.band", "k.value"))


def _tree_edges(radius: int):
    """Task function over rows sorted by shard; streams one shard at a time.
    Within a shard side 0 is the tree and side 1 the queries; without side 1
    rows the tree's members are the queries."""

    def run(batches):
        key, tree, asked = None, [], []
        out_a, out_b = [], []

        def close():
            if len(tree) + len(asked) > 1 and tree:
                for a, b in spanning(tree, asked or tree, radius):
                    out_a.append(a)
                    out_b.append(b)

        def signed(v):
            return pa.array(np.array(v, dtype=np.uint64).view(np.int64))

        for batch in batches:
            fps = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64).tolist()
            sides = batch.column("side").to_pylist()
            keys = zip(batch.column("band").to_pylist(), batch.column("value").to_pylist(), batch.column("piece").to_pylist())
            for k, fp, side in zip(keys, fps, sides):
                if k != key:
                    close()
                    key, tree, asked = k, [], []
                (asked if side else tree).append(fp)
            if len(out_a) > 50_000:
                yield pa.RecordBatch.from_arrays([signed(out_a), signed(out_b)], ["a", "b"])
                out_a.clear()
                out_b.clear()
        close()
        if out_a:
            yield pa.RecordBatch.from_arrays([signed(out_a), signed(out_b)], ["a", "b"])

    return run


def _search(rows: DataFrame, radius: int) -> DataFrame:
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (rows.repartition(n, "band", "value", "piece").sortWithinPartitions("band", "value", "piece", "side")
            .mapInArrow(_tree_edges(radius), "a long, b long"))


def links(fps: DataFrame, radius: int = 3, shard_rows: int = 2000) -> DataFrame:
    """Edges (a, b) of distinct fingerprints ``fps`` (fp long) whose closure is
    the closure of all links within ``radius``."""
    plain = (F.lit(0).alias("side"), F.lit(0).cast("long").alias("piece"))
    over = F.col("n") > shard_rows
    level1 = shard_rows_level1(fps, radius)
    big = saved(level1.groupBy("band", "value").agg(F.count("*").alias("n")).where(over), "shards")
    if big.isEmpty():
        return _search(level1.select("fp", "band", "value", *plain), radius)
    rows1 = level1.join(big, ["band", "value"], "left_anti")
    out = _search(rows1.select("fp", "band", "value", *plain), radius)
    level2 = shard_rows_level2(level1.join(big, ["band", "value"], "left_semi"), radius)
    big2 = saved(level2.groupBy("band", "value").agg(F.count("*").alias("n")).where(over), "shards")
    rows2 = level2.join(big2, ["band", "value"], "left_anti")
    out = out.unionByName(_search(rows2.select("fp", "band", "value", *plain), radius))
    if big2.isEmpty():
        return out
    # pieces of a shard: piece (t, q) holds the tree of part t and asks part q
    parts = big2.select("band", "value", F.ceil(F.col("n") / shard_rows).cast("long").alias("parts"))
    cut = level2.join(parts, ["band", "value"]).withColumn("part", F.pmod(F.xxhash64("fp"), F.col("parts")))
    turn = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))
    tree = cut.select("fp", "band", "value", F.lit(0).alias("side"), "part", "parts", turn.alias("other")).select(
        "fp", "band", "value", "side", (F.col("part") * F.col("parts") + F.col("other")).alias("piece"))
    ask = cut.select("fp", "band", "value", F.lit(1).alias("side"), "part", "parts", turn.alias("other")).select(
        "fp", "band", "value", "side", (F.col("other") * F.col("parts") + F.col("part")).alias("piece"))
    return out.unionByName(_search(tree.unionByName(ask), radius))


def grouped(docs: DataFrame, size: int = 3, radius: int = 3, shard_rows: int = 2000) -> DataFrame:
    """doc_id, text hash ``h``, fp and group ``root`` (its least fingerprint) of every row."""
    rows = saved(fingerprints(docs, size), "simhash")
    groups = components(links(rows.select("fp").distinct(), radius, shard_rows))
    return rows.join(groups.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def near_duplicates(docs: DataFrame, **params) -> DataFrame:
    """doc_id, fingerprint (hex), component_id for every row."""
    placed = grouped(docs, **params)
    least = placed.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return placed.join(least, "root").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, **params) -> DataFrame:
    """``docs`` with one row of each group: the least id (a null id comes
    last), of rows with one id the least text hash, of equal rows any."""
    least = F.min(F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("i"), F.col("h").alias("h")))
    first = grouped(docs, **params).groupBy("root").agg(least.alias("m"))
    h, keep_id, keep_h = fresh(docs, "text_hash", "keep_id", "keep_hash")
    ids = first.select(F.col("m.i").alias(keep_id), F.col("m.h").alias(keep_h)).distinct()
    kept = docs.withColumn(h, F.xxhash64("text")).join(
        ids, F.col("doc_id").eqNullSafe(F.col(keep_id)) & (F.col(h) == F.col(keep_h)), "left_semi")
    return kept.dropDuplicates(["doc_id", h]).drop(h)
