"""Order MinHash fingerprints, in DataFrame operations only.

A text's items are its word ``k``-mers (words: runs outside white space; k
consecutive ones joined by a space; a text with fewer words is one item; a
text without words has none), numbered by occurrence, so that repeats stay
different items. Each item is hashed once; the top ``BIN_BITS`` bits of the
hash name one of ``BINS`` sketches and the rest orders the items in it. A
sketch selects its ``pick`` minimal items, puts them back into text order, and
hashes that tuple: two texts share a sketch value only if they share these
items in the same order, so the share of equal sketches falls with edit
distance. Sketches without items take the value of the next one that has any
(counted up, around the end), mixed with the distance to it.

Everything is computed inside a row from arrays; there is no shuffle for a
fingerprint. The top 34 bits of a hash are packed with the position into one
long and sorted as primitives; a text may have up to 2**30 words.

The fingerprint has 8 hex digits for each sketch; likeness is the share of
equal sketches (two texts without words are alike, 1; one without, 0).

Defined results: null is an empty text; equal texts have equal fingerprints;
repeated rows follow one another in the order of descending id (nulls last),
then text hash; a single document is its own next one; other columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import Counter

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotefuse.llm.common import let, saved

BIN_BITS = 5
BINS = 1 << BIN_BITS
POS_BITS = 30


def _pack(value: Column, position: Column) -> Column:
    """The top bits of ``value`` above the position."""
    return value.bitwiseAND(F.lit(-(1 << POS_BITS))).bitwiseOR(position.cast("long"))


def _position(packed: Column) -> Column:
    return packed.bitwiseAND(F.lit((1 << POS_BITS) - 1)).cast("int")


def _top(packed: Column) -> Column:
    return F.shiftright(packed, POS_BITS)


def _bin(packed: Column) -> Column:
    """0 to BINS - 1, ascending in the order of packed values."""
    return F.shiftright(packed, 64 - BIN_BITS) + F.lit(BINS // 2)


def words_of(text: Column) -> Column:
    """Runs outside white space; a split can leave an empty first and last piece."""
    def inner(w):
        first = (F.get(w, F.lit(0)) == "").cast("int")
        last = ((F.size(w) > 1) & (F.element_at(w, -1) == "")).cast("int")
        return F.slice(w, first + 1, F.size(w) - first - last)

    return let(F.split(F.coalesce(text, F.lit("")), r"\s+"), inner)


def items(words: Column, k: int) -> Column:
    """Hashes of the word k-mers, in text order."""
    def gram(i):
        return F.xxhash64(*[F.coalesce(F.get(words, i + j), F.lit("")) for j in range(k)])

    last = F.greatest(F.size(words) - F.lit(k), F.lit(0))
    return F.when(F.size(words) > 0, F.transform(F.sequence(F.lit(0), last), gram)).otherwise(F.array().cast("array<bigint>"))


def numbered(hashes: Column) -> Column:
    """Packed (hash of item and occurrence number, position), unsorted.
    Sorting by (hash, position) puts equal items side by side in text order;
    an item's number is its place in that run."""
    def number(s):
        first = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: (i == 0) | (_top(F.get(s, i)) != _top(F.get(s, i - 1))))
        return let(first, lambda starts: F.flatten(F.transform(starts, lambda at, j: F.transform(
            F.slice(s, at + 1, F.coalesce(F.get(starts, j + 1), F.size(s)) - at),
            lambda x, occ: _pack(F.xxhash64(F.get(hashes, _position(x)), occ), _position(x))))))

    return let(F.sort_array(F.transform(hashes, _pack)), number)


def sketches(hashes: Column, pick: int) -> Column:
    """One value for each bin from the item hashes of a text (null: no items)."""
    def choose(s):
        # the first ``pick`` of each bin in sorted order
        return F.filter(s, lambda x, i: (i < pick) | (_bin(F.get(s, F.greatest(i - pick, F.lit(0)))) != _bin(x)))

    def tuples(chosen):
        def one(x, i):
            mine = F.filter(F.slice(chosen, i + 1, pick), lambda y: _bin(y) == _bin(x))
            in_text = F.transform(F.sort_array(F.transform(mine, _position)), lambda p: F.get(hashes, p))
            value = F.aggregate(in_text, F.xxhash64(F.lit(0).cast("long")), lambda acc, h: F.xxhash64(acc, h))
            return F.when((i == 0) | (_bin(F.get(chosen, F.greatest(i - 1, F.lit(0)))) != _bin(x)),
                          F.struct(_bin(x).cast("int").alias("bin"), value.alias("v")))
        return F.array_compact(F.transform(chosen, one))

    def dense(found):
        def one(b):
            e = F.coalesce(F.get(F.filter(found, lambda e: e["bin"] >= b), F.lit(0)), F.get(found, F.lit(0)))
            return let(e, lambda e: F.when(e["bin"] == b, e["v"]).otherwise(F.xxhash64(e["v"], F.pmod(e["bin"] - b, F.lit(BINS)))))
        return F.when(F.size(found) == BINS, F.transform(found, lambda e: e["v"])).otherwise(
            F.transform(F.sequence(F.lit(0), F.lit(BINS - 1)), one))

    return F.when(F.size(hashes) > 0, let(let(let(F.sort_array(numbered(hashes)), choose), tuples), dense))


def fingerprint(text: Column, k: int = 2, pick: int = 2) -> Column:
    """8 hex digits for each sketch; empty for a text without words."""
    sketch = let(let(words_of(text), lambda w: items(w, k)), lambda h: sketches(h, pick))
    digits = F.transform(sketch, lambda v: F.lpad(F.lower(F.hex(F.shiftrightunsigned(v, 32))), 8, "0"))
    return F.coalesce(F.array_join(digits, ""), F.lit(""))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal sketches of two fingerprints."""
    def same(i):
        return F.substring(a, i * 8 + 1, F.lit(8)) == F.substring(b, i * 8 + 1, F.lit(8))

    equal = F.size(F.filter(F.sequence(F.lit(0), F.lit(BINS - 1)), same))
    return F.when((a == "") | (b == ""), (a == b).cast("double")).otherwise(equal / F.lit(float(BINS)))


MOST_RANGES = 500_000  # of ids; over 500,000 x range_rows rows they hold more rows each


def split_ids(ids: DataFrame, range_rows: int) -> list[int | None]:
    """The id of the first and then of every ``range_rows``-th row of each task
    of a distributed sort by descending id (null last) and hash."""
    step = max(range_rows, -(-ids.count() // MOST_RANGES))
    at = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)  # place within the task
    ordered = ids.orderBy(F.desc_nulls_last("doc_id"), "h").withColumn("at", at)
    return [r["doc_id"] for r in ordered.where(F.col("at") % step == 0).select("doc_id").collect()]


def with_next(rows: DataFrame, ids: DataFrame, columns: list[str], range_rows: int) -> DataFrame:
    """Adds ``next_<c>`` of the next row by descending doc_id (after the last:
    the first), and the row's ``place``. Rows are dealt into ranges of ids, about ``range_rows`` rows
    each, whatever the number of rows; an id (or null) that fills several
    ranges is cut by its text hash into as many parts. The first row of each
    range is also put at the end of the range before, so every successor is
    found inside a range. ``ids`` has doc_id and h of the same rows from before
    any costly column was added; it is read several times."""
    starts = split_ids(ids, range_rows)
    times = Counter(starts)
    nulls = max(1, times.pop(None, 0))
    lows = sorted({float(i) for i in times})
    splits = [float("-inf"), *lows, float("inf")]
    # a frequent id is the least of its range (as doubles; of equal doubles the largest id is taken)
    often = {bisect_right(lows, float(i)): (i, n) for i, n in sorted(times.items()) if n > 1}
    table = rows.sparkSession.createDataFrame([(at, i, n) for at, (i, n) in often.items()], "id_range int, often long, parts int")

    def with_place(df):
        """``place``: (range, part of the range), ascending in the order of the rows."""
        value = F.coalesce(F.col("doc_id").cast("double"), F.lit(0.0))
        if lows:
            df = Bucketizer(splits=splits, inputCol="id_value", outputCol="id_range").transform(df.withColumn("id_value", value))
        df = df.withColumn("id_range", F.when(F.col("doc_id").isNull(), len(splits)).otherwise(
            F.col("id_range").cast("int") if lows else F.lit(0)))
        df = df.join(F.broadcast(table), "id_range", "left") if often else df.withColumns(
            {"often": F.lit(None).cast("long"), "parts": F.lit(None).cast("int")})  # at most MOST_RANGES and one per task
        spread = F.col("h") / F.lit(2.0**64) + 0.5
        part = (F.when(F.col("doc_id").isNull(), F.floor(spread * nulls))
                .when(F.col("doc_id") == F.col("often"), F.floor(spread * F.col("parts")) + 1)
                .when(F.col("doc_id") < F.col("often"), F.col("parts") + 2).otherwise(0))
        turn = F.when(F.col("doc_id").isNull(), len(splits)).otherwise(F.lit(len(splits)) - 1 - F.col("id_range"))
        place = F.struct(turn.cast("int").alias("range"), part.cast("int").alias("part"))
        return df.withColumn("place", place).drop("id_value", "id_range", "often", "parts")

    order = F.struct(F.col("doc_id").isNull().alias("n"), (-F.col("doc_id")).alias("i"), F.col("h").alias("h"))
    firsts = sorted(with_place(ids).groupBy("place").agg(F.min(order).alias("m")).select("place", "m.i", "m.h").collect())
    if not firsts:
        return rows.select("*", *[F.col(c).alias(f"next_{c}") for c in columns])
    ghosts = [(firsts[j - 1]["place"], None if r["i"] is None else -r["i"], r["h"]) for j, r in enumerate(firsts)]
    ghosts = rows.sparkSession.createDataFrame(ghosts, "ghost_place struct<range int, part int>, ghost_id long, ghost_h long")
    held = with_place(rows).join(F.broadcast(ghosts), F.col("doc_id").eqNullSafe(F.col("ghost_id")) & (F.col("h") == F.col("ghost_h")), "left")
    plain = F.struct(F.col("place").alias("place"), F.lit(False).alias("ghost"))
    again = F.struct(F.col("ghost_place").alias("place"), F.lit(True).alias("ghost"))
    held = held.withColumn("spot", F.explode(F.when(F.col("ghost_place").isNull(), F.array(plain)).otherwise(F.array(plain, again))))
    held = held.select(*rows.columns, F.col("spot.place").alias("place"), F.col("spot.ghost").alias("ghost"))
    w = Window.partitionBy("place").orderBy("ghost", F.desc_nulls_last("doc_id"), "h")
    led = held.select(*rows.columns, "place", "ghost", *[F.lead(c).over(w).alias(f"next_{c}") for c in columns])
    return led.where(~F.col("ghost")).drop("ghost")


def report(docs: DataFrame, k: int = 2, pick: int = 2, range_rows: int = 2000) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness."""
    text = F.coalesce(F.col("text"), F.lit(""))
    plain = docs.select("doc_id", F.xxhash64(text).alias("h"), text.alias("text"))
    # explode of one value keeps a fingerprint from being computed again by each use
    rows = plain.withColumn("fp", F.explode(F.array(fingerprint(F.col("text"), k, pick))))
    rows = with_next(rows, saved(plain.select("doc_id", "h"), "order-minhash-ids"), ["text", "fp"], range_rows)
    n = F.length("text")
    part = F.floor(n / F.lit(3)).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - part), F.substring("next_text", F.lit(1), part))
    rows = rows.select("doc_id", n.cast("long").alias("n_chars"), "fp", "next_fp", F.explode(F.array(edited)).alias("edited"))
    rows = rows.select("doc_id", "n_chars", "fp", "next_fp", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                       F.explode(F.array(fingerprint(F.col("edited"), k, pick))).alias("edited_fp"))
    return rows.select("doc_id", "n_chars", "edited_sha256", F.col("fp").alias("fingerprint"), F.col("edited_fp").alias("edited_fingerprint"),
                       likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"), likeness(F.col("fp"), F.col("next_fp")).alias("near_next"))
