"""Mixing sources to target weights by temperature.

A source's natural share is its part of all tokens (runs outside white space
of whole texts). Weights are proportional to share ** alpha. Alpha is the
largest value in [0, 1] whose entropy reaches the target; if a source would
then be repeated more than ``max_epochs`` times, alpha is raised to the least
value that keeps the repetition limit (1 always does when the budget is at
most ``max_epochs`` passes). Both are bisections: each round evaluates a grid
of exponents in one aggregation over the table of sources, so the sources are
never gathered.

The weights are realised within a token budget as block permutations. The
documents of a source are dealt into blocks of about ``block_rows`` rows by a
hash; a source's quota of tokens (weight x budget) is a number of full passes
plus a part of one. Each pass is its own permutation of the blocks, and of the
rows in each block, both by hash. The last pass takes whole blocks in that
order while they fit, and from the next block the rows, in order, that still
fit. So a source gets at most its quota, and misses it by less than one
document unless it ends early.

The result has a row for every use of a document: doc_id, source, n_tokens,
weight (of the source), epoch (0 up), block (place of the block in the pass),
place (of the row in the block).

Defined results: a null source is a source of its own; null and empty texts
have no tokens and are used in no pass; repeated rows count each; ties in the
hash go by id and text hash; an empty table, or one without tokens, gives an
empty result; a single source gets weight 1; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotefuse.llm.common import saved

GRID = 64
ROUNDS = 5


def tokens(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"\S+")), F.lit(0)).cast("long")


def _measures(shares: DataFrame, alphas: list[float], budget_ratio: float) -> list[tuple[float, float, float]]:
    """(entropy, most passes over a source, sum of powers) for each exponent."""
    grid = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(a).alias("a")) for i, a in enumerate(alphas)]))
    p = F.col("share")
    rows = (shares.select("share", grid.alias("g")).groupBy("g.i").agg(
        F.sum(F.pow(p, F.col("g.a"))).alias("z"),
        F.sum(F.pow(p, F.col("g.a")) * F.col("g.a") * F.log(p)).alias("s"),
        F.max(F.pow(p, F.col("g.a") - 1)).alias("top")).collect())
    out = [(0.0, 0.0, 1.0)] * len(alphas)
    for r in rows:
        # with w = p**a / z: -sum w log w = log z - sum(p**a * a log p) / z
        out[r["i"]] = (math.log(r["z"]) - r["s"] / r["z"], r["top"] / r["z"] * budget_ratio, r["z"])
    return out


def solve(shares: DataFrame, sources: int, target_entropy: float, max_epochs: float, budget_ratio: float) -> float:
    """The exponent. ``target_entropy`` is a part of the way from the natural
    entropy (0) to that of equal weights (1)."""
    natural = _measures(shares, [1.0], budget_ratio)[0][0]
    target = natural + target_entropy * (math.log(max(1, sources)) - natural)
    eps = 1e-9

    def search(good) -> float | None:
        """Edge of the exponents that are good: (last good, first bad) cell is narrowed."""
        low, high = 0.0, 1.0
        for _ in range(ROUNDS):
            alphas = [low + (high - low) * i / GRID for i in range(GRID + 1)]
            ok = [good(m) for m in _measures(shares, alphas, budget_ratio)]
            if all(x == ok[0] for x in ok):
                if (low, high) != (0.0, 1.0):
                    break
                return high if ok[0] else None
            edge = next(i for i in range(GRID) if ok[i] != ok[i + 1])
            low, high = alphas[edge], alphas[edge + 1]
        return low if ok[0] else high

    by_entropy = search(lambda m: m[0] >= target - eps)  # true for small exponents
    alpha = 0.0 if by_entropy is None else by_entropy
    if _measures(shares, [alpha], budget_ratio)[0][1] > max_epochs + eps:
        by_limit = search(lambda m: m[1] <= max_epochs + eps)  # true for large exponents
        alpha = 1.0 if by_limit is None else max(alpha, by_limit)
    return round(alpha, 9)


def mix(docs: DataFrame, target_entropy: float = 0.5, max_epochs: float = 4.0, budget_tokens: int | None = None,
        block_rows: int = 1000, seed: int = 11) -> DataFrame:
    """The training order: a row for every use of a document."""
    rows = saved(docs.select("doc_id", "source", F.xxhash64("doc_id", "text", F.lit(seed)).alias("h"),
                             tokens(F.col("text")).alias("n_tokens")).where(F.col("n_tokens") > 0), "mix_rows")
    per = rows.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("rows"))
    per = saved(per, "mix_sources")
    whole = per.agg(F.sum("tokens").alias("t"), F.count("*").alias("k")).first()
    total = whole["t"] or 0
    id_type = rows.schema["doc_id"].dataType.simpleString()
    if not total:
        return docs.sparkSession.createDataFrame([], (
            f"doc_id {id_type}, source string, n_tokens long, weight double, epoch int, block long, place long"))
    budget = total if budget_tokens is None else budget_tokens
    shares = per.withColumn("share", F.col("tokens") / F.lit(float(total)))
    alpha = solve(shares, whole["k"], target_entropy, max_epochs, budget / total)
    z = _measures(shares, [alpha], budget / total)[0][2]
    weight = F.round(F.pow("share", F.lit(alpha)) / F.lit(z), 12)
    quota = F.least(F.floor(F.col("weight") * F.lit(float(budget))), F.floor(F.col("tokens") * F.lit(max_epochs)))
    plan = (shares.withColumn("weight", weight).withColumn("quota", quota.cast("long"))
            .withColumn("full", F.floor(F.col("quota") / F.col("tokens")).cast("long"))
            .withColumn("rest", F.col("quota") - F.col("full") * F.col("tokens"))
            .withColumn("blocks", F.ceil(F.col("rows") / F.lit(block_rows)).cast("long"))
            .select("source", "weight", "full", "rest", "blocks"))
    plan = saved(plan, "mix_plan").withColumnRenamed("source", "plan_source")
    dealt = rows.join(plan, F.col("source").eqNullSafe(F.col("plan_source"))).drop("plan_source")
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("h", F.lit(1)), F.col("blocks")))
    sums = dealt.groupBy("source", "part", "weight", "full", "rest", "blocks").agg(F.sum("n_tokens").alias("tokens"))
    # the passes of a block: every full one, and the last with what room is left before it
    passes = sums.withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("full"))))
    order = F.xxhash64("source", "part", "epoch", F.lit(seed))
    passes = placed(passes.withColumn("order", order)).select(
        F.col("source").alias("p_source"), F.col("part").alias("p_part"), "epoch", "block",
        F.when(F.col("epoch") < F.col("full"), F.col("tokens")).otherwise(F.col("rest") - F.col("before")).alias("room"))
    used = dealt.drop("full", "rest", "blocks").join(
        passes.where(F.col("room") > 0), F.col("source").eqNullSafe(F.col("p_source")) & (F.col("part") == F.col("p_part")))
    w = Window.partitionBy("source", "part", "epoch").orderBy(F.xxhash64("h", "epoch"), "doc_id", "h")
    taken = used.withColumn("sofar", F.sum("n_tokens").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    taken = taken.withColumn("place", F.row_number().over(w).cast("long") - 1).where(F.col("sofar") <= F.col("room"))
    return taken.select("doc_id", "source", "n_tokens", "weight", F.col("epoch").cast("int").alias("epoch"), "block", "place")


def placed(passes: DataFrame, run: int = 4096) -> DataFrame:
    """Adds to each (source, epoch, part) its place in the pass and the tokens
    before it. The blocks of a large source are ranked in two levels (runs of
    the hash order, then inside a run), so no task holds them all."""
    span = F.greatest(F.lit(1).cast("long"), F.ceil(F.col("blocks") / F.lit(run)).cast("long"))
    wide = passes.withColumn("run", F.floor((F.col("order") / F.lit(2.0**64) + 0.5) * span).cast("long"))
    by_run = wide.groupBy("source", "epoch", "run").agg(F.sum("tokens").alias("t"), F.count("*").alias("n"))
    over = Window.partitionBy("source", "epoch").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    base = by_run.select(F.col("source").alias("r_source"), F.col("epoch").alias("r_epoch"), F.col("run").alias("r_run"),
                         F.coalesce(F.sum("t").over(over), F.lit(0)).alias("t0"), F.coalesce(F.sum("n").over(over), F.lit(0)).alias("n0"))
    inside = Window.partitionBy("source", "epoch", "run").orderBy("order", "part")
    before = F.coalesce(F.sum("tokens").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    wide = wide.withColumn("t1", before).withColumn("n1", F.row_number().over(inside) - 1)
    return wide.join(base, F.col("source").eqNullSafe(F.col("r_source")) & (F.col("epoch") == F.col("r_epoch"))
                     & (F.col("run") == F.col("r_run"))).withColumn("before", F.col("t0") + F.col("t1")).withColumn(
        "block", (F.col("n0") + F.col("n1")).cast("long"))
