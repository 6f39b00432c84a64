"""Data-quality checks (A10-A16), each layer in ONE aggregation pass.

Every rule of a section becomes a conditional count inside a single
``agg``; an ``explode`` of per-rule structs turns the one wide row (or one row per file for
Bronze) into the long report ``(couche, table_name, section, regle, nb,
pct, statut)``. Grouping by file is one job, not one job per file.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotefuse import constants as K
from quotefuse.functions.scalar import is_missing, now_utc, run_text, ts_lit
from quotefuse.functions.scalar import round_half_away as rnd

SECTIONS = ("completude", "coherence", "validite")
REPORT_COLUMNS = ("couche", "table_name", "section", "regle", "nb", "pct", "statut")


def _sql_text(v: str) -> str:
    """A SQL string literal (backslash and quote escaped)."""
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _num(c: str) -> Column:
    x = F.col(c)
    return x.isNotNull() & ~F.isnan(x)


def _cnt(cond: Column) -> Column:
    return F.count_if(F.coalesce(cond, F.lit(False)))


def _distinct_with_null(c: str) -> Column:
    """COUNT(DISTINCT c) counting NULL as one more value (pandas duplicated())."""
    return F.count_distinct(F.col(c)) + F.coalesce(F.max(F.col(c).isNull().cast("int")), F.lit(0))


def completeness_rules(df: DataFrame, skip: Iterable[str] = ()) -> list[tuple[str, Column, str]]:
    dtypes = dict(df.dtypes)
    return [(c, _cnt(is_missing(c, dtypes[c])), "pct") for c in df.columns if c not in skip]


def coherence_rules(df: DataFrame) -> list[tuple[str, Column, str]]:
    cols, out = set(df.columns), []
    h, b, p = F.col("prix_haut"), F.col("prix_bas"), F.col("prix")
    if {"prix_haut", "prix_bas"} <= cols:
        out.append((K.RULE_HIGH_GE_LOW, _cnt(_num("prix_haut") & _num("prix_bas") & (h < b)), K.DQ_FAIL))
    if {"prix", "prix_haut", "prix_bas"} <= cols:
        ok = _num("prix") & _num("prix_haut") & _num("prix_bas")
        out.append((K.RULE_PRICE_IN_RANGE, _cnt(ok & ((p > h) | (p < b))), K.DQ_WARN))
    if "variation_pct" in cols:
        out.append((K.RULE_VAR_LE_50,
                    _cnt(_num("variation_pct") & (F.abs("variation_pct") > K.COHERENCE_MAX_ABS_VAR)),
                    K.DQ_WARN))
    if "volume" in cols:
        out.append((K.RULE_VOLUME_POS, _cnt(_num("volume") & (F.col("volume") < 0)), K.DQ_FAIL))
    return out


def validity_rules(df: DataFrame) -> list[tuple[str, Column, str]]:
    cols, out = set(df.columns), []
    if "prix" in cols:
        out.append((K.RULE_PRICE_POS, _cnt(_num("prix") & (F.col("prix") <= 0)), K.DQ_FAIL))
    if "ticker" in cols:
        t = F.col("ticker")
        out.append((K.RULE_TICKER_SET, _cnt(t.isNull() | (t == "")), K.DQ_FAIL))
    if "devise" in cols:
        d = F.col("devise")
        out.append((K.RULE_CURRENCY, _cnt(d.isNotNull() & ~d.isin(*K.VALID_CURRENCIES)), K.DQ_WARN))
    if "categorie" in cols:
        c = F.col("categorie")
        out.append((K.RULE_CATEGORY, _cnt(c.isNotNull() & ~c.isin(*K.CATEGORIES)), K.DQ_WARN))
    if "ticker" in cols:
        out.append((K.RULE_NO_DUP, F.count(F.lit(1)) - _distinct_with_null("ticker"), K.DQ_WARN))
    return out


def report(df: DataFrame, name: str | None, layer: str,
           sections: Sequence[str] = SECTIONS, by: str | None = None, with_total: bool = False) -> DataFrame:
    """Long quality report of one layer in a single aggregation.

    ``by`` (e.g. 'fichier_source') groups the checks; the group value is the
    table name then, as for per-file Bronze checks. ``with_total`` adds the number of
    rows to every line, so that counts need no pass of their own.
    """
    data = df.drop(by) if by else df
    rules: list[tuple[str, str, Column, str]] = []
    if "completude" in sections:
        rules += [("completude", *r) for r in completeness_rules(data)]
    if "coherence" in sections:
        rules += [("coherence", *r) for r in coherence_rules(data)]
    if "validite" in sections:
        rules += [("validite", *r) for r in validity_rules(data)]
    names = [f"_r{i}" for i in range(len(rules))]
    aggs = [F.count(F.lit(1)).alias("_total")] + [
        r[2].cast("long").alias(n) for r, n in zip(rules, names)]
    if by:
        wide = df.groupBy(F.col(by).alias("_tbl")).agg(*aggs)
    else:  # a global aggregate: one row even for an empty table
        wide = df.agg(*aggs).select(F.lit(name).alias("_tbl"), "*")
    # wide -> long: one struct per rule, exploded (no per-row metadata lookup);
    # written as one SQL expression: one round trip instead of ~9 per rule
    items = F.expr("array(" + ", ".join(
        f"named_struct('section', {_sql_text(r[0])}, 'regle', {_sql_text(r[1])}, "
        f"'nb', {n}, 'lvl', {_sql_text(r[3])})" for r, n in zip(rules, names)) + ")")
    long = wide.select("_tbl", "_total", F.explode(items).alias("_r")).select(
        "_tbl", "_total", "_r.*")
    section, regle, level = F.col("section"), F.col("regle"), F.col("lvl")
    nb, total = F.col("nb"), F.col("_total")
    pct = F.when(level == "pct", F.when(total > 0, rnd(nb / total * F.lit(100.0), 2))
                 .otherwise(F.lit(0.0)))
    statut = (F.when(level == "pct",
                     F.when(pct == 0, K.DQ_OK).when(pct < K.COMPLETENESS_WARN_PCT, K.DQ_WARN)
                     .otherwise(K.DQ_FAIL))
              .otherwise(F.when(nb == 0, K.DQ_OK).otherwise(level)))
    return long.select(F.lit(layer).alias("couche"), F.col("_tbl").alias("table_name"),
                       section.alias("section"), regle.alias("regle"), nb.alias("nb"),
                       pct.alias("pct"), statut.alias("statut"), *([F.col("_total").alias("nb_lignes")] if with_total else []))


def counts_of(long_report: DataFrame) -> DataFrame:
    """nb_lignes per table (or file) of a report made with ``with_total``."""
    return long_report.groupBy("couche", "table_name").agg(F.first("nb_lignes").alias("nb_lignes"))


def duplicates(df: DataFrame, column: str = "ticker") -> DataFrame:
    """rows - distinct values, NULL counted as one value."""
    return df.agg(F.count(F.lit(1)).alias("nb_lignes"),
                  _distinct_with_null(column).alias("nb_distincts")).select(
        "nb_lignes", "nb_distincts", (F.col("nb_lignes") - F.col("nb_distincts")).alias("nb_doublons"))


def global_status(long_report: DataFrame, layers: Sequence[str] = ("silver",)) -> DataFrame:
    """FAIL if any FAIL, else WARN if any WARN, else OK, over ``layers``.

    The default counts Silver only, as the original summary effectively does.
    """
    r = long_report.where(F.col("couche").isin(*layers)) if layers != "all" else long_report
    a = r.agg(F.count_if(F.col("statut") == K.DQ_FAIL).alias("total_fail"),
              F.count_if(F.col("statut") == K.DQ_WARN).alias("total_warn"))
    return a.select("total_fail", "total_warn",
                    F.when(F.col("total_fail") > 0, K.DQ_FAIL)
                    .when(F.col("total_warn") > 0, K.DQ_WARN).otherwise(K.DQ_OK)
                    .alias("statut_global"))


def to_json_document(long_report: DataFrame, counts: DataFrame | None = None,
                     status: DataFrame | None = None, run_ts=None) -> DataFrame:
    """Nested JSON of the report (K11): one line per (layer, table) holding that
    table's rows and checks, so each nested list is bounded by the number of
    rules and the document is written by many tasks, not gathered into one row.
    With ``status`` a last line holds the report's date and summary."""
    checks = F.struct("section", "regle", "nb", "pct", "statut")
    doc = long_report.groupBy("couche", "table_name").agg(F.sort_array(F.collect_list(checks)).alias("controles"))
    if counts is not None:
        c = counts.select(F.col("couche").alias("_c"), F.col("table_name").alias("_t"), "nb_lignes")
        doc = doc.join(c, F.col("couche").eqNullSafe(F.col("_c")) & F.col("table_name").eqNullSafe(F.col("_t")), "left").drop("_c", "_t")
    cols = [c for c in ("couche", "table_name", "nb_lignes", "controles") if c in doc.columns]
    out = doc.select(F.to_json(F.struct(*cols)).alias("rapport"))
    if status is not None:
        stamp = run_text(ts_lit(run_ts) if run_ts is not None else now_utc())
        out = out.unionByName(status.select(F.to_json(F.struct(
            stamp.alias("date_rapport"), F.struct("total_fail", "total_warn", "statut_global").alias("resume"))).alias("rapport")))
    return out


def _dw_rules() -> list[tuple[str, Column, str]]:
    t, v = F.col("ticker"), F.col("variation_pct")
    return [(K.DW_RULE_PRICE, _cnt(F.col("prix") <= 0), K.DQ_FAIL),
            (K.DW_RULE_TICKER, _cnt(t.isNull() | (t == "")), K.DQ_FAIL),
            (K.DW_RULE_VAR, _cnt(F.abs(v) > K.DW_MAX_ABS_VAR), K.DQ_WARN)]


def history_checks(spark, root: str, state: str | None = None) -> DataFrame:
    """The warehouse rules counted over the history, a row: with ``state`` each run is
    counted once and its counts are kept there, else the whole table is read."""
    from quotefuse.plans import ledger, run_state
    from quotefuse.plans.warehouse import RUN_COL, read_runs, read_table
    names = [f"_r{i}" for i in range(len(_dw_rules()))]
    aggs = [r[1].cast("long").alias(n) for r, n in zip(_dw_rules(), names)]
    if state is None:
        return read_table(spark, root, K.HISTORY_TABLE).agg(*aggs)
    runs = {e.run_id: e.load_id for e in ledger.live(spark, root, K.HISTORY_TABLE)}
    per_run, _ = run_state.update(spark, state, "historique", runs, lambda some: read_runs(
        spark, root, K.HISTORY_TABLE, some).groupBy(RUN_COL).agg(*aggs))
    return per_run.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names])


def warehouse_checks(spark, root: str, tables: Sequence[str] = K.DW_TABLES, state: str | None = None) -> DataFrame:
    """Warehouse checks (A14): rows per table, non-positive prices, empty
    tickers, |variation| > 100, empty tables (with their names), and an error
    row for a table that does not exist. Row counts come from the ledger; the
    history is read by one aggregate, with ``state`` its new runs only."""
    from quotefuse.plans import ledger
    from quotefuse.plans.warehouse import exists
    rules = _dw_rules()
    names = [f"_r{i}" for i in range(len(rules))]
    absent = [x for x in tables if not exists(spark, f"{root}/{x}")]
    rows = {x: 0 for x in tables}
    for e in ledger.live(spark, root):
        if e.table_name in rows:
            rows[e.table_name] += e.nb_lignes
    sizes = F.array(*[F.struct(F.lit(i).alias("pos"), F.lit(x).alias("name"), F.lit(x not in absent).alias("there"),
                               F.lit(rows[x]).cast("long").alias("nb")) for i, x in enumerate(tables)])
    row = history_checks(spark, root, state).select(F.transform(sizes, lambda x: F.struct(
        x["pos"].alias("pos"), x["name"].alias("name"), x["there"].alias("there"), x["nb"].alias("nb"),
        *[F.when(x["name"] == K.HISTORY_TABLE, F.col(n)).alias(n) for n in names])).alias("s"))
    there = F.filter("s", lambda x: x["there"])

    def item(table, section, regle, nb, statut):
        return F.struct(table.cast("string").alias("table_name"), section.alias("section"), regle.alias("regle"),
                        nb.cast("long").alias("nb"), statut.cast("string").alias("statut"))

    null = F.lit(None)
    per_table = F.transform(there, lambda x: item(x["name"], F.lit("nb_lignes_par_table"), x["name"], x["nb"], null))
    gone = F.transform(F.filter("s", lambda x: ~x["there"]), lambda x: item(
        x["name"], F.lit(K.DW_ERROR), x["name"], null, F.lit(K.DQ_FAIL)))
    hollow = F.transform(F.filter(there, lambda x: x["nb"] == 0), lambda x: x["name"])
    empty = F.array(item(F.nullif(F.array_join(hollow, ","), F.lit("")), F.lit(K.DW_RULE_EMPTY), F.lit(K.DW_RULE_EMPTY),
                         F.size(hollow), F.when(F.size(hollow) == 0, K.DQ_OK).otherwise(K.DQ_WARN)))
    history = F.filter(there, lambda x: x["name"] == K.HISTORY_TABLE)

    def checks(x):
        return F.array(*[item(F.lit(K.HISTORY_TABLE), F.lit(r[0]), F.lit(r[0]), x[n],
                              F.when(x[n] == 0, K.DQ_OK).otherwise(r[2])) for r, n in zip(rules, names)])

    every = F.concat(per_table, gone, empty, F.flatten(F.transform(history, checks)))
    return row.select(F.explode(every).alias("r")).select(
        F.lit("dw").alias("couche"), "r.table_name", "r.section", "r.regle", "r.nb",
        F.lit(None).cast("double").alias("pct"), "r.statut")
