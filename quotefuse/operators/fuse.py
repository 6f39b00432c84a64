"""Source fusion per instrument: one aggregation, one shuffle.

Rows are grouped by (cat_key, ticker), where cat_key is the category when it
is one of the four known ones and NULL otherwise (all other categories,
including NULL, fuse together). For every group the first row overall and
the first row of each preferred source are picked with ``min_by(row, ord)``;
the winner and its patched fields are then chosen per category:

* crypto:    first binance row, market cap from the first coingecko row when
             that cap is set, source 'binance+coingecko' (even without a
             coingecko row); else first coingecko row, source 'coingecko';
             else the first row.
* action_fr: first yahoo row, volume from the first boursorama row only when
             yahoo's is NULL, source 'yahoo+boursorama'; else first
             boursorama row, source 'boursorama'; else the first row.
* action, indice: first yahoo row, else the first row, source unchanged.
* others:    the first row.

``min_by`` is partially aggregated before the shuffle, so every map task
sends at most one candidate per (group, source) — a hot ticker holding a
third of all rows costs no more shuffle than a cold one. Error rows take
part (an error row of the preferred source wins and the ticker is later
cleaned away); ``drop_errors_first=True`` removes them before fusing.

The aggregate is a state that can be stored and merged with that of other rows
(``partial``, ``merge``, ``resolve``): ``plans/fusion_state.py`` keeps one over
all collected runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotefuse import constants as K

ORD = "_qf_ord"
_ROW = "_qf_row"


def _first(cond: Column | None) -> Column:
    order = F.col(ORD) if cond is None else F.when(cond, F.col(ORD))
    return F.min_by(F.col(_ROW), order)


def _key() -> Column:
    return F.when(F.col("categorie").isin(*K.CATEGORIES), F.col("categorie"))


ROLES = {"any": None, "bn": K.SRC_BINANCE, "cg": K.SRC_COINGECKO, "yh": K.SRC_YAHOO, "bo": K.SRC_BOURSORAMA}
STATE_KEY = ("_qf_cat", "_qf_ticker")


def partial(df: DataFrame, ord_col: str | Column, by: tuple[str, ...] = ()) -> DataFrame:
    """The mergeable state of a fusion: per (category, ticker) the first row overall and of
    each source, each with its order value inside. ``by`` keeps states apart (a run each)."""
    o = F.col(ord_col) if isinstance(ord_col, str) else ord_col
    cols = [c for c in df.columns if c != ORD and c not in by]
    base = df.select(*by, *cols, o.alias(ORD))
    payload = F.struct(*[F.col(c) for c in cols + [ORD]])
    src = F.col("source")
    keyed = base.select(*by, _key().alias(STATE_KEY[0]), F.col("ticker").alias(STATE_KEY[1]), src, F.col(ORD), payload.alias(_ROW))
    return keyed.groupBy(*by, *STATE_KEY).agg(
        *[_first(None if name is None else src == name).alias(role) for role, name in ROLES.items()])


def merge(states: DataFrame) -> DataFrame:
    """One state from the rows of several: the candidate of the least order value stays."""
    return states.groupBy(*STATE_KEY).agg(*[F.min_by(F.col(r), F.col(r)[ORD]).alias(r) for r in ROLES])


def resolve(state: DataFrame, keep_order: bool = False) -> DataFrame:
    """The fused row of every group of a state."""
    cols = [f.name for f in state.schema["any"].dataType.fields if f.name != ORD]
    cat = F.col("_qf_cat")
    crypto, fr = cat == "crypto", cat == "action_fr"
    pref = cat.isin("action", "indice")
    bn, cg, yh, bo, anyr = (F.col(x) for x in ("bn", "cg", "yh", "bo", "any"))
    winner = (F.when(crypto, F.coalesce(bn, cg, anyr))
              .when(fr, F.coalesce(yh, bo, anyr))
              .when(pref, F.coalesce(yh, anyr))
              .otherwise(anyr))
    out = []
    for c in cols:
        w = winner[c]
        if c == "capitalisation":
            w = F.when(crypto & bn.isNotNull(), F.coalesce(cg[c], bn[c])).otherwise(w)
        elif c == "volume":
            w = F.when(fr & yh.isNotNull(), F.coalesce(yh[c], bo[c])).otherwise(w)
        elif c == "source":
            w = (F.when(crypto & bn.isNotNull(), F.lit(K.LABEL_CRYPTO_FUSED))
                 .when(crypto & cg.isNotNull(), F.lit(K.SRC_COINGECKO))
                 .when(fr & yh.isNotNull(), F.lit(K.LABEL_FR_FUSED))
                 .when(fr & bo.isNotNull(), F.lit(K.SRC_BOURSORAMA))
                 .otherwise(w))
        out.append(w.alias(c))
    if keep_order:
        out.append(winner[ORD].alias(ORD))
    return state.select(*out)


def without_errors(df: DataFrame) -> DataFrame:
    return df.where(F.col("statut").isNull() | (F.col("statut") != K.STATUS_ERROR)) if "statut" in df.columns else df


def fuse(df: DataFrame, ord_col: str | Column, drop_errors_first: bool = False,
         keep_order: bool = False, families: tuple[str | None, ...] | None = None) -> DataFrame:
    """Fuse competing sources; ``ord_col`` must be non-NULL and unique.

    With ``keep_order`` the winning row's order value is kept as ``_qf_ord``.
    ``families`` asks for some categories only (None: the unknown ones); a row's
    category is its group's, so the test is made before the aggregation.
    """
    if drop_errors_first:
        df = without_errors(df)
    if families is not None:
        df = in_families(df, families)
    if "categorie" not in df.columns or "source" not in df.columns:
        return dedup_first(df, F.col(ord_col) if isinstance(ord_col, str) else ord_col, keep_order)
    return resolve(partial(df, ord_col), keep_order)


def dedup_first(df: DataFrame, ord_col: str | Column, keep_order: bool = False) -> DataFrame:
    """First row per ticker (J5): partial ``min_by`` per ticker, one shuffle."""
    o = F.col(ord_col) if isinstance(ord_col, str) else ord_col
    cols = [c for c in df.columns if c != ORD]
    base = df.select(*cols, o.alias(ORD))
    g = (base.groupBy(F.col("ticker").alias("_qf_ticker"))
         .agg(F.min_by(F.struct(*[F.col(c) for c in cols + [ORD]]), F.col(ORD)).alias("r")))
    sel = [F.col("r")[c].alias(c) for c in cols]
    if keep_order:
        sel.append(F.col("r")[ORD].alias(ORD))
    return g.select(*sel)


def in_families(df: DataFrame, families: tuple[str | None, ...]) -> DataFrame:
    """Rows of some fusion families: known categories, or None for all others."""
    c = F.col("categorie")
    known = [f for f in families if f is not None]
    test = F.coalesce(c.isin(*known), F.lit(False)) if known else F.lit(False)
    return df.where(test | c.isNull() | ~c.isin(*K.CATEGORIES)) if None in families else df.where(c.isin(*known))
