"""Hand-made edge cases (FIXTURES.md §3)."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from quotefuse import constants as K
from quotefuse.functions import scalar
from quotefuse.operators import clean, fuse, kpis, normalize, quality
from quotefuse.schemas import BRONZE_COLUMNS
from quotefuse.sources import payloads
from quotefuse.streaming import ticks

BRONZE_DDL = ", ".join(f"{c} string" for c in BRONZE_COLUMNS)


def bronze(spark, rows):
    full = [{c: r.get(c) for c in BRONZE_COLUMNS} for r in rows]
    return spark.createDataFrame([tuple(r[c] for c in BRONZE_COLUMNS) for r in full], BRONZE_DDL)


def test_clean_filter_edges(spark):
    rows = [dict(ticker=f"X{i}", prix=p, variation_pct=v, statut=s)
            for i, (p, v, s) in enumerate([
                ("1", "-100", "succes"), ("1", "100", None), ("1", "100.01", "succes"),
                ("0", "1", "succes"), ("-1", "1", "succes"), (None, "1", "succes"),
                ("NaN", "1", "succes"), ("1", "1", "erreur"), ("1", "1", ""), ("1", None, "succes")])]
    out = clean.valid(clean.cast_types(bronze(spark, rows))).select("ticker").collect()
    assert sorted(r.ticker for r in out) == ["X0", "X1"]


def test_currency_rule_order(spark):
    rows = [dict(ticker="A.PA", devise=""), dict(ticker="B.PA", devise=None),
            dict(ticker="C.PA", devise="USD"), dict(ticker="D", devise="GBP")]
    out = {r.ticker: r.devise for r in clean.currency(bronze(spark, rows)).collect()}
    assert out == {"A.PA": "USD", "B.PA": "USD", "C.PA": "EUR", "D": "GBP"}


def test_ticker_map_and_eur(spark):
    df = spark.createDataFrame([("1rPBN", "USD"), ("X", "USD"), (None, "GBP")], "ticker string, devise string")
    out = normalize.tickers(df).collect()
    assert [(r.ticker, r.devise) for r in out] == [("BN.PA", "EUR"), ("X", "USD"), (None, "GBP")]


def test_alias_case_sensitive_and_coalesce(spark):
    df = spark.createDataFrame([("1", "2", "3", "p")], "price string, current_price string, P string, p string")
    out = normalize.columns(df)
    assert out.columns == ["prix", "variation_pct", "p"]
    r = out.collect()[0]
    assert (r.prix, r.variation_pct, r.p) == ("1", "3", "p")


def _fuse_rows(spark, rows):
    df = bronze(spark, rows).withColumn("ord", F.monotonically_increasing_id())
    return {(r.categorie, r.ticker): r for r in fuse.fuse(df, "ord").collect()}


def test_crypto_fusion(spark):
    rows = [
        dict(ticker="A", categorie="crypto", source="coingecko", capitalisation="9", prix="1"),
        dict(ticker="A", categorie="crypto", source="binance", capitalisation=None, prix="2"),
        dict(ticker="B", categorie="crypto", source="binance", capitalisation="5", prix="3"),
        dict(ticker="B", categorie="crypto", source="coingecko", capitalisation=None, prix="4"),
        dict(ticker="C", categorie="crypto", source="binance", prix="5"),
        dict(ticker="D", categorie="crypto", source="coingecko", prix="6"),
        dict(ticker="E", categorie="crypto", source="yahoo_finance", prix="7"),
    ]
    out = _fuse_rows(spark, rows)
    a, b, c = out[("crypto", "A")], out[("crypto", "B")], out[("crypto", "C")]
    assert (a.prix, a.capitalisation, a.source) == ("2", "9", K.LABEL_CRYPTO_FUSED)
    assert (b.prix, b.capitalisation) == ("3", "5")          # NULL cap keeps binance's
    assert c.source == K.LABEL_CRYPTO_FUSED                    # label even alone
    assert out[("crypto", "D")].source == "coingecko"
    assert out[("crypto", "E")].source == "yahoo_finance"


def test_fr_fusion_and_error_winner(spark):
    rows = [
        dict(ticker="A.PA", categorie="action_fr", source="boursorama", volume="50", prix="1"),
        dict(ticker="A.PA", categorie="action_fr", source="yahoo_finance", volume=None, prix="2"),
        dict(ticker="B.PA", categorie="action_fr", source="yahoo_finance", volume="7", prix="3"),
        dict(ticker="B.PA", categorie="action_fr", source="boursorama", volume="8", prix="4"),
        dict(ticker="C.PA", categorie="action_fr", source="yahoo_finance", statut="erreur"),
        dict(ticker="C.PA", categorie="action_fr", source="boursorama", prix="5", variation_pct="1"),
    ]
    out = _fuse_rows(spark, rows)
    assert (out[("action_fr", "A.PA")].volume, out[("action_fr", "A.PA")].prix) == ("50", "2")
    assert out[("action_fr", "B.PA")].volume == "7"
    assert out[("action_fr", "C.PA")].statut == "erreur"       # error row wins ...
    silver = clean.clean(fuse.fuse(bronze(spark, rows).withColumn(
        "ord", F.monotonically_increasing_id()), "ord"))
    assert "C.PA" not in {r.ticker for r in silver.collect()}  # ... and the ticker is lost
    kept = fuse.fuse(bronze(spark, rows).withColumn("ord", F.monotonically_increasing_id()),
                     "ord", drop_errors_first=True)
    assert {r.ticker: r.source for r in kept.collect()}["C.PA"] == "boursorama"


def test_other_categories(spark):
    rows = [dict(ticker="A", categorie="fonds", prix="1"), dict(ticker="A", categorie="etf", prix="2"),
            dict(ticker="A", categorie="action", prix="3"), dict(ticker="A", categorie="indice", prix="4"),
            dict(ticker="B", categorie=None, prix="5")]
    out = fuse.fuse(bronze(spark, rows).withColumn("ord", F.monotonically_increasing_id()), "ord")
    got = sorted((r.categorie or "", r.ticker, r.prix) for r in out.collect())
    assert got == [("", "B", "5"), ("action", "A", "3"), ("fonds", "A", "1"), ("indice", "A", "4")]


def silver_rows(spark, vals):
    schema = "ticker string, nom string, prix double, variation_pct double, devise string, categorie string, source string, volume double, capitalisation double"
    return spark.createDataFrame([(f"T{i}", "n", 1.0, v, "USD", "crypto", "s", 1.0, 10.0 * i)
                                  for i, v in enumerate(vals)], schema)


def test_movers_overlap_and_labels(spark):
    out = kpis.top_movers(silver_rows(spark, [-3.0, -1.0, -2.0]), n=5).collect()
    assert len(out) == 6
    assert {r.type_mouvement for r in out if r.variation_pct == -1.0} == {"hausse", "baisse"}


def test_alert_threshold_inclusive(spark):
    out = kpis.alerts(silver_rows(spark, [2.0, -2.0, 1.9999, None, 5.0])).collect()
    assert sorted((r.variation_pct, r.niveau_alerte) for r in out) == [
        (-2.0, "forte baisse"), (2.0, "forte hausse"), (5.0, "forte hausse")]
    assert kpis.alerts(silver_rows(spark, [2.0, 3.0]), threshold=3.0).count() == 1


def test_snapshot_empty_and_even_median(spark):
    empty = kpis.snapshot(silver_rows(spark, [None]), dt.datetime(2024, 1, 1)).collect()
    assert len(empty) == 1 and empty[0].total_actifs == 0 and empty[0].actifs_en_hausse is None
    assert empty[0].variation_mediane is None and empty[0].pct_marche_hausse is None
    r = kpis.snapshot(silver_rows(spark, [1.0, 2.0, 4.0, 10.0]), dt.datetime(2024, 1, 1)).collect()[0]
    assert r.variation_mediane == 3.0 and r.pct_marche_hausse == 100.0


def test_completeness_thresholds(spark):
    def pct_status(n_null, n):
        df = spark.createDataFrame([(None if i < n_null else 1.0,) for i in range(n)], "x double")
        r = quality.report(df, "t", "silver", ["completude"]).collect()[0]
        return r.pct, r.statut
    assert pct_status(0, 0) == (0.0, "OK")
    assert pct_status(1999, 10000) == (19.99, "WARN")
    assert pct_status(2, 10) == (20.0, "FAIL")
    assert pct_status(1, 100000) == (0.0, "OK")       # rounded pct decides (kept quirk)


def test_duplicates_count_null_once(spark):
    df = spark.createDataFrame([(None,), (None,), ("A",), ("A",), ("B",)], "ticker string")
    assert quality.duplicates(df).collect()[0].nb_doublons == 2


def test_scalars(spark):
    df = spark.createDataFrame([("12.9", 110.0, 100.0), ("-12.9", 1.0, 0.0), ("NaN", None, 1.0),
                                ("inf", 1.0, None), ("x", 2.0, 1.0)], "s string, p double, q double")
    out = df.select(scalar.to_long("s").alias("i"), scalar.pct_change("p", "q").alias("v"),
                    scalar.round_half_away(F.lit(1.005), 2).alias("r")).collect()
    assert [r.i for r in out] == [12, -12, None, None, None]
    assert [r.v for r in out] == [10.0, None, None, None, 100.0]
    assert out[0].r == 1.0


def test_tick_parse_edges(spark):
    msgs = ['{"stream":"s","data":{"e":"24hrTicker","s":"BTCUSDT","c":"1","P":"2.5","v":"3","h":"4","l":"0.5","o":"1"}}',
            '{"e":"24hrTicker","s":"ETHUSDT","c":"1","P":"-2","v":"3","h":"4","l":"0.5","o":"1"}',
            '{"e":"trade","s":"X","c":"1","P":"1","v":"1","h":"1","l":"1","o":"1"}',
            'junk{', '{"e":"24hrTicker","s":"Y","c":"1","v":"3","h":"4","l":"0.5","o":"1"}',
            '{"e":"24hrTicker","s":"Z","c":"abc","P":"1","v":"3","h":"4","l":"0.5","o":"1"}']
    df = spark.createDataFrame([(m,) for m in msgs], "value string")
    t = ticks.parse_ticks(df, ts=F.lit(dt.datetime(2024, 1, 2)))
    assert sorted(r.ticker for r in t.collect()) == ["BTCUSDT", "ETHUSDT"]
    al = {r.ticker: r.direction for r in ticks.alerts(t).collect()}
    assert al == {"BTCUSDT": "HAUSSE", "ETHUSDT": "BAISSE"}


def test_boursorama_payload_cases(spark):
    full = '{"d":{"Name":"DANONE","qd":{"c":60.0,"o":59,"h":61,"l":58,"v":1000.7},"qv":{"c":50.0}}}'
    df = spark.createDataFrame([("1rPBN", full), ("1rPX", "[]"), ("1rPY", '{"a":1}'),
                                ("1rPZ", '{"d":{"Name":"Z"}}')], "symbole string, payload string")
    out = {r.ticker: r for r in payloads.parse_boursorama(df).collect()}
    assert (out["1rPBN"].variation_pct, out["1rPBN"].volume, out["1rPBN"].statut) == (20.0, 1000, "succes")
    assert out["1rPX"].erreur_msg == K.MSG_BOURSO_EMPTY and out["1rPX"].categorie is None
    assert out["1rPY"].erreur_msg.startswith(K.MSG_BOURSO_NO_D + " : {")
    assert out["1rPZ"].erreur_msg == K.MSG_BOURSO_NO_QD


def test_binance_symbol_filter(spark):
    df = spark.createDataFrame([('{"symbol":"BTCUSDT","lastPrice":"1.00005","count":7}',),
                                ('{"symbol":"FOOUSDT","lastPrice":"2"}',)], "payload string")
    items = payloads.items_from_text(df, "payload", payloads.BINANCE_ITEM)
    out = payloads.parse_binance(items, K.COINS_BINANCE).collect()
    assert (out[0].prix, out[0].nb_trades_24h) == (1.0001, 7)
    assert [r.ticker for r in out] == ["BTC-USD"]


def test_fixed_timestamps_ignore_session_time_zone(spark):
    from quotefuse.functions.scalar import run_text, ts_lit
    ts = dt.datetime(2024, 1, 31, 12, 0, 0)
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for tz in ("UTC", "Asia/Tokyo", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            r = spark.range(1).select(run_text(ts_lit(ts)).alias("t"), ts_lit(ts).alias("n")).collect()[0]
            assert r.t == "2024-01-31 12:00:00" and r.n == ts
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_stamps_arrow_and_successes(spark):
    import datetime as dt
    from quotefuse.functions import scalar
    from quotefuse.operators import collect
    from quotefuse.streaming import ticks
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")  # 02:30 does not exist there on this day
        t = scalar.ts_lit(dt.datetime(2024, 3, 10, 2, 30, 5, 70))
        r = spark.range(1).select(scalar.run_stamp(t).alias("a"), scalar.run_text(t).alias("b"), scalar.day_stamp(t).alias("c"),
                                  scalar.iso_text(t).alias("d"), scalar.day_path(t).alias("e")).collect()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert tuple(r) == ("20240310_023005", "2024-03-10 02:30:05", "20240310", "2024-03-10T02:30:05.000070", "2024/03/10")
    up = ticks.arrow(spark.createDataFrame([(1.0,), (0.0,), (-1.0,), (None,)], "variation_pct double")).collect()
    assert [x.fleche for x in up] == [K.ARROW_UP, K.ARROW_UP, K.ARROW_DOWN, K.ARROW_DOWN]
    rows = spark.createDataFrame([("a", "succes"), ("b", "erreur"), ("c", None)], "ticker string, statut string")
    assert [x.ticker for x in collect.successes(rows).collect()] == ["a"]
