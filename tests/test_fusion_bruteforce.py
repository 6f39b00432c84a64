"""fuse() against a brute-force per-group evaluation of the fusion rules."""
from hypothesis import given, settings
from hypothesis import strategies as st

from quotefuse import constants as K
from quotefuse.operators import fuse

KNOWN = ("crypto", "action_fr", "action", "indice")
row_st = st.fixed_dictionaries({
    "ticker": st.sampled_from(["A", "B", "C", None]),
    "categorie": st.sampled_from(["crypto", "action_fr", "action", "indice", "fonds", None]),
    "source": st.sampled_from(["binance", "coingecko", "yahoo_finance", "boursorama", "x", None]),
    "volume": st.one_of(st.none(), st.floats(0, 100, allow_nan=False)),
    "capitalisation": st.one_of(st.none(), st.floats(0, 100, allow_nan=False)),
    "statut": st.sampled_from(["succes", "erreur", None]),
})


def brute(rows):
    groups = {}
    for r in sorted(rows, key=lambda r: r["ord"]):
        cat = r["categorie"] if r["categorie"] in KNOWN else None
        groups.setdefault((cat, r["ticker"]), []).append(r)
    out = set()
    for (cat, _), rs in groups.items():
        first = lambda s: next((r for r in rs if r["source"] == s), None)
        bn, cg, yh, bo = first("binance"), first("coingecko"), first("yahoo_finance"), first("boursorama")
        base, src = rs[0], rs[0]["source"]
        vol, cap = base["volume"], base["capitalisation"]
        if cat == "crypto" and bn:
            base, src, vol = bn, K.LABEL_CRYPTO_FUSED, bn["volume"]
            cap = cg["capitalisation"] if cg and cg["capitalisation"] is not None else bn["capitalisation"]
        elif cat == "crypto" and cg:
            base, src, vol, cap = cg, "coingecko", cg["volume"], cg["capitalisation"]
        elif cat == "action_fr" and yh:
            base, src, cap = yh, K.LABEL_FR_FUSED, yh["capitalisation"]
            vol = yh["volume"] if yh["volume"] is not None else (bo["volume"] if bo else None)
        elif cat == "action_fr" and bo:
            base, src, vol, cap = bo, "boursorama", bo["volume"], bo["capitalisation"]
        elif cat in ("action", "indice") and yh:
            base, src, vol, cap = yh, yh["source"], yh["volume"], yh["capitalisation"]
        out.add((base["ord"], base["ticker"], base["categorie"], src, vol, cap, base["statut"]))
    return out


@settings(max_examples=25, deadline=None)
@given(st.lists(row_st, min_size=1, max_size=60), st.randoms(use_true_random=False))
def test_fuse_matches_bruteforce(spark, rows, rnd):
    ords = list(range(len(rows)))
    rnd.shuffle(ords)
    data = [dict(r, ord=o) for r, o in zip(rows, ords)]
    df = spark.createDataFrame(
        [(d["ord"], d["ticker"], d["categorie"], d["source"], d["volume"], d["capitalisation"], d["statut"])
         for d in data],
        "ord long, ticker string, categorie string, source string, volume double, capitalisation double, statut string")
    got = {(r.ord, r.ticker, r.categorie, r.source, r.volume, r.capitalisation, r.statut)
           for r in fuse.fuse(df, "ord").collect()}
    assert got == brute(data)
