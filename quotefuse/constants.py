"""Fixed values.

Everything in this module is a value that must stay equal to the surveyed
pipeline's for results to agree: names, lists, labels and thresholds. They
are listed plainly and in their natural order.
"""

# --- fixed values: quote categories, currencies, statuses -----------------
CATEGORIES = ("action", "action_fr", "crypto", "indice")
VALID_CURRENCIES = ("USD", "EUR", "GBP", "JPY", "CHF")
STATUS_OK = "succes"
STATUS_ERROR = "erreur"
DEFAULT_CURRENCY = "USD"
DEFAULT_TICKER = "unknown"

# --- fixed values: source names and combined labels -----------------------
SRC_YAHOO = "yahoo_finance"
SRC_BINANCE = "binance"
SRC_COINGECKO = "coingecko"
SRC_BOURSORAMA = "boursorama"
SRC_BINANCE_WS = "binance_ws"
LABEL_CRYPTO_FUSED = "binance+coingecko"
LABEL_FR_FUSED = "yahoo+boursorama"

# --- fixed values: column alias map (alias -> canonical name) -------------
# The first 21 entries are the original rename list; the last four are the
# names the collectors really emit for open/high/low/collection time, which
# the original list misses (their absence blanks OHLC in Silver).
ORIGINAL_ALIASES = (
    ("price", "prix"),
    ("current_price", "prix"),
    ("close", "prix"),
    ("c", "prix"),
    ("change", "variation_pct"),
    ("price_change_percentage_24h", "variation_pct"),
    ("P", "variation_pct"),
    ("high_24h", "prix_haut"),
    ("h", "prix_haut"),
    ("low_24h", "prix_bas"),
    ("l", "prix_bas"),
    ("open", "prix_ouv"),
    ("o", "prix_ouv"),
    ("total_volume", "volume"),
    ("v", "volume"),
    ("market_cap", "capitalisation"),
    ("symbol", "ticker"),
    ("s", "ticker"),
    ("name", "nom"),
    ("timestamp", "date_collecte"),
    ("collected_at", "date_collecte"),
)
COLLECTOR_ALIASES = (
    ("ouverture", "prix_ouv"),
    ("haut", "prix_haut"),
    ("bas", "prix_bas"),
    ("collecte_le", "date_collecte"),
)
DEFAULT_ALIASES = ORIGINAL_ALIASES + COLLECTOR_ALIASES

# --- fixed values: exchange-specific symbol -> common ticker --------------
BOURSORAMA_TICKERS = {
    "1rPTTE": "TTE.PA",
    "1rPBN": "BN.PA",
    "1rPAIR": "AIR.PA",
    "1rPSAN": "SAN.PA",
    "1rPOR": "OR.PA",
}

# --- fixed values: configured instrument lists ----------------------------
TICKERS_ACTIONS = ("AAPL", "MSFT", "NVDA", "GOOGL", "AMZN", "TSLA", "META")
TICKERS_INDICES = ("^GSPC", "^DJI", "^IXIC", "^FCHI", "^GDAXI", "^FTSE")
TICKERS_FR = ("TTE.PA", "BN.PA", "AIR.PA", "SAN.PA", "OR.PA")
COINS_COINGECKO = ("bitcoin", "ethereum", "binancecoin", "solana", "ripple",
                   "cardano", "dogecoin", "polkadot")
COINS_BINANCE = ("BTCUSDT", "ETHUSDT", "BNBUSDT", "SOLUSDT", "XRPUSDT",
                 "ADAUSDT", "DOGEUSDT", "DOTUSDT")
SYMBOLES_BOURSORAMA = ("1rPTTE", "1rPBN", "1rPAIR", "1rPSAN")

# --- fixed values: thresholds and sizes -----------------------------------
ALERT_THRESHOLD = 2.0          # |variation| >= threshold raises an alert
TOP_N = 5                      # movers and top cryptos
COMPLETENESS_WARN_PCT = 20.0   # pct NULL < 20 -> WARN, else FAIL (0 -> OK)
COHERENCE_MAX_ABS_VAR = 50.0   # |variation| > 50 -> WARN
DW_MAX_ABS_VAR = 100.0         # warehouse check: |variation| > 100 -> WARN
CLEAN_MIN_VAR = -100.0         # clean filter: variation within [-100, 100]
CLEAN_MAX_VAR = 100.0
SENTIMENT_LOW = 40.0           # [0,40) red, [40,60) orange, [60,100] green
SENTIMENT_HIGH = 60.0
SENTIMENT_REFERENCE = 50.0

# --- fixed values: labels --------------------------------------------------
MOVE_UP = "hausse"
MOVE_DOWN = "baisse"
ALERT_UP = "forte hausse"
ALERT_DOWN = "forte baisse"
TICK_UP = "HAUSSE"
TICK_DOWN = "BAISSE"
ARROW_UP = "▲"
ARROW_DOWN = "▼"
TICK_EVENT = "24hrTicker"
DQ_OK, DQ_WARN, DQ_FAIL = "OK", "WARN", "FAIL"

# --- fixed values: quality rule names --------------------------------------
RULE_HIGH_GE_LOW = "prix_haut_>=_prix_bas"
RULE_PRICE_IN_RANGE = "prix_dans_fourchette"
RULE_VAR_LE_50 = "variation_<=_50pct"
RULE_VOLUME_POS = "volume_positif"
RULE_PRICE_POS = "prix_positif"
RULE_TICKER_SET = "ticker_non_vide"
RULE_CURRENCY = "devise_valide"
RULE_CATEGORY = "categorie_valide"
RULE_NO_DUP = "pas_de_doublons"
DW_RULE_PRICE = "prix_negatifs"
DW_RULE_TICKER = "tickers_vides"
DW_RULE_VAR = "variation_aberrante"
DW_RULE_EMPTY = "tables_vides"
DW_ERROR = "erreur"

# --- fixed values: Boursorama error messages -------------------------------
MSG_BOURSO_EMPTY = "Symbole introuvable sur Boursorama (réponse vide)"
MSG_BOURSO_NO_D = "Champ 'd' absent ou inattendu"
MSG_BOURSO_NO_QD = "Champ 'qd' (quote du jour) absent dans la réponse"

MSG_JSON = "JSON illisible : "

# --- fixed values: pandas' default missing-value tokens (read_csv) ---------
PANDAS_NA_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN",
                    "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
                    "NULL", "NaN", "None", "n/a", "nan", "null")

# --- fixed values: warehouse table names -----------------------------------
HISTORY_TABLE = "historique_prix"
GOLD_TABLES = ("snapshot_marche", "top_mouvements", "resume_categorie",
               "resume_devise", "alertes_prix", "top_cryptos_cap")
DW_TABLES = (HISTORY_TABLE,) + GOLD_TABLES
