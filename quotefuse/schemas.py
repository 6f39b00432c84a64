"""Explicit StructTypes for every layer (no schema inference anywhere)."""

from __future__ import annotations

from pyspark.sql import types as T

S, D, L, I = T.StringType(), T.DoubleType(), T.LongType(), T.IntegerType()


def struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# Fixed values from here on: column names and orders of the layers' contract.

# Union of what the four collectors emit (error rows fill only a few fields).
RAW_QUOTE = struct(
    ("ticker", S), ("nom", S), ("prix", D), ("ouverture", D), ("haut", D),
    ("bas", D), ("cloture_veille", D), ("variation_pct", D),
    ("variation_1h", D), ("variation_7j", D), ("volume", L),
    ("market_cap", L), ("rang", I), ("ath", D), ("supply", D), ("bid", D),
    ("ask", D), ("nb_trades_24h", L), ("devise", S), ("categorie", S),
    ("source", S), ("statut", S), ("erreur_msg", S), ("collecte_le", S),
)

TEXT_COLUMNS = ("ticker", "nom", "devise", "categorie", "source",
                "date_collecte", "fichier_source", "statut")
NUMERIC_COLUMNS = ("prix", "prix_ouv", "prix_haut", "prix_bas", "volume",
                   "variation_pct", "capitalisation")

# Order of the cast stage (step 1 of the clean SQL).
BRONZE_COLUMNS = ("ticker", "nom", "prix", "prix_ouv", "prix_haut", "prix_bas",
                  "volume", "variation_pct", "capitalisation", "devise",
                  "categorie", "source", "date_collecte", "fichier_source",
                  "statut")

SILVER_COLUMNS = BRONZE_COLUMNS[:-1]
SILVER = struct(*[(c, D if c in NUMERIC_COLUMNS else S) for c in SILVER_COLUMNS])

# Defaults used when a Silver column is missing before cleaning.
ENSURE_DEFAULTS = {c: None for c in BRONZE_COLUMNS}
ENSURE_DEFAULTS.update({"ticker": "unknown", "devise": "USD", "statut": "succes"})

TICK_COLUMNS = ("ticker", "prix", "prix_ouv", "prix_haut", "prix_bas", "volume",
                "variation_pct", "source", "categorie", "timestamp")
TICK = struct(*[(c, D if c in NUMERIC_COLUMNS else S) for c in TICK_COLUMNS])

# Exchange 24h ticker message: all fields arrive as JSON strings.
TICK_FIELDS = ("e", "s", "c", "P", "v", "h", "l", "o")
_tick_payload = struct(*[(f, S) for f in TICK_FIELDS])
TICK_ENVELOPE = T.StructType(
    [T.StructField("stream", S, True), T.StructField("data", _tick_payload, True)]
    + list(_tick_payload.fields)
)

# Warehouse column lists (without run_id / inserted_at).
HISTORY_COLUMNS = SILVER_COLUMNS[:-1]
GOLD_COLUMNS = {
    "snapshot_marche": ("date_snapshot", "total_actifs", "actifs_en_hausse",
                        "actifs_en_baisse", "actifs_neutres", "pct_marche_hausse",
                        "variation_moyenne", "variation_mediane",
                        "meilleure_variation", "pire_variation"),
    "top_mouvements": ("ticker", "nom", "prix", "variation_pct", "devise",
                       "categorie", "source", "type_mouvement"),
    "resume_categorie": ("categorie", "nb_actifs", "prix_moyen",
                         "variation_moyenne", "variation_max", "variation_min",
                         "nb_en_hausse", "nb_en_baisse", "volume_total",
                         "capitalisation_totale"),
    "resume_devise": ("devise", "nb_actifs", "variation_moyenne",
                      "nb_en_hausse", "nb_en_baisse"),
    "alertes_prix": ("ticker", "nom", "prix", "variation_pct", "niveau_alerte",
                     "categorie", "source", "devise"),
    "top_cryptos_cap": ("ticker", "nom", "prix", "capitalisation",
                        "variation_pct", "volume"),
}
INT_COLUMNS = {"total_actifs", "actifs_en_hausse", "actifs_en_baisse",
               "actifs_neutres", "nb_actifs", "nb_en_hausse", "nb_en_baisse"}
TEXT_DW_COLUMNS = {"date_snapshot", "ticker", "nom", "devise", "categorie",
                   "source", "type_mouvement", "niveau_alerte", "date_collecte"}


def dw_type(col: str) -> T.DataType:
    if col in INT_COLUMNS:
        return L
    if col in TEXT_DW_COLUMNS:
        return S
    return D
