"""The warehouse as tables of the Spark catalog, and SQL over it.

``register`` declares the seven tables over the folders of a warehouse root, one
partition per run, and brings the partitions in line with the ledger: a live run
with rows points at its load's folder, anything else is dropped. For every table
there is a view ``<table>_dernier`` of the newest run, which is empty if that run
has no rows. With a metastore the tables outlive the session, and a load calls
``register`` to publish its partitions; with the session's own catalog it is
called once per session.

``query`` runs a SQL text against these tables. Values are bound parameters
(``:name``), never pasted into the text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

from quotefuse import constants as K
from quotefuse.plans import ledger, warehouse

LATEST = "_dernier"
SEQ = "ledger.seq"
BATCH = 200  # partitions named in one statement


def database_of(root: str) -> str:
    """A database name of its own for every warehouse root."""
    return "cotations_" + hashlib.sha1(root.rstrip("/").encode("utf-8")).hexdigest()[:12]


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _parts(items: Iterable[str], joint: str) -> Iterable[str]:
    items = list(items)
    for at in range(0, len(items), BATCH):
        yield joint.join(items[at: at + BATCH])


def create(spark: SparkSession, root: str, database: str | None = None, tables=K.DW_TABLES) -> str:
    """Creates the database and its tables if they are missing (K4); the database."""
    db = database or database_of(root)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    for t in tables:
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in warehouse.table_schema(t).fields)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {db}.{t} ({columns}) USING parquet "
                  f"PARTITIONED BY ({warehouse.RUN_COL}) LOCATION {_text(f'{root}/{t}')}")
    return db


def registered(spark: SparkSession, db: str, table: str) -> set[str]:
    """The runs that have a partition."""
    return {row[0].partition("=")[2] for row in spark.sql(f"SHOW PARTITIONS {db}.{table}").collect()}


def _synced(spark: SparkSession, db: str, table: str) -> int:
    """The last commit that the table's partitions follow (a table property)."""
    for row in spark.sql(f"SHOW TBLPROPERTIES {db}.{table}").collect():
        if row["key"] == SEQ:
            return int(row["value"])
    return 0


def register(spark: SparkSession, root: str, database: str | None = None, tables=K.DW_TABLES) -> str:
    """Tables, partitions and views in line with the ledger; the database. Only runs
    committed since the last call are touched."""
    db = create(spark, root, database, tables)
    live = ledger.live(spark, root)
    for t in tables:
        entries = [e for e in live if e.table_name == t]
        last = max((e.seq for e in entries), default=0)
        synced = _synced(spark, db, t)
        if synced == last and last:
            continue
        new = [e for e in entries if e.seq > synced]
        have = registered(spark, db, t)
        spec = lambda run: f"PARTITION ({warehouse.RUN_COL} = {_text(run)})"
        path = {e.run_id: ledger.folder(root, t, e.run_id, e.load_id) for e in new if e.nb_lignes}
        for run in path.keys() & have:  # loaded again: the partition moves to the new folder in one statement
            spark.sql(f"ALTER TABLE {db}.{t} {spec(run)} SET LOCATION {_text(path[run])}")
        for part in _parts((f"{spec(r)} LOCATION {_text(p)}" for r, p in path.items() if r not in have), " "):
            spark.sql(f"ALTER TABLE {db}.{t} ADD IF NOT EXISTS {part}")
        for part in _parts((spec(e.run_id) for e in new if e.run_id in have and e.run_id not in path), ", "):
            spark.sql(f"ALTER TABLE {db}.{t} DROP IF EXISTS {part}")
        newest = max((e.run_id for e in entries), default=None)
        test = f"= {_text(newest)}" if newest is not None else "IS NULL"
        spark.sql(f"CREATE OR REPLACE VIEW {db}.{t}{LATEST} AS SELECT * FROM {db}.{t} WHERE {warehouse.RUN_COL} {test}")
        spark.sql(f"ALTER TABLE {db}.{t} SET TBLPROPERTIES ('{SEQ}' = '{last}')")
    return db


def query(spark: SparkSession, database: str, sql: str, args: Mapping[str, object] | None = None) -> DataFrame:
    """A SQL text over the tables of ``database``; ``args`` are bound to its ``:name`` parameters."""
    before = spark.catalog.currentDatabase()
    spark.catalog.setCurrentDatabase(database)
    try:
        return spark.sql(sql, args=dict(args or {}))  # names are resolved here
    finally:
        spark.catalog.setCurrentDatabase(before)


# The dashboard's questions as SQL (S10). Descending orders put nulls first, as
# the original warehouse does; the ticker settles equal values.
TEXTS = {
    "apercu": "SELECT * FROM snapshot_marche ORDER BY inserted_at DESC NULLS FIRST, run_id DESC LIMIT 1",
    "categories": """SELECT categorie, nb_actifs, variation_moyenne, nb_en_hausse, nb_en_baisse, volume_total
        FROM resume_categorie ORDER BY nb_actifs DESC NULLS FIRST, categorie NULLS LAST""",
    "prix": "SELECT * FROM historique_prix ORDER BY variation_pct DESC NULLS FIRST, ticker NULLS LAST",
    "prix_categorie": """SELECT * FROM historique_prix WHERE categorie = :categorie
        ORDER BY variation_pct DESC NULLS FIRST, ticker NULLS LAST""",
    "mouvements": "SELECT * FROM top_mouvements ORDER BY variation_pct DESC NULLS FIRST, ticker NULLS LAST",
    "devises": "SELECT * FROM resume_devise ORDER BY nb_actifs DESC NULLS FIRST, devise NULLS LAST",
    "cryptos": "SELECT * FROM top_cryptos_cap ORDER BY capitalisation DESC NULLS FIRST, ticker NULLS LAST",
    "alertes": "SELECT * FROM alertes_prix ORDER BY variation_pct DESC NULLS FIRST, ticker NULLS LAST",
    "tickers": "SELECT DISTINCT ticker FROM historique_prix ORDER BY ticker NULLS LAST",
    "historique": """SELECT ticker, prix, variation_pct, volume, date_collecte, categorie, source, inserted_at
        FROM historique_prix WHERE ticker = :ticker
        ORDER BY inserted_at DESC NULLS FIRST, date_collecte DESC NULLS FIRST, prix, variation_pct, volume, categorie, source""",
}


def ask(spark: SparkSession, database: str, name: str, **args) -> DataFrame:
    """One of the dashboard's questions by name."""
    return query(spark, database, TEXTS[name], args)
