"""CSV files cut into splits give the rows that whole files give."""
import os
import random

import pytest
from pyspark.sql import functions as F

from quotefuse.session import scratch_path
from quotefuse.sources import bronze

FIELDS = ["plain", "", 'say "hi", ok', "two\nlines", "a,b", "NA", '"', '""\n""', "é\n\n\nü", "x" * 300, "\n", "1.5", "tail\n"]


def cell(text):
    return '"' + text.replace('"', '""') + '"' if any(c in text for c in ',"\n') else text


def write(folder, name, columns, rows, end="\n", last=True):
    os.makedirs(folder, exist_ok=True)
    body = end.join(",".join(map(cell, r)) for r in [columns, *rows]) + (end if last else "")
    with open(f"{folder}/{name}", "w", encoding="utf-8", newline="") as f:
        f.write(body)
    return len(body.encode())


@pytest.fixture
def small_splits(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700b")
    spark.conf.set("spark.sql.files.openCostInBytes", "1b")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def test_rows_of_any_split(spark, small_splits):
    rng = random.Random(3)
    folder = scratch_path(spark, "csv-split").removeprefix("file:")
    want = []
    for i, (columns, end, last) in enumerate(((["ticker", "nom", "prix"], "\n", True), (["prix", "ticker", "nom"], "\n", False))):
        rows = [[f"T{i}x{k}", rng.choice(FIELDS), rng.choice(["1", "2.5", "NA"])] for k in range(400)]
        order = [["ticker", "nom", "prix"].index(c) for c in columns]
        write(folder, f"lot {i}.csv", columns, [[r[j] for j in order] for r in rows], end, last)
        want += [(r[0], None if r[1] in ("", "NA") else r[1], None if r[2] == "NA" else r[2], f"lot {i}.csv", k) for k, r in enumerate(rows)]
    write(folder, "vide.csv", [], [], last=False)
    got = bronze.scan_split(spark, [folder, f"{folder}/absent"]).collect()
    names = {r["fichier_source"] for r in got}
    byfile = {}
    for r in sorted(got, key=lambda r: (r["fichier_source"], r["_qf_pos"])):
        byfile.setdefault(r["fichier_source"], []).append((r["ticker"], r["nom"], r["prix"]))
    for name in names:  # in the order of the file, no row lost or doubled
        assert byfile[name] == [w[:3] for w in want if w[3].replace(" ", "%20") == name or w[3] == name]
    assert sum(map(len, byfile.values())) == len(want)
    plain = ["ticker", "nom", "prix", "fichier_source"]
    whole, split = (sorted(map(str, scan(spark, [folder]).select(plain).collect())) for scan in (bronze.scan_bronze, bronze.scan_split))
    assert whole == split


def test_a_file_is_read_by_many_tasks_and_every_byte_once(spark, small_splits):
    folder = scratch_path(spark, "csv-split").removeprefix("file:")
    size = write(folder, "large.csv", ["ticker", "nom"], [[f"T{k}", FIELDS[k % len(FIELDS)]] for k in range(500)])
    rows = bronze.lines(spark, [folder])
    assert rows.select("at").distinct().count() > 10
    assert rows.agg(F.sum(F.octet_length("value") + 1)).first()[0] == size
    out = bronze.scan_split(spark, [folder])
    assert out.count() == 500 == out.select("_qf_pos").distinct().count()
    assert bronze.scan_split(spark, [folder], broadcast_rows=0).count() == 500


def test_line_ends_and_a_quote_that_stays_open(spark, small_splits):
    folder = scratch_path(spark, "csv-split").removeprefix("file:")
    write(folder, "crlf.csv", ["﻿ticker", "nom"], [["A", "two\nlines"], ["B", "one"]], end="\r\n")
    got = {r["ticker"]: r["nom"] for r in bronze.scan_split(spark, [folder]).collect()}
    assert got == {"A": "two\nlines", "B": "one"}
    with open(f"{folder}/open.csv", "w") as f:
        f.write('ticker,nom\nA,"never closed\n' + "B,1\n" * 300)
    with pytest.raises(ValueError, match="open.csv"):
        bronze.scan_split(spark, [folder], record_lines=100)
    none = bronze.scan_split(spark, [f"{folder}/absent"])
    assert none.count() == 0 and "ticker" in none.columns
