"""The fusion of all collected runs, kept up to date run by run.

The state of a fusion is its aggregate: the first candidate of each (category,
ticker, source). Below one root there are, named by a ledger,

  partiels/load_id=…/run_id=…   the state of one run's rows alone
  etats/load_id=…               the merged state after each update

An update reads the rows of runs that are new or were collected again, and
nothing else of Bronze: their partial states are written, merged with a stored
state that holds none of them, and the result is stored. Merging is a minimum,
so runs may come in any order. A candidate cannot be taken out of a minimum;
therefore a run that is collected again starts from the last state in which no
replaced run takes part, and the partial states of the runs after it are merged
anew. For the usual case, a new run or the last one again, that is the state
before it. At most ``keep`` states stay; beyond them all partial states are
merged. Sizes follow the instruments (at most five rows of a group per state),
not the history of Bronze.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotefuse.operators import fuse
from quotefuse.plans import ledger

PARTIALS, STATES, FORGOTTEN = "partiels", "etats", "oublie"


def _partial_path(root: str, e: ledger.Entry) -> str:
    return f"{root}/{PARTIALS}/{ledger.LOAD_COL}={e.load_id}/run_id={e.run_id}"


def _state_path(root: str, load_id: str) -> str:
    return f"{root}/{STATES}/{ledger.LOAD_COL}={load_id}"


def base_state(states: list[ledger.Entry], partials: list[ledger.Entry], changed: set[str]) -> ledger.Entry | None:
    """The newest state without a candidate that is no longer true: none of ``changed``
    takes part in it, nor another run in a version that was replaced since."""
    for s in sorted(states, key=lambda e: -e.seq):
        stale = any(p.first_seq <= s.seq and (p.run_id in changed or p.seq > s.seq) for p in partials)
        if not stale:
            return s
    return None


def update(spark: SparkSession, root: str, runs: Mapping[str, str], rows: Callable[[list[str]], DataFrame],
           order: str, keep: int = 48) -> dict:
    """Brings the state in line with ``runs`` (run id -> a text that changes when the run is
    collected again; a run left out has no rows any more). ``rows`` gives the Bronze rows of some
    runs with ``run_id`` and the order column. Returns what was read and the state's path."""
    partials = ledger.live(spark, root, PARTIALS)
    states = [e for e in ledger.live(spark, root, STATES) if e.source != FORGOTTEN]
    known = {e.run_id: e.source for e in partials}
    changed = sorted(r for r, s in runs.items() if known.get(r) != s)
    gone = sorted(r for r, s in known.items() if r not in runs and s)
    last = max(states, key=lambda e: e.seq, default=None)
    if not changed and not gone and last:
        return {"lus": [], "base": last.seq, "fusionnes": [], "etat": _state_path(root, last.load_id)}
    load = ledger.new_load()
    counts: dict[str, int] = {}
    if changed:
        target = f"{root}/{PARTIALS}/{ledger.LOAD_COL}={load}"
        fuse.partial(rows(changed), order, by=("run_id",)).write.partitionBy("run_id").parquet(target)
        written = spark.read.schema(f"{fuse.STATE_KEY[1]} string, run_id string").parquet(target)
        counts = {r["run_id"]: r["count"] for r in written.groupBy("run_id").count().collect()}  # a row per run read
    new = [ledger.Entry(PARTIALS, r, load, counts.get(r, 0), runs.get(r, "")) for r in [*changed, *gone]]
    base = base_state(states, partials, set(changed) | set(gone))
    again = [p for p in partials if p.run_id not in {*changed, *gone} and (base is None or p.seq > base.seq)]
    paths = [_partial_path(root, e) for e in [*again, *new] if e.nb_lignes]
    if base is not None and base.nb_lignes:
        paths.append(_state_path(root, base.load_id))
    target = _state_path(root, load)
    schema = fuse.partial(rows([]).drop("run_id"), order).schema
    parts = spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)
    fuse.merge(parts).write.parquet(target)
    n = spark.read.schema(schema).parquet(target).count()
    ledger.commit(spark, root, [*new, ledger.Entry(STATES, load, load, n)])
    _forget(spark, root, sorted(states, key=lambda e: -e.seq)[keep - 1:])
    return {"lus": changed, "base": base.seq if base else None, "fusionnes": [p.run_id for p in again], "etat": target}


def _forget(spark: SparkSession, root: str, old: list[ledger.Entry]) -> None:
    """Drops the oldest states: their folders go, their entries are marked."""
    if old:
        for e in old:
            fs, p = ledger._fs(spark, _state_path(root, e.load_id))  # noqa: SLF001
            fs.delete(p, True)
        ledger.commit(spark, root, [ledger.Entry(STATES, e.run_id, e.load_id, 0, FORGOTTEN) for e in old])


def fused(spark: SparkSession, root: str, runs: Mapping[str, str], rows: Callable[[list[str]], DataFrame],
          order: str, keep: int = 48) -> tuple[DataFrame, dict]:
    """The fused rows over all ``runs``, and what the update read."""
    done = update(spark, root, runs, rows, order, keep)
    schema = fuse.partial(rows([]).drop("run_id"), order).schema
    return fuse.resolve(spark.read.schema(schema).parquet(done["etat"])), done
