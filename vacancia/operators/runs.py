"""Stored normalization runs: the newest generations and the drift log, published together."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from vacancia.operators import merge
from vacancia.operators.normalize import classified_jobs, drift_entries
from vacancia.operators.rules import TitleRule
from vacancia.schemas import DRIFT, NORMALIZATION, extended
from vacancia.sources.manifest import Manifest


class RunStore:
    """Generations of results, one folder a run, and the drift log they left.

    Each change is one commit of a manifest that lists the runs (id, moment, rows, folder) and the
    drift log's folder. A repeated run replaces itself: its folder takes the old one's place, and
    its drift values are merged into the log as it was before the run.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def _open(self) -> Manifest:
        return Manifest(self.spark, self.root)

    def runs(self) -> list[dict]:
        """run_id, run_at, rows, folder of each stored run, oldest first."""
        return self._open().state.get("runs", [])

    def generations(self) -> DataFrame:
        m = self._open()
        return m.read([r["folder"] for r in m.state.get("runs", [])], NORMALIZATION)

    def drift(self) -> DataFrame:
        m = self._open()
        return m.read([f for f in [m.state.get("drift")] if f], DRIFT)

    def import_drift(self, log: DataFrame) -> None:
        """Takes a log that was kept elsewhere, with its counts and states."""
        m = self._open()
        m.commit(m.state | {"drift": m.stage(log.select(*DRIFT.names), "drift"), "last": None})

    def append(self, results: DataFrame, run_id: str, run_at: dt.datetime) -> int:
        """Stores a generation; one that is there under this id is replaced. Returns its rows."""
        m = self._open()
        seen = Observation()
        folder = m.stage(results.select(*NORMALIZATION.names).observe(seen, F.count(F.lit(1)).alias("rows")), "generation")
        m.commit(m.state | {"runs": _with_run(m.state, run_id, run_at, seen.get["rows"], folder)})
        return seen.get["rows"]

    def prune(self, keep: int = 3) -> int:
        """Removes the folders of all but the newest runs, by the manifest alone; returns the rows that went."""
        m = self._open()
        kept, gone = _newest(m.state.get("runs", []), keep)
        if gone:
            m.commit(m.state | {"runs": kept})
        return sum(r["rows"] for r in gone)

    def normalize(
        self, jobs: DataFrame, rules: Sequence[TitleRule], run_id: str, run_at: dt.datetime, since: Column | None = None, keep: int = 3,
    ) -> dict[str, int]:
        """Classifies the jobs loaded since a moment, stores the generation, merges its unmapped values into the
        drift log and keeps the newest runs, all in one commit. Returns the counters normalized, drift, pruned.

        The jobs are classified once; the drift values are read back from what was stored. A run
        without jobs stores nothing. If an older run than the last one is repeated, its results
        are replaced, and the drift log, which has counted it, stays.
        """
        m = self._open()
        seen = Observation()
        rows = classified_jobs(jobs, rules, run_id, _moment(run_at), since).observe(
            seen, F.count(F.lit(1)).alias("normalized"), F.count("drift_value").alias("drift")
        )
        folder = m.stage(rows, "generation")
        found = seen.get
        if not found["normalized"]:
            return {"normalized": 0, "drift": 0, "pruned": 0}
        state = m.state
        last = state.get("last") or {}
        repeated = last.get("run_id") == run_id
        if repeated or not any(r["run_id"] == run_id for r in state.get("runs", [])):
            before = last["drift_before"] if repeated else state.get("drift")
            log = m.read([before] if before else [], DRIFT)
            entries = drift_entries(m.read([folder], extended(NORMALIZATION, "drift_value")))
            drift = m.stage(merge.drift_upsert(log, entries, run_id, _moment(run_at)).select(*DRIFT.names), "drift")
            state = state | {"drift": drift, "last": {"run_id": run_id, "drift_before": before}}
        kept, gone = _newest(_with_run(state, run_id, run_at, found["normalized"], folder), keep)
        m.commit(state | {"runs": kept})
        return {"normalized": found["normalized"], "drift": found["drift"], "pruned": sum(r["rows"] for r in gone)}


def _moment(at: dt.datetime) -> Column:
    """The moment as UTC, the session's zone; without a zone it is taken as UTC."""
    utc = at.astimezone(dt.timezone.utc) if at.tzinfo else at
    return F.lit(utc.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp")


def _with_run(state: dict, run_id: str, run_at: dt.datetime, rows: int, folder: str) -> list[dict]:
    others = [r for r in state.get("runs", []) if r["run_id"] != run_id]
    return sorted([*others, {"run_id": run_id, "run_at": run_at.isoformat(), "rows": rows, "folder": folder}], key=lambda r: (r["run_at"], r["run_id"]))


def _newest(runs: list[dict], keep: int) -> tuple[list[dict], list[dict]]:
    cut = max(0, len(runs) - keep)
    return runs[cut:], runs[:cut]
