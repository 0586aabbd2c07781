"""The stored model graph: models are built in the order of what they need, and only if something they depend on changed."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from graphlib import TopologicalSorter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vacancia.operators.merge import merge_delete_insert
from vacancia.plans import models as m
from vacancia.sources.manifest import Manifest

Inputs = dict[str, DataFrame]


@dataclass(frozen=True)
class Model:
    """A named result. ``build`` gets its inputs by name and its parameters as columns.

    A view is not stored: it is part of the plans that read it. A table is stored whole. An
    incremental model has one part for each value of the parameter ``part``, which ``build`` puts into the
    column ``by``; only the part of this run is read, merged by ``keys`` and stored again.
    ``version`` is raised when the rule changes.
    """

    name: str
    needs: tuple[str, ...]
    build: Callable[[Inputs, dict[str, Column]], DataFrame]
    kind: str = "table"
    params: tuple[str, ...] = ()
    version: int = 1
    part: str | None = None
    by: str | None = None
    keys: tuple[str, ...] = ()


@dataclass
class Source:
    """An input from outside and what stands for its content: equal fingerprints mean nothing changed."""

    rows: DataFrame
    fingerprint: str


def _hash(*parts) -> str:
    return hashlib.sha256(json.dumps(parts, sort_keys=True).encode()).hexdigest()


def files_fingerprint(spark: SparkSession, *paths: str) -> str:
    """Names, lengths and times of all files below the paths; no content is read."""
    found = []
    for path in paths:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        files = p.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(p, True)
        while files.hasNext():
            f = files.next()
            found.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return _hash(sorted(found))


@dataclass
class Graph:
    """Models over sources, stored below ``root``; the manifest there has each model's folders and fingerprints."""

    spark: SparkSession
    root: str
    models: Sequence[Model]
    frames: Inputs = field(default_factory=dict)

    def order(self, sources: Sequence[str] = ()) -> list[Model]:
        """Models after everything they need; unknown names and cycles are errors."""
        by_name = {x.name: x for x in self.models}
        if len(by_name) < len(self.models):
            raise ValueError("a model is named twice")
        known = by_name.keys() | set(sources)
        for x in self.models:
            if sources and (unknown := set(x.needs) - known):
                raise ValueError(f"{x.name} needs {', '.join(sorted(unknown))}, which nothing gives")
        order = TopologicalSorter({x.name: [n for n in x.needs if n in by_name] for x in self.models}).static_order()
        return [by_name[n] for n in order]

    def run(self, sources: dict[str, Source], params: dict[str, str]) -> list[tuple[str, str]]:
        """Builds what changed; returns (model, 'view', 'built' or 'kept') in order. ``params``: SQL literals by name.

        Every table is published when it is finished, so a run that dies is taken up where it
        stopped. Afterwards ``frames`` reads the stored tables.
        """
        manifest = Manifest(self.spark, self.root)
        self.frames = {n: s.rows for n, s in sources.items()}
        prints = {n: s.fingerprint for n, s in sources.items()}
        report = []
        for model in self.order(list(sources)):
            values = {p: params[p] for p in model.params}
            wanted = _hash(model.name, model.version, model.kind, values, [prints[n] for n in model.needs])
            inputs = {n: self.frames[n] for n in model.needs}
            made = lambda: model.build(inputs, {p: F.expr(v) for p, v in values.items()})  # noqa: B023, E731
            stored = manifest.state.get(model.name)
            if model.kind == "view":
                self.frames[model.name], prints[model.name] = made(), wanted
                report.append((model.name, "view"))
                continue
            part = values[model.part] if model.part else ""
            parts = dict(stored["parts"]) if stored else {}
            if part in parts and parts[part]["print"] == wanted:
                report.append((model.name, "kept"))
            else:
                rows = made()
                if model.part and part in parts:
                    old = manifest.read([parts[part]["folder"]], rows.schema)
                    rows = merge_delete_insert(old, rows, model.keys)
                folder = manifest.stage(rows, model.name)
                parts[part] = {"print": wanted, "folder": folder}
                stored = {"parts": parts, "schema": rows.schema.jsonValue()}
                manifest.commit(manifest.state | {model.name: stored})
                report.append((model.name, "built"))
            prints[model.name] = _hash(sorted((k, v["print"]) for k, v in stored["parts"].items()))
            self.frames[model.name] = self._stored(manifest, stored)
        return report

    def _stored(self, manifest: Manifest, stored: dict) -> DataFrame:
        from pyspark.sql.types import StructType

        folders = [p["folder"] for _, p in sorted(stored["parts"].items())]
        return manifest.read(folders, StructType.fromJson(stored["schema"]))


def warehouse(look: m.Lookups, lookups_version: int = 1) -> list[Model]:
    """The fourteen models over jobs, generations and skill_log. Parameters: as_of (a moment), day (a date).

    The lookups are small tables a person keeps; ``lookups_version`` is raised when they change.
    """
    def named(name: str, needs: str, build, **more) -> Model:
        return Model(name, tuple(needs.split()), build, **more)

    dated = {"params": ("day",)}
    return [
        named("stg_job_detail", "jobs", lambda i, p: m.stg_job_detail(i["jobs"], p["as_of"]), kind="view", params=("as_of",)),
        named(
            "silver_job_detail", "stg_job_detail generations",
            lambda i, p: m.silver_job_detail(i["stg_job_detail"], i["generations"], look), version=lookups_version,
        ),
        named("silver_company_dim", "silver_job_detail", lambda i, p: m.silver_company_dim(i["silver_job_detail"])),
        named("silver_skill_long", "silver_job_detail", lambda i, p: m.silver_skill_long(i["silver_job_detail"])),
        named("silver_skill_enriched", "skill_log", lambda i, p: m.silver_skill_enriched(i["skill_log"]), kind="view"),
        named(
            "silver_skill_unified", "silver_skill_long silver_skill_enriched",
            lambda i, p: m.silver_skill_unified(i["silver_skill_long"], i["silver_skill_enriched"]),
        ),
        named(
            "fct_jobs_daily", "silver_job_detail", lambda i, p: m.fct_jobs_snapshot(i["silver_job_detail"], p["day"]),
            kind="incremental", part="day", by="snapshot_date", keys=(*m.JOB, "snapshot_date"), **dated,
        ),
        named("mart_company_hiring", "silver_job_detail", lambda i, p: m.mart_company_hiring(i["silver_job_detail"], p["day"]), **dated),
        named("mart_salary_by_level", "silver_job_detail", lambda i, p: m.mart_salary_by_level(i["silver_job_detail"], p["day"]), **dated),
        named(
            "mart_skill_demand", "silver_job_detail silver_skill_long",
            lambda i, p: m.mart_skill_demand(i["silver_job_detail"], i["silver_skill_long"], p["day"]), **dated,
        ),
        named(
            "mart_skill_demand_v2", "silver_job_detail silver_skill_unified",
            lambda i, p: m.mart_skill_demand_v2(i["silver_job_detail"], i["silver_skill_unified"], p["day"]), **dated,
        ),
        named("mart_skill_cooccurrence", "silver_skill_unified", lambda i, p: m.mart_skill_cooccurrence(i["silver_skill_unified"], p["day"]), **dated),
        named("mart_skill_trend", "fct_jobs_daily silver_skill_unified", lambda i, p: m.mart_skill_trend(i["fct_jobs_daily"], i["silver_skill_unified"])),
        named(
            "job_features", "silver_job_detail silver_skill_long",
            lambda i, p: m.job_features(i["silver_job_detail"], i["silver_skill_long"], p["day"]), **dated,
        ),
    ]
