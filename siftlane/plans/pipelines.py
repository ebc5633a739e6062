"""Stage lists over one lead table, and the pipeline that applies them.

A stage is a function from DataFrame to DataFrame that adds columns; nothing runs before an action, so a
whole list of stages is one plan. The variants differ in their stages only.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from itertools import takewhile

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from siftlane.functions.text import emails, links, phones
from siftlane.operators import dedupe, gates, more_scores, rules, scores
from siftlane.session import shared_path

Stage = Callable[[DataFrame], DataFrame]


def with_contacts(leads: DataFrame) -> DataFrame:
    """emails, phones and websites found in the context, where the columns aren't there yet."""
    new = {"emails": emails, "phones": phones, "websites": links}
    return leads.withColumns({c: f("context") for c, f in new.items() if c not in leads.columns})


def kept(leads: DataFrame) -> DataFrame:
    return rules.split(leads)[0]


def merged(leads: DataFrame) -> DataFrame:
    return dedupe.merge_leads(leads)[0]


def with_brand(leads: DataFrame) -> DataFrame:
    return leads if "oem_brand" in leads.columns else leads.withColumn("oem_brand", F.lit(""))


def customers(leads: DataFrame) -> DataFrame:
    return gates.role_filter(leads).where("drop_reason is null").drop("drop_reason")


def fast_filtered(leads: DataFrame) -> DataFrame:
    return kept(gates.fast_filter(leads))


#: Stages that validate leads by address and name; a run may skip them.
VALIDATION: tuple[Stage, ...] = (fast_filtered, gates.entity_gate)
CLEAN: tuple[Stage, ...] = (gates.sanitise, lambda d: kept(gates.clean_dataset(d)), with_contacts)
STAGES: dict[str, tuple[Stage, ...]] = {
    "full": (*CLEAN, merged, scores.scan, gates.entity_gate, scores.heuristic, more_scores.role_by_majority, scores.signals, scores.hs_codes, scores.unscan),
    "v4": (*CLEAN, gates.entity_gate, scores.role, more_scores.additive_tier),
    "v7": (*CLEAN, scores.role, scores.evidence_layers, customers),
    "v9": (*CLEAN, fast_filtered, scores.scan, gates.entity_gate, gates.entity_type, scores.role, scores.signals, scores.evidence_layers, scores.evidence_counts, scores.contactability, with_brand, scores.hundred_points, scores.triggers, scores.final_score, scores.unscan),
    "v10": (*CLEAN, merged, scores.scan, scores.heuristic, scores.hundred_points, scores.triggers, scores.unscan),
}


@dataclass(frozen=True)
class Pipeline:
    """Stages in order."""

    stages: tuple[Stage, ...]

    @classmethod
    def named(cls, name: str) -> Pipeline:
        return cls(STAGES[name])

    def run(self, leads: DataFrame, upto: int | None = None) -> DataFrame:
        for stage in self.stages[:upto]:
            leads = stage(leads)
        return leads

    def observed(self, leads: DataFrame, names: Iterable[str] = ()) -> tuple[DataFrame, list[tuple[str, Observation]]]:
        """The pipeline's rows, and an observation before the first stage and behind each: once an action has gone through the rows, each has its count (n).
        Counting costs no scan and no job of its own. Stages that are computed more than once in a plan are observed once, and one that Spark proves empty beforehand has no count."""
        labels = [*names, *(f"stage {k}" for k in range(len(tuple(names)), len(self.stages) + 1))]
        seen = []
        for k in range(len(self.stages) + 1):
            leads = self.stages[k - 1](leads) if k else leads
            own = Observation(f"{labels[k]} {uuid.uuid4().hex[:8]}")
            leads = leads.observe(own, F.count(F.lit(1)).alias("n"))
            seen.append((labels[k], own))
        return leads, seen

    def without(self, *stages: Stage) -> Pipeline:
        return Pipeline(tuple(s for s in self.stages if s not in stages))

    def then(self, *stages: Stage) -> Pipeline:
        return Pipeline((*self.stages, *stages))


#: Stages that add columns and drop no lead.
ADDING: tuple[Stage, ...] = (with_contacts,)


def variants(leads: DataFrame, lists: dict[str, tuple[Stage, ...]] = STAGES) -> list[tuple[str, DataFrame]]:
    """(name, rows) of each stage list. The stages that all lists begin with run once: their rows are written as Parquet in the shared folder, but for what only
    adds columns at the end, as a list may need none of them. Behind them each list is a lazy plan, and what several lists begin with is the same frame, which Spark computes once
    where it shuffles."""
    shared = [s[0] for s in takewhile(lambda s: len(set(s)) == 1, zip(*lists.values()))]
    while shared and shared[-1] in ADDING:
        shared.pop()
    if shared:
        path = shared_path(leads.sparkSession, "variants")
        Pipeline(tuple(shared)).run(leads).write.parquet(path)
        leads = leads.sparkSession.read.parquet(path)
    made: dict[tuple[Stage, ...], DataFrame] = {(): leads}
    for stages in lists.values():
        rest = stages[len(shared) :]
        for k in range(1, len(rest) + 1):
            if rest[:k] not in made:
                made[rest[:k]] = rest[k - 1](made[rest[: k - 1]])
    return [(name, made[stages[len(shared) :]]) for name, stages in lists.items()]


def funnel(stages: Iterable[tuple[str, DataFrame]]) -> DataFrame:
    """(stage, n) of named frames, counted in one job."""
    out = None
    for name, frame in stages:
        own = frame.select(F.lit(name).alias("stage"))
        out = own if out is None else out.unionByName(own)
    return out.groupBy("stage").agg(F.count("*").alias("n"))
