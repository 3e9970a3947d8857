"""From envelope sources to reduced state and fields: the shared middle of compaction and checkpoints."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from chainfold.operators import continuity as N, latest as L
from chainfold.sources.blocks import unnest


@dataclass
class Source:
    """One cohort: its envelopes, its accounts, where it starts, and a folded prefix if there is one."""

    name: str
    envelopes: DataFrame
    accounts: list[str]
    start_block: int
    prefix: dict | None = None              # start_block, number, hash, state_root
    prefix_storage: DataFrame | None = None
    prefix_fields: DataFrame | None = None
    parent_hash: str | None = None

    @property
    def choice(self) -> dict:
        return L.choose_prefix(self.start_block, self.prefix)

    def used_prefix(self) -> dict | None:
        return self.prefix if self.choice["use_prefix"] else None

    def blocks(self, end: int) -> DataFrame:
        return L.up_to(self.envelopes, end).where(F.col("number") >= self.choice["delta_start"])


def check_interval(source: Source, header: dict) -> None:
    defects = N.validate_interval(source.envelopes, source.start_block, header, ",".join(source.accounts),
                                  source.used_prefix(), source.parent_hash)
    N.require_none(defects, f"source {source.name} is not usable")


def storage_changes(sources: list[Source], end: int, base: tuple[DataFrame, int] | None = None) -> DataFrame:
    folded = [(s.prefix_storage, s.prefix["number"]) for s in sources if s.used_prefix()]
    deltas = [unnest(s.blocks(end), "storage") for s in sources]
    return L.union_changes(deltas, folded + ([base] if base else []))


def storage_resets(sources: list[Source], end: int) -> DataFrame:
    parts = [unnest(s.blocks(end), "lifecycle").where("kind = 'storage_reset'").select("number", "ordinal", "address")
             for s in sources]
    result = parts[0]
    for one in parts[1:]:
        result = result.unionByName(one)
    return result


def reduced_storage(sources: list[Source], end: int, base: tuple[DataFrame, int] | None = None) -> DataFrame:
    return L.reduce_state(storage_changes(sources, end, base), storage_resets(sources, end)).select(
        "address", "slot", "value")


def observed_fields(sources: list[Source], end: int, base: DataFrame | None = None) -> DataFrame:
    rows = None
    for source in sources:
        blocks = source.blocks(end)
        part = L.field_rows(unnest(blocks, "balances"), unnest(blocks, "nonces"), unnest(blocks, "codes"))
        rows = part if rows is None else rows.unionByName(part)
    prefixes = [s.prefix_fields for s in sources if s.used_prefix()]
    return L.overlay_fields(base, prefixes, rows)
