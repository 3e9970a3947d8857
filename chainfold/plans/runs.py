"""Summary of measured ingest runs: cold against warm, and two live followers over their common window."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from chainfold.operators import telemetry as T
from chainfold.operators.continuity import require_none


def summarize_runs(runs: DataFrame, samples: DataFrame, identity: list[str], cold: str = "cold", warm: str = "warm",
                   live: tuple[str, ...] = ("live", "live-tuned")) -> dict[str, DataFrame]:
    """Check and summarise runs(phase, started, finished, …identity…) with samples(phase, …lag sample…).

    Returns the live windows per phase: each on its own (startup excluded) and over the overlap.
    """
    require_none(T.run_differences(runs, cold, warm, identity), "cold and warm runs differ")
    followers = runs.where(F.col("phase").isin(*live))
    overlap = T.run_overlap(followers).first()
    if not overlap["overlaps"]:
        raise ValueError("live runs have no overlapping measurement window")
    own = samples.join(followers.select("phase", "started", "finished"), "phase")
    own = T.within(own, F.col("started") + T.STARTUP_NS, F.col("finished")).drop("started", "finished")
    common = T.within(samples.where(F.col("phase").isin(*live)), overlap["start"], overlap["finish"])
    for window in (own, common):
        require_none(T.live_window_defects(window, ["phase"]), "live window proves nothing")
    return {"after_startup": T.live_window(own, ["phase"]), "overlap": T.live_window(common, ["phase"])}
