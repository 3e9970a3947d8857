"""Every user-level entry point in one place."""

from chainfold.operators.block_end import block_state
from chainfold.operators.persistence import granular_changes
from chainfold.operators.telemetry import output_meter
from chainfold.plans.checkpoint import build_checkpoint
from chainfold.plans.compaction import audit_prefix, compact, growth_report, isolated_copy
from chainfold.plans.diagnostics import compare_states, update_parity, verify_current_state
from chainfold.plans.growth import record_growth, recorded
from chainfold.plans.onboarding import join_cohorts
from chainfold.plans.portable import export_checkpoint, import_checkpoint, verify_export
from chainfold.plans.readers import audit_reads, page, pin, pins, show, unpin
from chainfold.plans.removal import history_plan, prune_checkpoints, prune_history, retention_plan
from chainfold.plans.runs import summarize_runs
from chainfold.plans.store import ready_checkpoints
from chainfold.plans.tables import project_tables
from chainfold.streaming.follow import follow, ingest
from chainfold.streaming.replay import replay

__all__ = [
    "audit_prefix", "audit_reads", "block_state", "build_checkpoint", "compact", "compare_states", "export_checkpoint",
    "follow", "granular_changes", "growth_report", "history_plan", "import_checkpoint", "ingest", "isolated_copy",
    "join_cohorts", "output_meter", "page", "pin", "pins", "project_tables", "prune_checkpoints", "prune_history", "record_growth", "recorded",
    "ready_checkpoints", "replay", "retention_plan", "show", "summarize_runs", "unpin", "update_parity", "verify_current_state",
    "verify_export",
]
