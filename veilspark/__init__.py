"""Policy-driven de-identification of tables and streams on Spark.

The main entry points, importable from the package root::

    from veilspark import load_policy, apply_policy, apply_policy_json, split_rejected
"""

from veilspark.operators.drift import drift_report, field_inventory, table_type_profile, type_profile
from veilspark.operators.lake import add_time_columns, evolve_union, merge_into, upsert_latest, write_daily
from veilspark.operators.protect import apply_policy, apply_policy_json, keep_all_json, protect_json, split_rejected
from veilspark.operators.validate import validate_fields, validation_summary
from veilspark.operators.versions import PolicyVersion, apply_policy_asof, protect_json_asof
from veilspark.policy import Policy, Rule, check, lint, load_policy
from veilspark.session import get_session
from veilspark.streaming.enrich import EnrichStream
from veilspark.streaming.job import PolicyMonitor, ProtectStream

__all__ = [
    "EnrichStream", "Policy", "PolicyMonitor", "PolicyVersion", "ProtectStream", "Rule", "add_time_columns", "apply_policy", "apply_policy_asof", "apply_policy_json",
    "check", "drift_report", "evolve_union", "field_inventory", "get_session", "keep_all_json", "lint", "load_policy",
    "merge_into", "protect_json", "protect_json_asof", "split_rejected", "table_type_profile", "type_profile",
    "upsert_latest", "validate_fields", "validation_summary", "write_daily",
]
