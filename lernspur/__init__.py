"""Learner-attempt analytics on Spark."""

from .operators.graph import ProblemGraphs
from .operators.visits import event_lanes, normalize_visits
from .plans.outputs import read_by_task, write_by_task, write_table
from .plans.study import aggregate_events, problem_graphs, roll_up, run_study
from .sources.files import (
    bundle_manifest, key_inventory, read_roster, read_study, read_tasks, task_metadata, union_studies,
)
from .sources.records import bad_records, read_events

__all__ = [
    "ProblemGraphs", "aggregate_events", "bad_records", "bundle_manifest", "event_lanes", "key_inventory",
    "normalize_visits", "problem_graphs", "read_by_task", "read_events", "read_roster",
    "read_study", "read_tasks", "roll_up", "run_study", "task_metadata", "union_studies",
    "write_by_task", "write_table",
]
