from brindle.plans.inspect import executed_plan, plan_text, scoped_conf
from brindle.plans.sizing import broadcast_if_small, measured_bytes, shuffled_if_large
from brindle.plans.workspace import checkpointed, materialize, shared_dir, table_name, work_scope

__all__ = [
    "broadcast_if_small",
    "checkpointed",
    "executed_plan",
    "materialize",
    "measured_bytes",
    "plan_text",
    "scoped_conf",
    "shared_dir",
    "shuffled_if_large",
    "table_name",
    "work_scope",
]
