from silverloom.operators.conform import conform, conform_report
from silverloom.operators.dml import (
    AmbiguousMerge,
    Insert,
    Update,
    absent_rows,
    cascade_delete,
    delete_where,
    insert_if_absent,
    merge,
    update_where,
)
from silverloom.operators.objects import explode_objects
from silverloom.operators.ordering import assign_parts, top_k, union_all, with_position
from silverloom.operators.quality import (
    fk_orphans,
    length_violations,
    pk_violations,
    profile,
    row_counts,
    run_suite,
)
from silverloom.operators.scd2 import scd2_apply, scd2_chain, scd2_stage
from silverloom.operators.substrings import substring_index, texts_containing

__all__ = [
    "AmbiguousMerge",
    "Insert",
    "Update",
    "absent_rows",
    "assign_parts",
    "cascade_delete",
    "conform",
    "conform_report",
    "delete_where",
    "explode_objects",
    "fk_orphans",
    "insert_if_absent",
    "length_violations",
    "merge",
    "pk_violations",
    "profile",
    "row_counts",
    "run_suite",
    "scd2_apply",
    "scd2_chain",
    "scd2_stage",
    "substring_index",
    "texts_containing",
    "top_k",
    "union_all",
    "update_where",
    "with_position",
]
