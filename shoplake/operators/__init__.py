from shoplake.operators.dedup import keep_first, without_copies, without_copies_late
from shoplake.operators.nested import explode_documents, explode_keeping
from shoplake.operators.ranking import first_per_group, top
from shoplake.operators.rules import first_failure, passing, rejects_by_rule

__all__ = [
    "explode_documents",
    "explode_keeping",
    "first_failure",
    "first_per_group",
    "keep_first",
    "passing",
    "rejects_by_rule",
    "top",
    "without_copies",
    "without_copies_late",
]
