"""Find, review and erase a person's rows in large tables, with Spark DataFrames."""

from lethe.operators.classify import Classification, classify
from lethe.operators.erase import erase, update_by_row_match
from lethe.operators.masking import mask, update_script
from lethe.operators.review import apply_decisions, report
from lethe.plans.rewrite import Change, CheckFailed, Places, Run, purge, read_manifest
from lethe.plans.search import SearchFailed, SearchResult, search, search_two_pass, write_hits
from lethe.plans.store import SubjectStore
from lethe.plans.workflow import erase_reviewed
from lethe.settings import LAKE, WAREHOUSE, Limits, Settings
from lethe.sources.catalog import catalog_columns, columns_of, warehouse_columns
from lethe.sources.requests import read_key_values, subjects_from
from lethe.sources.tables import (
    LakeTable,
    open_catalog_tables,
    scan_catalog_table,
    scan_warehouse_table,
)

__all__ = [
    "Change",
    "CheckFailed",
    "Classification",
    "LAKE",
    "LakeTable",
    "Limits",
    "Places",
    "Run",
    "SearchFailed",
    "SearchResult",
    "Settings",
    "SubjectStore",
    "WAREHOUSE",
    "apply_decisions",
    "catalog_columns",
    "classify",
    "columns_of",
    "erase",
    "erase_reviewed",
    "mask",
    "open_catalog_tables",
    "purge",
    "read_key_values",
    "read_manifest",
    "report",
    "scan_catalog_table",
    "scan_warehouse_table",
    "search",
    "search_two_pass",
    "subjects_from",
    "update_by_row_match",
    "update_script",
    "warehouse_columns",
    "write_hits",
]
