"""Settings of a request run, and the size limits that pick a join strategy."""

from __future__ import annotations

from dataclasses import dataclass, fields, replace

from pyspark.sql import DataFrame

# Names and labels that settings files, reports and reviewers use.
LAKE = "DataLake"
WAREHOUSE = "Redshift"
FLAG_ERASE = "Y"
FLAG_KEEP = "N"
NO_DATA = "no_data"
NO_TIME = "no_time"
REPORT_FIRST_COLUMNS = ("Source", "Table Name")
FLAG_COLUMN = "update_flag"
CONTROL_COLUMNS = ("update_flag", "Unnamed: 0", "Table Name", "Source")
REQUEST_KEY = "given_email"
SETTING_KEYS = {
    "default_map_column": "link_phrase",
    "candidate_key_columns": "key_fragments",
    "search_phrase": "search_phrase",
}


@dataclass(frozen=True)
class Settings:
    """What counts as personal data, by fragments of names.

    ``link_phrase`` marks columns that hold the person's address, ``key_fragments``
    mark columns whose values lead to further tables, ``search_phrase`` marks tables
    with personal data. ``exclude_keys`` are columns that must not link people
    (``nationkey`` would link everybody in a country); none by default.
    """

    link_phrase: str = "email"
    key_fragments: tuple[str, ...] = ("key", "id", "hash")
    search_phrase: str = "pii"
    exclude_keys: frozenset[str] = frozenset()

    @classmethod
    def from_key_values(cls, pairs: DataFrame) -> "Settings":
        """Settings from ``(key, items)`` rows; keys that are not settings are ignored."""
        rows = pairs.where(pairs["key"].isin(list(SETTING_KEYS))).collect()
        found = {}
        for row in rows:  # at most one row per known setting
            name = SETTING_KEYS[row["key"]]
            found[name] = tuple(row["items"]) if name == "key_fragments" else row["items"][0]
        return replace(cls(), **found)


@dataclass(frozen=True)
class Limits:
    """Bounds that are checked against measured sizes before a strategy is taken.

    ``driver_rows``: search values are kept on the driver only when their number is bounded
    by this beforehand; otherwise they are written to the shared folder. ``literal_pairs``: up
    to this many search values per table go into the scan's own filter. ``broadcast_bytes`` / ``broadcast_rows``: a lookup side is broadcast only when
    it was measured to be below both. Beyond them the join shuffles, and keys with more than
    ``1 / max_hot_keys`` of all rows are spread over ``salts`` tasks each.
    ``tables_per_job``: how many table probes of a pass run side by side, at most (8 are the most in any case).
    """

    driver_rows: int = 20_000
    literal_pairs: int = 1_000
    broadcast_bytes: int = 64 * 1024 * 1024
    broadcast_rows: int = 1_000_000
    max_hot_keys: int = 1_000
    salts: int = 32
    tables_per_job: int = 64

    def __post_init__(self):
        for field in fields(self):
            if getattr(self, field.name) < 0:
                raise ValueError(f"{field.name} must not be negative")
