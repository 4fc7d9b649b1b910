"""Parameters of article selection: dates, status words and key values.

Every operator takes a :class:`Rules`; ``PRODUCTION`` holds the values the
published data sets were built with, tests and the query catalog pass others.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from types import MappingProxyType
from typing import Any, Mapping

# Curation group -> column of the status view. Fixed values.
GROUP_COLUMNS: Mapping[str, str] = MappingProxyType(
    {
        "ap": "ap_status",
        "gxd": "gxd_status",
        "go": "go_status",
        "tumor": "tumor_status",
        "qtl": "qtl_status",
    }
)


@dataclass(frozen=True)
class Rules:
    # A date literal means midnight, so a timestamp later on the same day is
    # already past it.
    start_date: str
    triage_date: str
    end_date: str
    tumor_start_date: str
    # earliest "selected before" date per curation group (absent = no bound)
    group_start: Mapping[str, str] = field(default_factory=dict)

    # Status words.
    selected: tuple[str, ...] = ("Chosen", "Indexed", "Full-coded")
    not_selected: tuple[str, ...] = ("Not Routed", "Rejected")
    rejected: str = "Rejected"

    # Keys of the workflow tables.
    go_group: Any = 31576666
    go_indexed: Any = 31576673
    go_selected: tuple[Any, ...] = (31576671, 31576673, 31576674)
    go_loader: Any = 1571
    goa_creator: Any = 1575
    discard_creator: Any = 1609
    refs_only_tag: Any = 49170000
    peer_reviewed: Any = 31576687

    # which accession rows are article IDs
    logicaldb: Any = 29
    object_type: Any = 1

    supp_status: str = "ignore supp term"


# Dates of the published builds.
PRODUCTION = Rules(
    start_date="2017-01-01",
    triage_date="2017-10-31",
    end_date="2019-12-31",
    tumor_start_date="2013-07-01",
    group_start={"ap": "2015-06-01", "go": "2014-01-01"},
)

# The back-population and curation-group builds start earlier.
PRODUCTION_EARLY_START = "2016-10-01"
