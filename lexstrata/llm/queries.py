"""The pN_ queries of this subpackage and, where SQL can express one, its SQL for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import p1_format_copies as p1
from . import p2_cross_split as p2
from . import p3_personal as p3
from . import p4_pieces as p4
from . import p5_near_copies as p5
from . import p6_same_look as p6
from . import p7_encode as p7
from . import p8_leaks as p8
from . import p9_residue as p9

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {
    "p1_found": p1.p1_found,
    "p1_groups": p1.p1_groups,
    "p2_found": p2.p2_found,
    "p2_report": p2.p2_report,
    "p3_found": p3.p3_found,
    "p3_redacted": p3.p3_redacted,
    "p4_found": p4.p4_found,
    "p4_pieces": p4.p4_pieces,
    "p5_found": p5.p5_found,
    "p5_groups": p5.p5_groups,
    "p6_found": p6.p6_found,
    "p6_canonical": p6.p6_canonical,
    "p7_ids": p7.p7_ids,
    "p8_found": p8.p8_found,
    "p8_items": p8.p8_items,
    "p9_found": p9.p9_found,
    "p9_clean": p9.p9_clean,
}
