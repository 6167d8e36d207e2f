"""Registered queries of this subpackage and, where SQL can express one, its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .decontaminate import OP12_SQL, op12_decontaminate
from .licenses import OP7_SQL, op7_license_scan
from .lines import op6_line_dedup
from .mixing import op4_mix_sources
from .nearest import OP10_SQL, op10_hilbert_neighbours
from .orchard import OP13_SQL, op13_orchard_clusters
from .packing import op3_best_fit_packing
from .paragraphs import op8_paragraph_minhash
from .quality import OP2_SQL, op2_quality_rules
from .simhash import op9_simhash_near_dedup
from .tokens import op5_token_frames
from .whitening import op11_whiten
from .wrappers import OP1_SQL, op1_html_wrappers

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_html_wrappers,
        op2_quality_rules,
        op3_best_fit_packing,
        op4_mix_sources,
        op5_token_frames,
        op6_line_dedup,
        op7_license_scan,
        op8_paragraph_minhash,
        op9_simhash_near_dedup,
        op10_hilbert_neighbours,
        op11_whiten,
        op12_decontaminate,
        op13_orchard_clusters,
    )
}

ORACLE: dict[str, str] = {
    "op1_html_wrappers": OP1_SQL,
    "op2_quality_rules": OP2_SQL,
    "op7_license_scan": OP7_SQL,
    "op10_hilbert_neighbours": OP10_SQL,
    "op12_decontaminate": OP12_SQL,
    "op13_orchard_clusters": OP13_SQL,
}
