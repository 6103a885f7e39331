"""Queries of this subpackage and, where SQL can express them, their oracles."""

from __future__ import annotations

from .clustering import OP12_SQL, op12_centroid_clustering
from .codes import OP11_SQL, op11_vector_codes
from .decontaminate import OP4_SQL, op4_benchmark_decontamination
from .languages import op13_language_id
from .licenses import OP9_SQL, op9_license_scan
from .packing import op7_best_fit_packing
from .pii import op3_pii_surrogates
from .quality import op5_quality_classifier
from .secrets import op1_secret_scan
from .simhash import op2_simhash_near_dedup
from .token_counts import op8_token_counts
from .topk import OP6_SQL, op6_exact_topk
from .toxicity import op10_toxicity

QUERIES = {
    "op1_secret_scan": op1_secret_scan,
    "op2_simhash_near_dedup": op2_simhash_near_dedup,
    "op3_pii_surrogates": op3_pii_surrogates,
    "op4_benchmark_decontamination": op4_benchmark_decontamination,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_exact_topk": op6_exact_topk,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op8_token_counts": op8_token_counts,
    "op9_license_scan": op9_license_scan,
    "op10_toxicity": op10_toxicity,
    "op11_vector_codes": op11_vector_codes,
    "op12_centroid_clustering": op12_centroid_clustering,
    "op13_language_id": op13_language_id,
}

ORACLES: dict[str, str] = {
    "op4_benchmark_decontamination": OP4_SQL,
    "op6_exact_topk": OP6_SQL,
    "op9_license_scan": OP9_SQL,
    "op11_vector_codes": OP11_SQL,
    "op12_centroid_clustering": OP12_SQL,
}
