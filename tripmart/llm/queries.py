"""Registered queries of this subpackage and their SQL, where it exists."""

from __future__ import annotations

from collections.abc import Callable

from tripmart.llm import (centroid_clustering, decontamination, html_text, language_id, lexical_search, license_scan,
                          nn_descent, packing, pii, simhash_dedup, substring_dedup, suffix_dedup, url_reputation)

QUERIES: dict[str, Callable] = {
    "op1_license_scan": license_scan.op1_license_scan,
    "op2_suffix_dedup": suffix_dedup.op2_suffix_dedup,
    "op3_substring_dedup": substring_dedup.op3_substring_dedup,
    "op4_pii": pii.op4_pii,
    "op5_decontamination": decontamination.op5_decontamination,
    "op6_packing": packing.op6_packing,
    "op7_simhash_dedup": simhash_dedup.op7_simhash_dedup,
    "op8_html_text": html_text.op8_html_text,
    "op9_nn_descent": nn_descent.op9_nn_descent,
    "op10_language_id": language_id.op10_language_id,
    "op11_url_reputation": url_reputation.op11_url_reputation,
    "op12_lexical_search": lexical_search.op12_lexical_search,
    "op13_centroid_clustering": centroid_clustering.op13_centroid_clustering,
}

#: Suffix arrays, EM, SimHash, NN-descent and fitted models have no plain SQL;
#: the tests hold them against brute force.
ORACLE_SQL: dict[str, str] = {
    "op1_license_scan": license_scan.OP1_SQL,
    "op3_substring_dedup": substring_dedup.OP3_SQL,
    "op11_url_reputation": url_reputation.OP11_SQL,
    "op12_lexical_search": lexical_search.OP12_SQL,
    "op13_centroid_clustering": centroid_clustering.OP13_SQL,
}
