"""The queries of this subpackage and their SQL, by name."""

from __future__ import annotations

from reelsieve.llm import bpe, chaining, decontaminate, fingerprints, license_scan, line_dedup, merkle, quality, simhash, suffix_dedup, token_counts, url_filter, whitening

QUERIES = {
    "op1_suffix_dedup": (suffix_dedup.query, None),
    "op2_url_filter": (url_filter.query, url_filter.ORACLE),
    "op3_chaining": (chaining.query, None),
    "op4_simhash": (simhash.query, None),
    "op5_license_scan": (license_scan.query, None),
    "op6_bpe": (bpe.query, None),
    "op7_token_counts": (token_counts.query, None),
    "op8_quality": (quality.query, quality.ORACLE),
    "op9_line_dedup": (line_dedup.query, line_dedup.ORACLE),
    "op10_decontaminate": (decontaminate.query, decontaminate.ORACLE),
    "op11_merkle_manifest": (merkle.query, merkle.ORACLE),
    "op12_whitening": (whitening.query, None),
    "op13_fingerprints": (fingerprints.query, None),
}


def queries() -> dict:
    return {k: q for k, (q, _) in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: s for k, (_, s) in QUERIES.items() if s}
