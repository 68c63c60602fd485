"""The registered queries of this subpackage, and their DuckDB statements where SQL can say
what they return."""

from __future__ import annotations

from ontime_spark.llm import (bpe, ctw, decontaminate, html_extract, language_id, license_rules,
                              line_dedup, merkle, near_dedup, periodic_runs,
                              quality_rules, suffix_dedup, warc)

QUERIES = {
    "op1_ctw_score": ctw.op1_ctw_score,
    "op2_html_text": html_extract.op2_html_text,
    "op3_line_dedup": line_dedup.op3_line_dedup,
    "op4_minhash_near_dedup": near_dedup.op4_minhash_near_dedup,
    "op5_language_id": language_id.op5_language_id,
    "op6_warc": warc.op6_warc,
    "op7_quality_rules": quality_rules.op7_quality_rules,
    "op8_byte_bpe": bpe.op8_byte_bpe,
    "op9_license_scan": license_rules.op9_license_scan,
    "op10_decontamination": decontaminate.op10_decontamination,
    "op11_suffix_dedup": suffix_dedup.op11_suffix_dedup,
    "op12_merkle_manifest": merkle.op12_merkle_manifest,
    "op13_periodic_runs": periodic_runs.op13_periodic_runs,
}

SQL: dict[str, str] = {**near_dedup.SQL, **warc.SQL, **license_rules.SQL, **decontaminate.SQL,
                       **merkle.SQL}
