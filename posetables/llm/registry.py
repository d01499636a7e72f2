"""The queries of this subpackage, by name."""

from __future__ import annotations

from . import alignment, bpe, decontaminate, license, linedup, lm, pii, quality, repair, secrets, simhash, suffixes, toxicity

QUERIES = {
    "op1_secret_scan": secrets.op1_secret_scan,
    "op2_line_dedup": linedup.op2_line_dedup,
    "op3_license_scan": license.op3_license_scan,
    "op4_toxicity": toxicity.op4_toxicity,
    "op5_lm_score": lm.op5_lm_score,
    "op6_simhash": simhash.op6_simhash,
    "op7_pii": pii.op7_pii,
    "op8_bpe": bpe.op8_bpe,
    "op9_quality_rules": quality.op9_quality_rules,
    "op10_decontaminate": decontaminate.op10_decontaminate,
    "op11_suffix_dedup": suffixes.op11_suffix_dedup,
    "op12_token_alignment": alignment.op12_token_alignment,
    "op13_conversation_repair": repair.op13_conversation_repair,
}

ORACLE_SQL: dict[str, str] = {"op1_secret_scan": secrets.OP1_SQL, "op9_quality_rules": quality.OP9_SQL}
