"""Registered queries of this subpackage, and their SQL where SQL can say it."""

from __future__ import annotations

from tallybook.llm import hard_negatives, licenses, line_dedup, merkle, near_dup, suffix_dedup
from tallybook.llm.byte_bpe import op4_byte_bpe
from tallybook.llm.licenses import op10_license_scan
from tallybook.llm.decontaminate import op5_decontaminate
from tallybook.llm.hard_negatives import op12_hard_negatives
from tallybook.llm.line_dedup import op9_line_dedup
from tallybook.llm.merkle import op13_merkle_manifest
from tallybook.llm.near_dup import op2_minhash_near_dup
from tallybook.llm.pii import op6_pii
from tallybook.llm.quality import op7_quality_rules
from tallybook.llm.secrets import op8_secret_scan
from tallybook.llm.sharding import op11_sharding
from tallybook.llm.suffix_dedup import op1_suffix_dedup
from tallybook.llm.token_counts import op3_token_counts

QUERIES = {f.__name__: f for f in (
    op1_suffix_dedup, op2_minhash_near_dup, op3_token_counts, op4_byte_bpe, op5_decontaminate,
    op6_pii, op7_quality_rules, op8_secret_scan, op9_line_dedup, op10_license_scan,
    op11_sharding, op12_hard_negatives, op13_merkle_manifest)}

ORACLE: dict[str, str] = {
    "op1_suffix_dedup": suffix_dedup.ORACLE,
    "op2_minhash_near_dup": near_dup.ORACLE,
    "op9_line_dedup": line_dedup.ORACLE,
    "op10_license_scan": licenses.oracle(),
    "op12_hard_negatives": hard_negatives.ORACLE,
    "op13_merkle_manifest": merkle.ORACLE,
}
