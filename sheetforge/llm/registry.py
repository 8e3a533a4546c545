"""The queries of this subpackage and their SQL, by name."""

from __future__ import annotations

from . import bpe, exact_dedup, filter_audit, langid, lm, mixing, near_dedup, sharding, spelling, tiff, token_store, toxicity, warc

QUERIES = {
    "op1_sharding": sharding.op1_sharding,
    "op2_exact_dedup": exact_dedup.op2_exact_dedup,
    "op3_tiff": tiff.op3_tiff,
    "op4_token_store": token_store.op4_token_store,
    "op5_mixing": mixing.op5_mixing,
    "op6_toxicity": toxicity.op6_toxicity,
    "op7_warc": warc.op7_warc,
    "op8_near_dedup": near_dedup.op8_near_dedup,
    "op9_bpe": bpe.op9_bpe,
    "op10_langid": langid.op10_langid,
    "op11_lm": lm.op11_lm,
    "op12_filter_audit": filter_audit.op12_filter_audit,
    "op13_spelling": spelling.op13_spelling,
}
#: The others can't be expressed in SQL; tests hold them against brute force, round trips or held-out rows.
ORACLE_SQL = {
    "op1_sharding": sharding.ORACLE,
    "op2_exact_dedup": exact_dedup.ORACLE,
    "op5_mixing": mixing.ORACLE,
    "op7_warc": warc.ORACLE,
    "op8_near_dedup": near_dedup.ORACLE,
    "op12_filter_audit": filter_audit.ORACLE,
    "op13_spelling": spelling.ORACLE,
}
