"""The queries of this subpackage by name, with the SQL that states the same result."""

from __future__ import annotations

from sablefin.llm import codes, licenses, mixing, packing, pii, quality, ranking, secrets, simhash, tokens, topk, trie, url_lists

QUERIES = {
    "op1_mix": mixing.op1_mix,
    "op2_secrets": secrets.op2_secrets,
    "op3_quality": quality.op3_quality,
    "op4_url_lists": url_lists.op4_url_lists,
    "op5_pii": pii.op5_pii,
    "op6_pack": packing.op6_pack,
    "op7_tokens": tokens.op7_tokens,
    "op8_ranking": ranking.op8_ranking,
    "op9_simhash": simhash.op9_simhash,
    "op10_topk": topk.op10_topk,
    "op11_licenses": licenses.op11_licenses,
    "op12_codes": codes.op12_codes,
    "op13_trie": trie.op13_trie,
}
#: The others are checked by brute force in tests/llm.
ORACLE_SQL = {
    "op2_secrets": secrets.ORACLE,
    "op3_quality": quality.ORACLE,
    "op4_url_lists": url_lists.ORACLE,
    "op10_topk": topk.ORACLE,
    "op12_codes": codes.ORACLE,
    "op13_trie": trie.ORACLE,
}
