"""The registered queries of this package, and their SQL where SQL can express them."""

from clickmill.llm import (
    filter_audit,
    fingerprints,
    katz,
    language,
    licenses,
    line_dedup,
    mixing,
    ngram_join,
    packing,
    prefix_trie,
    sharding,
    topk_search,
    toxicity,
)

QUERIES = {
    "op1_katz": katz.op1_katz,
    "op2_language": language.op2_language,
    "op3_fingerprints": fingerprints.op3_fingerprints,
    "op4_packing": packing.op4_packing,
    "op5_line_dedup": line_dedup.op5_line_dedup,
    "op6_licenses": licenses.op6_licenses,
    "op7_toxicity": toxicity.op7_toxicity,
    "op8_topk_search": topk_search.op8_topk_search,
    "op9_ngram_join": ngram_join.op9_ngram_join,
    "op10_mixing": mixing.op10_mixing,
    "op11_sharding": sharding.op11_sharding,
    "op12_filter_audit": filter_audit.op12_filter_audit,
    "op13_prefix_trie": prefix_trie.op13_prefix_trie,
}

SQL = {
    "op5_line_dedup": line_dedup.OP5_SQL,
    "op8_topk_search": topk_search.OP8_SQL,
    "op9_ngram_join": ngram_join.OP9_SQL,
    "op10_mixing": mixing.OP10_SQL,
    "op12_filter_audit": filter_audit.OP12_SQL,
    "op13_prefix_trie": prefix_trie.OP13_SQL,
}
