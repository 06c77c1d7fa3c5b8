"""The registered queries of this subpackage and the SQL of those that SQL can express."""

from silverloom.llm import ann, bpe, dialogue, jaccard, licenses, lines, mixing, pii, runs, shards
from silverloom.llm import token_counts, token_ids, urls

QUERIES = {
    "op1_ngram_jaccard": jaccard.op1_ngram_jaccard,
    "op1_ngram_links": jaccard.op1_ngram_links,
    "op2_token_ids": token_ids.op2_token_ids,
    "op3_pii": pii.op3_pii,
    "op4_nearest": ann.op4_nearest,
    "op5_token_counts": token_counts.op5_token_counts,
    "op6_mixing": mixing.op6_mixing,
    "op7_byte_bpe": bpe.op7_byte_bpe,
    "op8_url_filters": urls.op8_url_filters,
    "op9_sharding": shards.op9_sharding,
    "op10_quality_rules": lines.op10_quality_rules,
    "op10_clean_texts": lines.op10_clean_texts,
    "op11_license_scan": licenses.op11_license_scan,
    "op12_dialogue_repair": dialogue.op12_dialogue_repair,
    "op13_periodic_runs": runs.op13_periodic_runs,
}

SQL = {**urls.SQL, **lines.SQL, **licenses.SQL, **dialogue.SQL}
