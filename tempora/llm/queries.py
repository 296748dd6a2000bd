"""The operators over the given tables, one query each, and their DuckDB SQL."""

from __future__ import annotations

from tempora.llm import exact_dedup, fill_middle, language_id, mixing, packing, pii, prefix_trie, quality_cnn, simhash, substring_dedup, topk_search, toxicity, warc
from tempora.llm.common import table

QUERIES = {
    "op1_pattern_packing": lambda spark, sf_dir: packing.pack(table(spark, sf_dir, "documents")),
    "op2_language_crf": lambda spark, sf_dir: language_id.identify(table(spark, sf_dir, "documents")),
    "op3_exact_dedup": lambda spark, sf_dir: exact_dedup.exact_groups(table(spark, sf_dir, "documents")),
    "op4_quality_cnn": lambda spark, sf_dir: quality_cnn.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")),
    "op5_simhash": lambda spark, sf_dir: simhash.near_groups(table(spark, sf_dir, "documents")),
    "op9_weak_pii": lambda spark, sf_dir: pii.detect(table(spark, sf_dir, "documents")),
    "op6_warc_chain": lambda spark, sf_dir: warc.round_trip(table(spark, sf_dir, "pages")),
    "op7_mix_sources": lambda spark, sf_dir: mixing.mix_report(table(spark, sf_dir, "documents")),
    "op8_topk_search": lambda spark, sf_dir: topk_search.top_k(table(spark, sf_dir, "embeddings")),
    "op10_substring_dedup": lambda spark, sf_dir: substring_dedup.dedup(table(spark, sf_dir, "documents")).drop("repeats"),
    "op11_nb_toxicity": lambda spark, sf_dir: toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")),
    "op12_fill_middle": lambda spark, sf_dir: fill_middle.report(table(spark, sf_dir, "documents")),
    "op13_prefix_trie": lambda spark, sf_dir: prefix_trie.trie(table(spark, sf_dir, "conversations")),
}

SQL = {
    "op3_exact_dedup": exact_dedup.ORACLE.format(documents="documents"),
    "op6_warc_chain": warc.ORACLE.format(pages="pages"),
    "op7_mix_sources": mixing.ORACLE.format(documents="documents"),
    "op8_topk_search": topk_search.ORACLE.format(embeddings="embeddings"),
    "op10_substring_dedup": substring_dedup.ORACLE.format(documents="documents"),
    "op12_fill_middle": fill_middle.ORACLE.format(documents="documents"),
    "op13_prefix_trie": prefix_trie.ORACLE.format(conversations="conversations"),
}
