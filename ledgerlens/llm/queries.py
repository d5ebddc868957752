"""The queries of this package: name -> ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from ledgerlens.llm import (byte_bpe, embeddings, jaccard, language, main_text, packing, pii, quality, ranking, repair,
                            secrets, shallot, warc)
from ledgerlens.llm.shared import table

QUERIES = {
    "op1_surrogates": lambda spark, sf: pii.with_surrogates(table(spark, sf, "documents").select("doc_id", "text")),
    "op2_main_text": lambda spark, sf: main_text.extract(table(spark, sf, "pages")),
    "op3_pack": lambda spark, sf: packing.pack(table(spark, sf, "documents")),
    "op4_jaccard": lambda spark, sf: jaccard.linked(table(spark, sf, "documents")),
    "op5_cover_tree": lambda spark, sf: embeddings.near_duplicates(table(spark, sf, "embeddings")),
    "op6_secrets": lambda spark, sf: secrets.secret_digests(table(spark, sf, "documents")),
    "op7_language": lambda spark, sf: language.held_out_languages(table(spark, sf, "documents")),
    "op8_repair": lambda spark, sf: repair.grammar_digests(table(spark, sf, "documents")),
    "op9_byte_bpe": lambda spark, sf: byte_bpe.encoding_digests(table(spark, sf, "documents")),
    "op10_llr_quality": lambda spark, sf: quality.quality_rules(table(spark, sf, "documents"), table(spark, sf, "labels")),
    "op11_shallot": lambda spark, sf: shallot.clusters(table(spark, sf, "embeddings")),
    "op12_warc_index": lambda spark, sf: warc.archived(table(spark, sf, "pages")),
    "op13_lemp": lambda spark, sf: ranking.ranked(table(spark, sf, "documents"), table(spark, sf, "benchmark")),
}

ORACLE = {
    "op5_cover_tree": embeddings.ORACLE_SQL,
    "op6_secrets": secrets.ORACLE_SQL,
    "op11_shallot": shallot.ORACLE_SQL,
    "op12_warc_index": warc.ORACLE_SQL,
    "op13_lemp": ranking.ORACLE_SQL,
}
