"""The corpus operators as queries over the sample tables."""

from __future__ import annotations

import public_tokenizers

from martkit.llm import byte_merges, ngram_join, packed_ids, personal_data, phrases, pivot_index, quality_rules
from martkit.llm import repeated_text, shard_shuffle, source_mix, token_links, warc_chunks, window_packing
from martkit.llm.common import table

#: Public vocabulary files; the operators take any path.
BYTE_BPE, WORD_BPE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
BYTE_RANKS, PIECE_BPE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.path("piece_bpe_32k.model")


def op1_pivot_index(spark, sf):
    return pivot_index.link_vectors(table(spark, sf, "embeddings"))


def op2_packed_ids(spark, sf):
    return packed_ids.id_report(table(spark, sf, "documents"), BYTE_BPE, end_id=0)


def op3_warc_chunks(spark, sf):
    return warc_chunks.archive_report(table(spark, sf, "pages"))


def op4_personal_data(spark, sf):
    return personal_data.span_report(table(spark, sf, "documents"))


def op5_shard_shuffle(spark, sf):
    return shard_shuffle.shard_report(table(spark, sf, "documents"))


def op6_repeated_text(spark, sf):
    return repeated_text.repeat_report(table(spark, sf, "documents"))


def op7_source_mix(spark, sf):
    return source_mix.mix_report(table(spark, sf, "documents"))


def op8_window_packing(spark, sf):
    return window_packing.pack_documents(table(spark, sf, "documents"), WORD_BPE, end_id=1)


def op9_ngram_join(spark, sf):
    return ngram_join.similarity_join(table(spark, sf, "documents"))


def op10_quality_rules(spark, sf):
    docs = table(spark, sf, "documents")
    return quality_rules.judge(docs, quality_rules.fit(docs, table(spark, sf, "labels")))


def op11_phrases(spark, sf):
    return phrases.collocations(table(spark, sf, "documents"))


def op12_byte_merges(spark, sf):
    return byte_merges.merge_report(table(spark, sf, "documents"), BYTE_RANKS, public_tokenizers.PATTERN)


def op13_token_links(spark, sf):
    return token_links.link_report(table(spark, sf, "documents"), BYTE_BPE, PIECE_BPE)


QUERIES = {
    f.__name__: f
    for f in (
        op1_pivot_index, op2_packed_ids, op3_warc_chunks, op4_personal_data, op5_shard_shuffle, op6_repeated_text,
        op7_source_mix, op8_window_packing, op9_ngram_join, op10_quality_rules, op11_phrases, op12_byte_merges,
        op13_token_links,
    )
}
ORACLE_SQL = {
    "op3_warc_chunks": warc_chunks.ARCHIVE_SQL,
    "op7_source_mix": source_mix.MIX_SQL,
    "op9_ngram_join": ngram_join.JOIN_SQL,
    "op11_phrases": phrases.PHRASES_SQL,
}
