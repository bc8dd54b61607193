"""Queries of the llm operators: name -> callable(spark, sf_dir), and their SQL."""

from __future__ import annotations

from cadenza.llm import encode, nearest, packing, percentiles, sentences
from cadenza.sources.tables import table


def _ids(tokenizer: str):
    return lambda spark, sf_dir: encode.encode_texts(table(spark, sf_dir, "documents"), "doc_id", "text", tokenizer)


def queries() -> dict:
    return {
        "p1_found": nearest.found,
        "p5_percentiles": percentiles.all_percentiles,
        # the ways of hot keys, which small tables hardly have: the same results with low thresholds
        "salted_buckets": lambda s, d: nearest.words(s, d, hot_rows=100, slice_rows=20_000).where("trans_id IS NOT NULL"),
        "followed_digits": lambda s, d: percentiles.all_percentiles(s, d, hot_rows=50),
        "p5_combined_days": percentiles.combined_days,
        "p5_combined_parts": percentiles.combined_parts,
        "p6_ids": _ids("byte_bpe_50k"),
        "p6_ids_multi": _ids("byte_bpe_multi_50k"),
        "p6_ids_words": _ids("word_bpe_49k"),
        "p6_ids_pieces": _ids("piece_bpe_32k"),
        "p6_decoded": lambda s, d: encode.decoded(table(s, d, "documents"), "byte_bpe_50k"),
        "p6_decoded_multi": lambda s, d: encode.decoded(table(s, d, "documents"), "byte_bpe_multi_50k"),
        "p7_containers": packing.containers,
        "p8_found": lambda s, d: sentences.found(table(s, d, "documents")),
        "p7_fill": lambda s, d: packing.fill(packing.containers(s, d)),
    }


def oracle_sql() -> dict[str, str]:
    return {
        "p1_found": nearest.FOUND_SQL,
        "p5_percentiles": percentiles.ALL_SQL,
        "salted_buckets": nearest.FOUND_SQL,
        "followed_digits": percentiles.ALL_SQL,
        "p5_combined_days": percentiles.COMBINED_SQL,
        "p5_combined_parts": percentiles.PARTS_SQL,
        "p6_decoded": encode.DECODED_SQL,
        "p6_decoded_multi": encode.DECODED_SQL,
    }
