"""The operators of this subpackage over whole tables, under the names the driver asks for."""

import corpus_pipeline
import public_tokenizers
from pyspark.sql import functions as F

from skyledger.llm import align, chat, chunkdedup, decontam, fingerprints, langid, mixing, neardup, pieces, quality, tokens, variants, warc


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_chat_formatting(spark, sf_dir):
    said = r"\### Assistant: </turn> ok"
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = rows.sparkSession.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], rows.schema)
    return chat.read_back(chat.format_chats(rows.unionByName(hard)))


def op2_source_mixing(spark, sf_dir):
    mixed = mixing.with_copies(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op3_substring_dedup(spark, sf_dir):
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    out = chunkdedup.dedup_substrings(documents)
    n_bytes, kept = F.octet_length(F.coalesce("text", F.lit(""))), F.octet_length(F.coalesce("kept_text", F.lit("")))
    return out.select(
        "doc_id", n_bytes.cast("long").alias("n_bytes"), kept.cast("long").alias("kept_bytes"), "removed_bytes", "repeated_bytes",
        "removed_spans", F.sha2(F.coalesce("kept_text", F.lit("")).cast("binary"), 256).alias("kept_sha256"),
    )


def op4_near_duplicates(spark, sf_dir):
    return neardup.near_duplicates(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_fingerprints(spark, sf_dir):
    return fingerprints.with_neighbours(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op6_decontamination(spark, sf_dir):
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontam.contaminated(documents, _table(spark, sf_dir, "benchmark"))


def op7_language_id(spark, sf_dir):
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return langid.identify(documents).select("doc_id", "held_out", "lang_pred", "score")


def op8_warc(spark, sf_dir):
    back = warc.round_trip(_table(spark, sf_dir, "pages"))
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_quality(spark, sf_dir):
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.classify(documents).select("doc_id", "weak_label", "quality", "keep")


def op10_token_counts(spark, sf_dir, tokenizer="word_bpe_49k.json"):
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = tokens.count_tokens(documents, public_tokenizers.path(tokenizer))
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


def _hex(text):
    return F.sha2(F.col(text).cast("binary"), 256)


def op11_sentencepiece(spark, sf_dir, model="piece_bpe_32k.model"):
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = pieces.encode_texts(documents, public_tokenizers.path(model))
    listed = F.array_join(F.col("ids").cast("array<string>"), ",").alias("listed")
    coded = coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), listed, "decoded")
    return coded.select("doc_id", "n_tokens", _hex("listed").alias("ids_sha256"), _hex("decoded").alias("decoded_sha256"))


def op12_cross_tokenizer_alignment(spark, sf_dir, **options):
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    aligned = align.align(documents, *paths)
    digest = F.when(F.col("n_a") == 0, "").otherwise(_hex("groups")).alias("groups_sha256")
    aligned = aligned.select("doc_id", "n_a", "n_b", "n_groups", "n_links", digest, "links")
    return align.scored(aligned, align.vocabulary_size(paths[1]), **options)


def op13_spelling_variants(spark, sf_dir, **options):
    words = variants.vocabulary(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return variants.variants(words, **options)


QUERIES = {
    "op1_chat_formatting": op1_chat_formatting,
    "op2_source_mixing": op2_source_mixing,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_near_duplicates": op4_near_duplicates,
    "op5_fingerprints": op5_fingerprints,
    "op6_decontamination": op6_decontamination,
    "op7_language_id": op7_language_id,
    "op8_warc": op8_warc,
    "op9_quality": op9_quality,
    "op10_token_counts": op10_token_counts,
    "op11_sentencepiece": op11_sentencepiece,
    "op12_cross_tokenizer_alignment": op12_cross_tokenizer_alignment,
    "op13_spelling_variants": op13_spelling_variants,
    "pipeline": corpus_pipeline.run,
}

ORACLES = {
    "op2_source_mixing": mixing.ORACLE,
    "op4_near_duplicates": neardup.ORACLE,
    "op8_warc": warc.ORACLE,
    "op13_spelling_variants": variants.ORACLE,
}
