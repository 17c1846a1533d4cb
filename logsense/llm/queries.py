"""The registered queries of the corpus operators, each over its whole table."""

from __future__ import annotations

from logsense.llm.brown import score_texts
from logsense.llm.audit import filter_audit
from logsense.llm.contamination import contaminated
from logsense.llm.exact import exact_duplicates
from logsense.llm.language import fit, predict
from logsense.llm.licenses import scan
from logsense.llm.merkle import merkle_proofs
from logsense.llm.minhash import MinHash, near_duplicates
from logsense.llm.packing import pack
from logsense.llm.quality import judge
from logsense.llm.shards import byte_shards
from logsense.llm.suffix import removal_digests
from logsense.llm.texts import id_crc32, read_table
from logsense.llm.tokens import read_token_files, write_token_files
from logsense.session import scratch_path


def op1_quality_rules(spark, sf_dir):
    return judge(read_table(spark, sf_dir, "documents")).drop("failed_rule")


def op2_best_fit_packing(spark, sf_dir):
    return pack(read_table(spark, sf_dir, "documents"))


def op3_decontamination(spark, sf_dir):
    return contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op4_suffix_dedup(spark, sf_dir):
    return removal_digests(read_table(spark, sf_dir, "documents"))


def op5_language_id(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    held_out = id_crc32("doc_id") % 4 == 2
    return predict(docs, fit(docs.where(~held_out)), extra={"held_out": held_out})


def op6_license_scan(spark, sf_dir):
    return scan(read_table(spark, sf_dir, "documents"))


def op7_brown_model(spark, sf_dir):
    return score_texts(read_table(spark, sf_dir, "documents"), id_crc32("doc_id") % 5 == 1)


def op8_byte_shards(spark, sf_dir):
    return byte_shards(read_table(spark, sf_dir, "documents"), 40)


def op9_minhash_dedup(spark, sf_dir):
    return near_duplicates(read_table(spark, sf_dir, "documents"), config=MinHash(shingle=3, percent=85))


def op10_token_files(spark, sf_dir):
    import public_tokenizers

    folder = scratch_path(spark, "token-ids")
    manifest = write_token_files(
        read_table(spark, sf_dir, "documents"), folder, public_tokenizers.path("word_bpe_49k.json"), end_id=2
    )
    return read_token_files(manifest, folder).select("doc_id", "start", "n_tokens", "ids_crc32")


def op11_merkle_manifest(spark, sf_dir):
    return merkle_proofs(read_table(spark, sf_dir, "documents"))


def op12_exact_dedup(spark, sf_dir):
    return exact_duplicates(spark, f"{sf_dir}/documents.parquet").drop("file", "row")


def op13_filter_audit(spark, sf_dir):
    return filter_audit(spark, f"{sf_dir}/documents.parquet", read_table(spark, sf_dir, "labels"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_quality_rules, op2_best_fit_packing, op3_decontamination, op4_suffix_dedup, op5_language_id, op6_license_scan,
        op7_brown_model, op8_byte_shards, op9_minhash_dedup, op10_token_files,
        op11_merkle_manifest, op12_exact_dedup, op13_filter_audit,
    )
}
