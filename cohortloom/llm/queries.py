"""Registered queries of the operators: each applies one to its whole table with production parameters."""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.llm import bpe, chat, decontaminate, langid, lattice, linefreq, merkle, pii, prefixtrie, quality, simhash, suffixes, wrapper
from cohortloom.llm.common import read

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def documents(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    return read(spark, sf_dir, "documents").select("doc_id", "text", *more)


def fold(n: int) -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % n


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = bpe.encode_decode(documents(spark, sf_dir), TOKENIZER)
    return made.select("doc_id", "n_tokens", F.sha2("ids_packed", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op2_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = linefreq.line_rules(documents(spark, sf_dir, "source"), keep_text=False)
    return made.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_removed_lines", "n_left_words")


def op3_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrapper.extract(read(spark, sf_dir, "pages").select("page_id", "url", "html")).select("page_id", "url", "text", "n_chars")


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = suffixes.dedup(documents(spark, sf_dir))
    return made.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = decontaminate.decontaminate(documents(spark, sf_dir), read(spark, sf_dir, "benchmark"))
    ids = F.array_join("item_ids", ",")
    return made.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"), F.sha2(ids.cast("binary"), 256).alias("items_sha256"), "contaminated")


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.repair(read(spark, sf_dir, "conversations"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = documents(spark, sf_dir), read(spark, sf_dir, "labels")
    learn = fold(5) != 0
    made = quality.classify(docs, docs.filter(learn), labels.filter(learn))
    return made.select("doc_id", (fold(5) == 0).alias("held_out"), "score", "predicted")


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "lang")
    made = langid.identify(docs.select("doc_id", "text"), docs.filter(fold(3) != 1))
    return made.select("doc_id", (fold(3) == 1).alias("held_out"), "lang_pred", "score")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    fps = documents(spark, sf_dir).select("doc_id", simhash.fingerprint(F.col("text")).alias("fp"))
    return simhash.components(fps, fp="fp").select("doc_id", "fingerprint", "component_id")


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = pii.find(documents(spark, sf_dir), keep_text=False)
    base = F.sha2(pii.as_text(F.col("base_spans")).cast("binary"), 256).alias("base_sha256")
    return made.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", base, pii.as_text(F.col("spans")).alias("spans"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefixtrie.turns_of(read(spark, sf_dir, "conversations"))
    conv = F.col("conv")
    own = F.crc32(conv.cast("string").cast("binary")) % 4
    return prefixtrie.trie(prefixtrie.rebuilt(turns, own, conv - conv % 20, 3))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    meta, text = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")], F.col("text")
    lowered = merkle.leaf(*meta, F.translate(text, ascii_uppercase, ascii_lowercase))
    start = F.when(fold(5) == 0, lowered)  # NULL where nothing is tampered with
    made = merkle.manifest(docs, merkle.leaf(*meta, text), carry={"doc_id": F.col("doc_id"), "start": start})
    folded = made.select("doc_id", "leaf", "subroot", "root", merkle.siblings_digest(F.col("path")).alias("proof_sha256"), merkle.fold(F.coalesce("start", "leaf"), F.col("path")).alias("folded_root"))
    return folded.withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    learn = fold(5) != 1
    made = lattice.score(documents(spark, sf_dir), learn, PIECES, keep_text=False)
    return made.select("doc_id", (fold(5) == 1).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


QUERIES = {f.__name__: f for f in (op1_bpe, op2_line_rules, op3_html, op4_suffix_dedup, op5_decontaminate, op6_chat, op7_quality, op8_language, op9_simhash, op10_pii, op11_prefix_trie, op12_merkle, op13_lattice)}

ORACLES: dict[str, str] = {"op2_line_rules": linefreq.ORACLE, "op4_suffix_dedup": suffixes.ORACLE, "op5_decontaminate": decontaminate.ORACLE, "op6_chat": chat.oracle(), "op11_prefix_trie": prefixtrie.oracle(), "op12_merkle": merkle.oracle()}
