"""The operators of this package applied to whole tables, under the names the driver reads."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import conversations, decontaminate, jaccard, languages, licences, lm, phrases, pieces, pii, rules, suffixes, token_counts, token_files
from tidewater.session import scratch_dir
from tidewater.tables import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(f):
        QUERIES[name] = lambda spark, folder: f(Tables(spark, folder))
        if sql:
            ORACLES[name] = sql
        return f

    return register


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op2_quality_rules")
def op2(t: Tables) -> DataFrame:
    return rules.quality_scores(t.documents)


@query("op4_token_files")
def op4(t: Tables) -> DataFrame:
    folder = scratch_dir(t.spark, "tokens")
    token_files.write_token_files(t.documents, folder, _tokenizer("word_bpe_49k.json"), end_id=1, by_word=True)
    return token_files.token_file_digests(t.spark, folder)


@query("op10_token_counts")
def op10(t: Tables) -> DataFrame:
    import public_tokenizers

    docs = t.documents.select("doc_id", "text").withColumn("sections", token_counts.line_sections())
    return token_counts.token_counts(docs, "sections", _tokenizer("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@query("op5_ngram_jaccard_join")
def op5(t: Tables) -> DataFrame:
    return jaccard.jaccard_components(t.documents).select("doc_id", "n_shingles", "component_id")


@query("op9_benchmark_decontamination")
def op9(t: Tables) -> DataFrame:
    return decontaminate.benchmark_matches(t.documents, t.benchmark)


@query("op6_pii")
def op6(t: Tables) -> DataFrame:
    found = pii.find_personal_data(t.documents.select("doc_id", "text"))
    counts = [F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}") for kind in pii.KINDS]  # noqa: B023  called at once
    return found.select("doc_id", *counts, F.sha2(pii.written(F.col("base")), 256).alias("base_sha256"), pii.written(F.concat("base", "terms")).alias("spans"))


@query("op8_sentencepiece")
def op8(t: Tables) -> DataFrame:
    model = _tokenizer("piece_bpe_32k.model")
    coded = pieces.decode(pieces.encode(t.documents.select("doc_id", "text"), model), model)
    # the format writes a blank as "▁", so that character itself comes back as a blank
    same = F.col("decoded") == F.translate(F.coalesce("text", F.lit("")), pieces.BLANK, " ")
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_pieces"), F.xxhash64("ids").alias("ids_hash"), same.alias("round_trip"))


@query("op3_license_scan", licences.oracle())
def op3(t: Tables) -> DataFrame:
    return licences.licence_matches(t.documents)


@query("op1_lm_scoring")
def op1(t: Tables) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    return lm.lm_scores(t.documents, held_out)


@query("op7_suffix_dedup")
def op7(t: Tables) -> DataFrame:
    return suffixes.without_repeats(t.documents).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query("op11_conversation_repair")
def op11(t: Tables) -> DataFrame:
    return conversations.audits_of_all(conversations.damaged(t.conversations), t.conversations)


@query("op12_language_id")
def op12(t: Tables) -> DataFrame:
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    docs = t.documents.select("doc_id", "text", "lang")
    found = languages.predict(docs, languages.learn(docs.where(~held_out)))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query("op13_phrase_collocations", phrases.oracle())
def op13(t: Tables) -> DataFrame:
    return phrases.collocations(t.documents.select("text", "lang"))
