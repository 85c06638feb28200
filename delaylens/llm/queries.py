"""Registered queries of the training-data operators, and the SQL that checks them."""

from pyspark.sql import functions as F

from delaylens.llm import (
    backoff, centroids, chat, decontam, divergence, extraction, languages, nbsvm, rules, simhash,
    substrings, tokens,
)
from delaylens.llm.common import id_remainder, is_held_out, table, vocabulary_path
from delaylens.session import scratch

QUERIES, ORACLES = {}, {}


def query(name, sql=None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return register


@query("op1_bpe_encoding_and_decoding")
def op1(spark, sf_dir):
    """Ids and decoded text of every document, as digests."""
    decoded = tokens.round_trip(table(spark, sf_dir, "documents"), vocabulary_path(), ["doc_id"],
                                keep_ids=False, sha="ids_sha256")
    return decoded.select("doc_id", "n_tokens", "ids_sha256",
                          F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op2_chat_formatting", chat.ORACLE)
def op2(spark, sf_dir):
    """All conversations, and one that says the template's control strings, formatted and read back."""
    probe = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.digests(chat.format_chats(rows.unionByName(probe)))


@query("op3_benchmark_decontamination", decontam.ORACLE)
def op3(spark, sf_dir):
    """Benchmark passages in every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark")).drop("text")


@query("op4_html_extraction")
def op4(spark, sf_dir):
    """Main text of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extraction.extract(pages, extraction.fit(pages)).select(
        "page_id", "url", "text", "n_chars")


@query("op5_substring_dedup", substrings.ORACLE)
def op5(spark, sf_dir):
    """Words of every document without passages that an earlier document has."""
    return substrings.digests(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op6_simhash_near_dedup")
def op6(spark, sf_dir):
    """Fingerprint and group of near copies of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.components(simhash.fingerprints(docs)).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query("op7_language_id")
def op7(spark, sf_dir):
    """Predicted language of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = languages.fit(docs)
    return languages.predict(docs.select("doc_id", "text"), model).select(
        "doc_id", is_held_out("doc_id").alias("held_out"), "lang_pred", "score", "accepted")


@query("op8_token_id_output")
def op8(spark, sf_dir):
    """Token files of all documents, read back."""
    folder = scratch(spark, "tokens")
    tokens.write_tokens(table(spark, sf_dir, "documents"), folder, vocabulary_path())
    read = tokens.read_tokens(spark, folder).select("doc_id", "start", "ids")
    return tokens.checksums(read, keep=["doc_id", "start"])


@query("op9_quality_rules")
def op9(spark, sf_dir):
    """Rule counts and verdict of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = rules.apply_stored(docs, table(spark, sf_dir, "labels"))
    return judged.select("doc_id", *rules.COUNTS, "base_failed", "kept", "anomaly")


@query("op10_quality_classifier")
def op10(spark, sf_dir):
    """Quality score of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = nbsvm.fit(docs, table(spark, sf_dir, "labels"))
    return nbsvm.score(docs, model).select(
        "doc_id", is_held_out("doc_id").alias("held_out"), "score", "predicted")


@query("op11_lm_scoring", backoff.ORACLE)
def op11(spark, sf_dir):
    """Log10 probability of every document, learnt from six of seven; scores to six decimals."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = backoff.score(docs, id_remainder("doc_id", 7) != 2)
    return scored.select(
        "doc_id", (~F.col("learnt")).alias("held_out"), "n_tokens", "n_known", "train_tokens",
        F.round("base_score", 6).alias("base_score"), F.round("score", 6).alias("score"))


@query("op12_source_divergence_audit", divergence.ORACLE)
def op12(spark, sf_dir):
    """Divergence of every source from the other sources of its language, and its leading terms."""
    return divergence.audit(table(spark, sf_dir, "documents"))


@query("op13_centroid_clustering", centroids.ORACLE)
def op13(spark, sf_dir):
    """Cluster, distance and inertia of every vector."""
    found = centroids.cluster(table(spark, sf_dir, "embeddings"))
    return found.withColumn("centroid_sha256", centroids.digest("centroid")).drop("centroid")
