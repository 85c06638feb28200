"""From raw documents to token ids: five stages, each written and read again by the next.

Quality rules drop documents they reject; of each group of near copies one document stays; passages
of 50 words that an earlier document has are cut out; documents with a benchmark passage are dropped;
the rest is encoded. All stages but the last return the columns of ``documents``; other columns pass
through whatever their names. Empty tables give empty tables.
"""

from pyspark.sql import DataFrame, functions as F

from delaylens.llm import decontam, rules, simhash, substrings, tokens
from delaylens.llm.common import stored, table, vocabulary_path

#: SQL has no isolation forest or byte-pair encoding; tests compare with a brute-force version.
ORACLE_SQL = None


def aside(stage):
    """Run a stage with all columns but doc_id and text under names that clash with nothing."""
    def run(spark, docs, sf_dir):
        hidden = [n if n in ("doc_id", "text") else f"c{i}__" for i, n in enumerate(docs.columns)]
        out = stage(spark, docs.toDF(*hidden), sf_dir)
        return out.select(*[F.col(h).alias(n) for h, n in zip(hidden, docs.columns)])
    return run


@aside
def quality_rules(spark, docs, sf_dir):
    return rules.apply(docs, table(spark, sf_dir, "labels")).where("kept")


@aside
def simhash_near_dedup(spark, docs, sf_dir):
    return simhash.keep_one(docs)


def substring_dedup(spark, docs, sf_dir):
    out = aside(lambda s, d, _: substrings.remove_repeats(d))(spark, docs, sf_dir)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if (
        "n_chars" in docs.columns) else out


@aside
def benchmark_decontamination(spark, docs, sf_dir):
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark")).where("NOT contaminated")


def bpe_encoding(spark, docs, sf_dir) -> DataFrame:
    """``doc_id, n_tokens, ids, ids_sha256, decoded_sha256`` of every document."""
    decoded = tokens.round_trip(docs, vocabulary_path(), ["doc_id"], sha="ids_sha256")
    return decoded.select("doc_id", "n_tokens", "ids", "ids_sha256",
                          F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", simhash_near_dedup),
    ("substring dedup", substring_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("BPE encoding and decoding", bpe_encoding),
]


def run(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for at, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES) - 1:
            docs = stored(docs, f"stage{at}", free=True)
    return docs
