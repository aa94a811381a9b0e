"""Named queries of this folder over the given tables, with their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, clustering, decontamination, extraction, fingerprints, fixity, hmm, minhash, mixing, repair, simhash, token_counts, toxicity
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return add


@query("op1_fingerprints")
def op1_fingerprints(spark, sf_dir):
    return fingerprints.fingerprint_edits(table(spark, sf_dir, "documents"))


@query("op2_mixing", mixing.TAKEN_SQL)
def op2_mixing(spark, sf_dir):
    return mixing.taken(mixing.mix_plan(table(spark, sf_dir, "documents"))).drop("draws")


@query("op3_simhash")
def op3_simhash(spark, sf_dir):
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("f"), 16, "0")).alias("fingerprint"), "component_id")


@query("op4_hmm")
def op4_hmm(spark, sf_dir):
    return hmm.score_documents(table(spark, sf_dir, "documents"))


@query("op5_decontamination")
def op5_decontamination(spark, sf_dir):
    return decontamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op6_chat")
def op6_chat(spark, sf_dir):
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", tricky), (-7, 1, "assistant", tricky)], given.schema)
    return chat.digests(chat.format_turns(given.unionByName(extra)))


@query("op7_toxicity")
def op7_toxicity(spark, sf_dir):
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op8_extraction")
def op8_extraction(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return extraction.extract(pages, extraction.train(pages))


@query("op9_fixity", fixity.AUDIT_SQL)
def op9_fixity(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    found = fixity.audit(fixity.manifest(fixity.records_of(pages)), fixity.manifest(fixity.damaged_replica(pages)))
    return found.drop("second_digest")


@query("op10_token_counts")
def op10_token_counts(spark, sf_dir, name: str = "byte_bpe_50k.json"):
    import public_tokenizers

    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(name))


@query("op11_clustering", clustering.CLUSTER_SQL)
def op11_clustering(spark, sf_dir):
    return clustering.cluster(table(spark, sf_dir, "embeddings"))


@query("op12_minhash", minhash.NEAR_SQL)
def op12_minhash(spark, sf_dir):
    found = minhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@query("op13_repair")
def op13_repair(spark, sf_dir):
    return repair.repair(repair.damaged(table(spark, sf_dir, "conversations")))
