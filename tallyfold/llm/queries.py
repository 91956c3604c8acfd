"""The registered queries of these operators, and their SQL where SQL can say it."""

import public_tokenizers
from pyspark.sql import functions as F

from tallyfold.llm import (
    bpe,
    collocations,
    decontaminate,
    embedding_dedup,
    language_id,
    merkle,
    packing,
    quality,
    secret_scan,
    simhash,
    substring_dedup,
    toxicity,
    url_filter,
)
from tallyfold.llm.common import table
from tallyfold.llm.oracles import collocations_sql, decontamination_sql, merkle_sql

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


#: The list that `pages` is judged by.
URL_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


def vocabulary(path: str) -> str:
    """The content of a tokenizer file: a few MB, whatever the data."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def op1_bpe(spark, sf_dir):
    return bpe.encode_digests(table(spark, sf_dir, "documents"), vocabulary(WORD_BPE))


def op2_url_filter(spark, sf_dir):
    return url_filter.judge(table(spark, sf_dir, "pages"), URL_RULES)


def op3_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return language_id.identify(docs, language_id.fit(docs))


def op4_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.judge(docs.select("doc_id", "text"), model).drop("text")


def op5_packing(spark, sf_dir):
    cut_pieces = packing.pieces(table(spark, sf_dir, "documents"), vocabulary(BYTE_BPE))
    return packing.pack(cut_pieces)


def op6_simhash(spark, sf_dir):
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op7_secret_scan(spark, sf_dir):
    found = secret_scan.scan(table(spark, sf_dir, "documents"))
    digest = F.sha2("candidate", 256).alias("candidate_sha256")
    return found.select("doc_id", "place", "part", F.length("candidate").cast("long").alias("n_chars"), digest, "name", "score", "is_secret")


def op8_embedding_dedup(spark, sf_dir):
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op9_substring_dedup(spark, sf_dir):
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents"), digest=True)


def op10_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op11_collocations(spark, sf_dir):
    return collocations.mine(table(spark, sf_dir, "documents"))


def op12_decontamination(spark, sf_dir):
    return decontaminate.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_merkle(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    fields = ["doc_id", "source", "lang", "n_chars"]
    leaf = merkle.digest_of(*fields, "text")
    # Half of the texts lose their line ends; a null id leaves its row as it is.
    tampered = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    changed = F.when(tampered, merkle.digest_of(*fields, F.replace("text", F.lit("\n"), F.lit(""))))
    found = merkle.proofs(docs, leaf, changed=changed)
    root = merkle.folded(F.coalesce("changed", "leaf"), F.col("proof"))
    digests = merkle.proof_digest(F.col("proof")).alias("proof_sha256")
    found = found.select("doc_id", "leaf", "subroot", "root", digests, root.alias("folded_root"))
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))


LLM_QUERIES = {
    "op1_bpe": op1_bpe,
    "op2_url_filter": op2_url_filter,
    "op3_language_id": op3_language_id,
    "op4_quality": op4_quality,
    "op5_packing": op5_packing,
    "op6_simhash": op6_simhash,
    "op7_secret_scan": op7_secret_scan,
    "op8_embedding_dedup": op8_embedding_dedup,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_toxicity": op10_toxicity,
    "op11_collocations": op11_collocations,
    "op12_decontamination": op12_decontamination,
    "op13_merkle": op13_merkle,
}

_URL_RULES_SQL = ", ".join(f"('{entry}', '{entry.partition('/')[0]}', '/{entry.partition('/')[2]}', '{verdict}')" for verdict, entry in URL_RULES)

LLM_ORACLES: dict[str, str] = {
    "op2_url_filter": f"""
WITH urls AS (
  SELECT page_id,
    CASE WHEN strpos(url, '://') > 0 THEN translate(regexp_extract(substr(url, strpos(url, '://') + 3), '^[^/?#]*'),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
    CASE WHEN strpos(url, '://') > 0 THEN regexp_extract(substr(url, strpos(url, '://') + 3), '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path
  FROM pages),
rules(rule, rule_host, rule_path, verdict) AS (VALUES {_URL_RULES_SQL}),
fits AS (
  SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
  FROM urls JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY page_id)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM urls LEFT JOIN fits USING (page_id)""",
    "op11_collocations": collocations_sql(),
    "op12_decontamination": decontamination_sql(),
    "op13_merkle": merkle_sql(),
}
