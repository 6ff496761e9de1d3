"""The registered queries of these operators, and their SQL where there is any."""

from string import ascii_lowercase, ascii_uppercase

import public_tokenizers

from pyspark.sql import functions as F

from newsloom.llm import embedding_links, language_model, licenses, line_rules, merkle, oracles, packing, phrases, piece_dropout, secrets, sharding, simhash, subword_classifier, token_counts

QUERIES = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_recurrent_scores(spark, sf_dir):
    return language_model.language_scores(_table(spark, sf_dir, "documents"))


@query
def op2_line_rules(spark, sf_dir):
    return line_rules.quality_rules(_table(spark, sf_dir, "documents"))


@query
def op3_token_counts(spark, sf_dir):
    return token_counts.token_counts(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op4_secret_owners(spark, sf_dir):
    return secrets.secret_scan(_table(spark, sf_dir, "documents"))


@query
def op5_jump_shards(spark, sf_dir):
    return sharding.shard_rows(_table(spark, sf_dir, "documents"))


@query
def op7_simhash_balls(spark, sf_dir):
    return simhash.simhash_components(_table(spark, sf_dir, "documents"))

@query
def op6_neighbour_packing(spark, sf_dir):
    pieces = packing.packed(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query
def op8_subword_quality(spark, sf_dir):
    documents = _table(spark, sf_dir, "documents")
    model = subword_classifier.train(documents, _table(spark, sf_dir, "labels"))
    return subword_classifier.quality_scores(documents, model)

@query
def op9_merge_dropout(spark, sf_dir):
    coded = piece_dropout.with_dropped_merges(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return coded.select(
        "doc_id", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"),
        (F.col("decoded") == F.col("text")).alias("lossless"))


@query
def op10_itq_links(spark, sf_dir):
    return embedding_links.linked_vectors(_table(spark, sf_dir, "embeddings"))


@query
def op11_manifest_layout(spark, sf_dir):
    changes = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    lowered = F.when(changes, F.translate("text", ascii_uppercase, ascii_lowercase)).otherwise(F.col("text"))
    return merkle.merkle_proofs(_table(spark, sf_dir, "documents"), changed={"text": lowered})


@query
def op12_phrase_index(spark, sf_dir):
    return phrases.collocations(_table(spark, sf_dir, "documents"))


@query
def op13_license_diagonals(spark, sf_dir):
    found = licenses.license_scan(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


ORACLES = oracles.ORACLES
