"""The registered queries of this package: each operator over its whole table."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from folia.llm import (
    flatgraph,
    language,
    oracles,
    packing,
    pairindex,
    pieces,
    pii,
    prefixtrie,
    setjoin,
    sharding,
    spelling,
    suffixes,
    tokenfiles,
    vectortree,
)
from folia.llm.frames import with_text


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_flat_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatgraph.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op2_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


def op3_chosen_path_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    grouped = setjoin.similar_documents(_table(spark, sf_dir, "documents"))
    return grouped.select("doc_id", "class_id", "n_links", "kept")


def op4_merge_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return pieces.encode_pieces(docs, public_tokenizers.path("piece_bpe_32k.model"))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = language.train(docs)
    found = language.identify(docs.select("doc_id", "text"), model)
    return found.select(
        "doc_id",
        language.held_out().alias("held_out"),
        "lang_pred",
        F.col("lang_score").alias("score"),
        F.col("lang_rejected").alias("rejected"),
    )


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return tokenfiles.token_files(docs, public_tokenizers.path("word_bpe_49k.json"))


def op7_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffixes.without_repeats(_table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op8_vector_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return vectortree.nearest_vectors(vectors, F.col("vec_id") % 20 == 0)


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_text(_table(spark, sf_dir, "documents"))
    found = pii.find(docs, pii.train(docs))
    counts = [F.col(f"pii.n_{kind}").alias(f"n_{kind}") for kind in pii.KINDS]
    base = pii.digest(F.col("pii.base")).alias("base_sha256")
    return found.select("doc_id", *counts, base, F.col("pii.spans").alias("spans"))


def op11_position_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    grouped = spelling.spelling_groups(_table(spark, sf_dir, "documents"))
    return grouped.select("word", "form", "root", "n", "n_near", "form_n")


def op12_pair_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    encoded = pairindex.encode(_table(spark, sf_dir, "documents"), path)
    return pairindex.digests(pairindex.decode(encoded, path))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixtrie.prefix_trie(_table(spark, sf_dir, "conversations"), prefixtrie.Heads())


def op9_balanced_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = sharding.balanced_shards(_table(spark, sf_dir, "documents"), 8)
    return shards.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


QUERIES = {
    "op1_flat_graph": op1_flat_graph,
    "op2_vector_packing": op2_vector_packing,
    "op3_chosen_path_join": op3_chosen_path_join,
    "op4_merge_dropout": op4_merge_dropout,
    "op5_language": op5_language,
    "op6_token_files": op6_token_files,
    "op7_repeated_strings": op7_repeated_strings,
    "op8_vector_tree": op8_vector_tree,
    "op9_balanced_shards": op9_balanced_shards,
    "op10_personal_data": op10_personal_data,
    "op11_position_index": op11_position_index,
    "op12_pair_index": op12_pair_index,
    "op13_prefix_trie": op13_prefix_trie,
}

ORACLES: dict[str, str] = {
    "op11_position_index": oracles.POSITION_INDEX,
    "op13_prefix_trie": oracles.PREFIX_TRIE,
}
