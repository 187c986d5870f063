"""The operators of this package as queries over the sample tables, with production parameters."""

from pyspark.sql import functions as F

from leafmill.llm import centroids, contamination, jaccard, language, passages, personal, pieces, quality, repair, rules, secret_scan, shards, suffixes
from leafmill.llm.common import table


def op1_kd_shards(spark, folder):
    """doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    return shards.shard(table(spark, folder, "documents"), shards=16)


def op2_decontamination(spark, folder):
    """doc_id, item_id, n_found, n_shingles, containment of the documents that hold a benchmark item."""
    return contamination.contained(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op3_language_id(spark, folder):
    """doc_id, held_out, lang_pred, score, rejected."""
    return language.identify(table(spark, folder, "documents"))


def op4_rules(spark, folder):
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, quality."""
    return rules.judge(table(spark, folder, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality")


def op5_passages(spark, folder):
    """doc_id, start, end, other_doc_id, other_start, other_end, similarity: passages of 50 words or more."""
    return passages.repeated(table(spark, folder, "documents"))


def joined_spans(spans):
    """kind:start:end of an array of spans, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def span_columns(spans, kinds):
    """A count for each base kind, the digest of the base spans, and all spans as text."""
    def of(kind):
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return [*map(of, kinds), F.sha2(joined_spans(base), 256).alias("base_sha256"), joined_spans(spans).alias("spans")]


def op6_secrets(spark, folder):
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans."""
    found = secret_scan.scan(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select("doc_id", *span_columns(F.col("secrets"), ("assign", "access", "hex")))


def op7_jaccard(spark, folder):
    """doc_id, n_shingles, component_id."""
    return jaccard.join(table(spark, folder, "documents")).drop("text_key")


def op8_sentencepiece(spark, folder):
    """doc_id, n_tokens, ids_sha256, decoded_sha256."""
    coded = pieces.encode(table(spark, folder, "documents").select("doc_id", "text"))
    return coded.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))


def op9_quality(spark, folder):
    """doc_id, held_out, score, predicted."""
    return quality.score_documents(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op10_pii(spark, folder):
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans."""
    found = personal.find(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select("doc_id", *span_columns(F.col("personal"), personal.KINDS))


def op11_centroids(spark, folder):
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256."""
    return centroids.cluster(table(spark, folder, "embeddings"), clusters=40, rounds=5)


def op12_suffixes(spark, folder):
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    return suffixes.deduplicated(table(spark, folder, "documents").select("doc_id", "text"))


def op13_repair(spark, folder):
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
    return repair.repaired(table(spark, folder, "conversations"))


QUERIES = {name: f for name, f in list(globals().items()) if name.startswith("op")}
ORACLES = {}
