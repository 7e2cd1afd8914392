"""One query per operator over its whole table; ``QUERIES`` maps its name to ``(spark, sf_dir) -> DataFrame``."""

import public_tokenizers
from pyspark.sql import functions as F

from ..session import use_utc
from . import bpe, chat, filter_audit, ngram_join, packing, quality, secret_scan, sharding, simhash, token_count, topk, warc, whitening
from .columns import table

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")

QUERIES = {}


def query(build):
    def run(spark, sf_dir):
        return build(use_utc(spark), sf_dir)

    run.__doc__ = build.__doc__
    QUERIES[build.__name__] = run
    return run


@query
def op2_uniform_shards(spark, sf_dir):
    """All documents in 40 random shards whose sizes differ by one row at most."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    text = F.coalesce(F.col("text"), F.lit(""))
    return sharding.uniform_shards(docs, 40).select(
        "doc_id", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query
def op3_chat_format(spark, sf_dir):
    """All conversations, and one whose texts hold control strings, read back from their training strings."""
    own = spark.createDataFrame(
        [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")],
        "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    formatted = chat.format_conversations(rows)
    read = formatted.select(
        "conv_id", F.length("formatted").cast("long").alias("formatted_chars"),
        chat.parsed_turns(F.col("formatted")).alias("turns"), chat.masked_text(F.col("segments")).alias("loss"))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"), F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")


@query
def op4_secret_scan(spark, sf_dir):
    """Known secrets and random strings in every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secret_scan.scan(docs.select("doc_id", "text")).select("doc_id", "known", "spans")

    def count_of(kind, spans="known"):
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id", *[count_of(kind).alias(f"n_{kind}") for kind, *_ in secret_scan.KINDS],
        F.sha2(secret_scan.written(F.col("known")), 256).alias("base_sha256"),
        secret_scan.written(F.col("spans")).alias("spans"), count_of(secret_scan.RANDOM, "spans").alias("n_random"))


@query
def op5_quality_rules(spark, sf_dir):
    """Counts of every document and the verdict of the cascade."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    failed = (F.col("n_words") < 20) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 30)
    return quality.judged(docs, measures=names).select(
        "doc_id", *names, failed.alias("base_failed"), "kept")


@query
def op6_bpe(spark, sf_dir):
    """Every document encoded, and decoded from its ids."""
    ids = bpe.encoded(table(spark, sf_dir, "documents").select("doc_id", "text"), TOKENIZER).select("doc_id", "ids")
    return bpe.decoded(ids, TOKENIZER).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op8_packing(spark, sf_dir):
    """All documents in sequences of 2048 tokens at most."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.packed(docs, TOKENIZER).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query
def op9_token_count(spark, sf_dir):
    """Token numbers of every document."""
    size = F.octet_length(F.coalesce(F.col("text"), F.lit(""))).cast("long")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", size.alias("n_bytes"))
    return token_count.counted(docs, TOKENIZER).select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 512).alias("over_limit"))


@query
def op7_simhash(spark, sf_dir):
    """The near-duplicate component of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = simhash.near_duplicates(docs)
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op1_warc(spark, sf_dir):
    """All pages written as records of archives, read back in byte ranges."""
    manifest = warc.write_archives(table(spark, sf_dir, "pages"), warc.archive_folder(spark))
    return warc.read_archives(manifest, payloads=False).select(
        F.col("key").cast("long").alias("page_id"), "payload_bytes", F.col("digest").alias("payload_digest"),
        F.col("type").alias("record_type"), F.col("refers_to").cast("long").alias("refers_to"))


@query
def op10_top_k(spark, sf_dir):
    """The ten highest products of every hundredth vector with all others."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), lambda i: i % 100 == 0)


@query
def op11_filter_audit(spark, sf_dir):
    """Five filters over all documents in each of their 120 orders."""
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op12_whitening(spark, sf_dir):
    """The first four whitened components of every vector."""
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


@query
def op13_ngram_join(spark, sf_dir):
    """The component of every document under links of three-word Jaccard similarity from 0.9 on."""
    return ngram_join.linked_documents(table(spark, sf_dir, "documents"))
