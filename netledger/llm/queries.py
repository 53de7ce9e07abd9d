"""Registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from netledger.llm import (bpe, chat, decontaminate, divergence, langid, neardup, quality, resample, secrets, substring, urlfilter,
                           variants, warc)
from netledger.llm.common import table
from netledger.session import work_path

Query = Callable[[SparkSession, str], DataFrame]


def vocabulary() -> str:
    """Where the installed package of public tokenizers keeps the byte-level vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    hits = decontaminate.decontaminate(documents, table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return hits.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        decontaminate.contaminated().alias("contaminated"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trained on three quarters of the documents; the rest is held out."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    model = langid.train(documents.filter(~held_out & F.col("lang").isNotNull()))
    judged = documents.select("doc_id", "text", held_out.alias("held_out"))
    return langid.identify(judged, model, keep=["doc_id", "held_out"]).select("doc_id", "held_out", "lang_pred", "score")


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.round_trip(documents, vocabulary(), keep=["doc_id"])


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents").select("doc_id", "text"), keep=["doc_id"])
    base = F.filter("secrets", lambda s: s["kind"].isin(*secrets.BASE_KINDS))

    def count(kind: str) -> Column:
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, secrets.BASE_KINDS), F.sha2(secrets.listed(base), 256).alias("base_sha256"),
                        secrets.listed(F.col("secrets")).alias("spans"))


URL_RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
             ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list: what pages of two spam sites link to, and the URLs of pages that are spam by their site or by a title full of symbols.

    A page is listed under one form of its URL and found under any; most pages with a listed host or path are not listed.
    """
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    host = urlfilter.host_of(F.col("url"))
    site = F.coalesce(host.rlike(r"(^|\.)(spam-farm|cheap-pills)\."), F.lit(False))
    title = F.regexp_extract("html", "<title>([^<]*)</title>", 1)
    noisy = F.coalesce(F.size(F.regexp_extract_all(title, F.lit("[%*#$]{3}"), 0)) >= 2, F.lit(False))
    links = F.transform(F.regexp_extract_all("html", F.lit('<a href="([^"]*)"')), lambda to: F.when(
        F.instr(to, "://") > 0, to).when(to.startswith("/"), F.concat(F.lit("http://"), host, to)))
    listed = pages.filter(site | noisy).select(F.explode(F.concat(
        F.array("url"), F.when(site & F.col("html").isNotNull(), links).otherwise(F.array().cast("array<string>")))).alias("url"))
    judged = urlfilter.filter_urls(pages.drop("html"), listed, URL_RULES, keep=["page_id"])
    return judged.select("page_id", "host", "path", "rule", "verdict")


REPLY = {"reply": {"message": ("string", True), "turn": ("integer", True)}}


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The turns as tool traffic: a user's turn is a call, the assistant's turn after it its result.

    The lengths of the texts decide which calls need the call before, the one after or both (so that some form cycles), and which
    have arguments of a wrong type, unknown or missing ones, or text that is no JSON.
    """
    turns = table(spark, sf_dir, "conversations")
    letters = F.length("text")

    def name(turn: Column) -> Column:
        return F.concat_ws(":", "conv_id", turn)

    before, behind = name(F.col("turn") - 2), name(F.col("turn") + 2)
    after = (F.when(letters % 8 == 0, F.array(behind)).when(letters % 8 == 1, F.array(before, behind))
             .when(letters % 8 <= 3, F.array(before)).otherwise(F.array().cast("array<string>")))
    message, turn, fault = F.col("text").alias("message"), F.col("turn"), letters % 5
    arguments = (F.when(fault == 0, F.to_json(F.struct(message, turn.cast("string").alias("turn"))))
                 .when(fault == 1, F.to_json(F.struct(turn, F.lit(True).alias("note"), message)))
                 .when(fault == 2, F.to_json(F.struct(turn))).when(fault == 3, F.concat_ws(" ", F.lit("turn"), turn))
                 .otherwise(F.to_json(F.struct(turn, message))))
    call = F.to_json(F.struct(F.array(F.struct(name(turn).alias("id"), F.lit("reply").alias("name"), arguments.alias("arguments"),
                                               after.alias("after"))).alias("tool_calls")))
    result = F.to_json(F.struct(name(F.col("turn") - 1).alias("tool_call_id"), F.col("text").alias("content")))
    traffic = turns.select(
        "conv_id", "turn", F.when(F.col("role") == "user", "assistant").when(F.col("role") == "assistant", "tool")
        .otherwise(F.col("role")).alias("role"),
        F.when(F.col("role") == "user", call).when(F.col("role") == "assistant", result).otherwise(F.col("text")).alias("text"))
    return chat.link_tools(traffic, REPLY)


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring.remove_repeats(documents, window=35, digest=True, keep=["doc_id"])


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neardup.near_duplicates(table(spark, sf_dir, "documents"), size=3, percent=85)
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), keep=["doc_id"])


def op10_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = resample.labelled(table(spark, sf_dir, "labels"), "quality = 1 AND toxic = 0", 100_000)
    return resample.resample(table(spark, sf_dir, "documents").select("doc_id", "text"), target, keep=["doc_id"])


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses are read with their payloads, revisits by their headers alone."""
    path = work_path(spark, "warc")
    warc.archive(table(spark, sf_dir, "pages"), path)
    responses = warc.read_warc(spark, path).filter("record_type = 'response'").select(
        "page_id", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_digest"),
        "record_type", "refers_to_page")
    revisits = warc.read_warc(spark, path, payload=False).filter("record_type = 'revisit'").select(
        "page_id", F.col("payload_length").alias("payload_bytes"), F.substring_index("payload_digest", ":", -1).alias("payload_digest"),
        "record_type", "refers_to_page")
    return responses.unionByName(revisits).select(
        F.col("page_id").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to_page").cast("long").alias("refers_to"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.spelling_variants(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_divergence(table(spark, sf_dir, "documents").select("text", "lang", "source"))


QUERIES: dict[str, Query] = {
    "op1_decontamination": op1_decontamination,
    "op2_language_id": op2_language_id,
    "op3_bpe": op3_bpe,
    "op4_secrets": op4_secrets,
    "op5_url_filter": op5_url_filter,
    "op6_chat": op6_chat,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_minhash": op8_minhash,
    "op9_quality": op9_quality,
    "op10_resampling": op10_resampling,
    "op11_warc": op11_warc,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_source_divergence": op13_source_divergence,
}
