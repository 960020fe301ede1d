"""The queries ``opN_<name>``: each operator over its whole table, digest columns derived."""

from __future__ import annotations

from pyspark.sql import functions as F

from wiretable.llm.alignment import align
from wiretable.llm.conversations import reply_ordered
from wiretable.llm.decontaminate import decontaminate
from wiretable.llm.frames import fold, scratch_folder, sha, table
from wiretable.llm.language_id import identify
from wiretable.llm.language_model import score_documents
from wiretable.llm.oracles import ORACLES  # noqa: F401
from wiretable.llm.quality import judge
from wiretable.llm.secrets import scan
from wiretable.llm.sentencepiece_codec import MARK, encode
from wiretable.llm.simhash import near_duplicates
from wiretable.llm.spelling import group_variants
from wiretable.llm.substring_dedup import drop_repeats
from wiretable.llm.token_files import read_tokens, write_tokens
from wiretable.llm.toxicity import score_toxicity


def _listed(spans):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op1_secrets(spark, sf_dir):
    found = scan(table(spark, sf_dir, "documents"))

    def of(*kinds):
        return F.filter("spans", lambda s: s["kind"].isin(*kinds))

    base = of("assign", "access", "hex")
    counts = [F.size(of(k)).cast("bigint").alias(f"n_{k}") for k in ("assign", "access", "hex")]
    return found.select("doc_id", *counts, sha(_listed(base)).alias("base_sha256"), _listed(F.col("spans")).alias("spans"))


def op2_simhash(spark, sf_dir):
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op3_quality(spark, sf_dir):
    return judge(table(spark, sf_dir, "documents")).drop("char_distance", "word_distance")


def op4_language_id(spark, sf_dir):
    found = identify(table(spark, sf_dir, "documents"))
    return found.select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "lang_pred", "score", "ambiguous")


def op5_substring_dedup(spark, sf_dir):
    return drop_repeats(table(spark, sf_dir, "documents"))


def op6_toxicity(spark, sf_dir):
    found = score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
                        (F.col("score") >= 0.5).cast("int").alias("predicted"), F.size("passages").alias("n_passages"))


def op7_language_model(spark, sf_dir):
    return score_documents(table(spark, sf_dir, "documents"))


def op8_decontaminate(spark, sf_dir):
    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
                        sha(F.array_join("items", ",")).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


def op9_sentencepiece(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", "text")
    # What decoding has to give: the text, with the mark read as a blank.
    want = sha(F.translate(F.coalesce("text", F.lit("")), MARK, " "))
    found = encode(rows.withColumn("want", want), with_ids=False, with_digests=True, carry=True)
    return found.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256",
                        (F.col("decoded_sha256") == F.col("row.want")).alias("round_trip"))


def op10_quotations(spark, sf_dir):
    found = reply_ordered(table(spark, sf_dir, "conversations"))
    return found.select("conv_id", "thread", "turn", "depth", "parent", "role", sha(F.col("formatted")).alias("formatted_sha256"))


def op11_spelling(spark, sf_dir):
    found = group_variants(table(spark, sf_dir, "documents"))
    return found.select("word", "form", "root", "n", "n_near", "form_n")


def op12_token_files(spark, sf_dir):
    folder = scratch_folder(spark)
    write_tokens(table(spark, sf_dir, "documents"), folder)
    return read_tokens(spark, folder, with_ids=False, with_crc=True)


def op13_alignment(spark, sf_dir):
    return align(table(spark, sf_dir, "documents"), with_groups=False, with_digests=True)


QUERIES = {f.__name__: f for f in (
    op1_secrets, op2_simhash, op3_quality, op4_language_id, op5_substring_dedup, op6_toxicity, op7_language_model,
    op8_decontaminate, op9_sentencepiece, op10_quotations, op11_spelling, op12_token_files, op13_alignment)}
