"""One registered query per operator, and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forumshift.llm import (
    chat, collocations, decontaminate, embeddings, licenses, lm_score, minhash, packing, pii, quality, repair, substrings, token_store)
from forumshift.llm.oracle import ORACLE


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return minhash.near_duplicates(docs, width=2, percent=80).drop("cls")


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.overlaps(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), window=10)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lm_score.score(_table(spark, sf_dir, "documents"))
    per_word = F.when(F.col("n_words") > 0, F.col("log_likelihood") / F.col("n_words")).otherwise(0.0)
    return found.withColumn("per_word", per_word)


def held_out(doc_id):
    """One document in five, by its id: never learned from (rows without an id are in no fifth)."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def quality_model(spark: SparkSession, sf_dir: str, docs: DataFrame) -> quality.Model:
    return quality.fit(docs, _table(spark, sf_dir, "labels").filter(~held_out(F.col("doc_id"))))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = quality.scores(docs, quality_model(spark, sf_dir, docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                        (F.col("score") >= 0.3).cast("int").alias("predicted"))


def vocabulary(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), end_id=2, keep_ids=False)


def op10_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return token_store.read_store(token_store.write_store(docs, vocabulary("byte_bpe_50k.json"), end_id=0))


def op6_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(_table(spark, sf_dir, "embeddings"), threshold=0.9)


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    marks = "<|im_end|><|im_start|>assistant ok"
    extra = spark.range(2, numPartitions=1).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(marks).alias("text"))
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(extra)
    got = chat.read_back(chat.examples(turns))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("losses", "")
    return got.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
                      F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
                      F.col("formatted_chars").cast("long").alias("formatted_chars"))


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_table(spark, sf_dir, "documents"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_spans(_table(spark, sf_dir, "documents"))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base = ("email", "ip", "card", "phone")
    kinds = F.transform("spans", lambda s: s["kind"])
    counts = [F.size(F.array_remove(kinds, k)) for k in base]
    counts = [(F.size("spans") - n).cast("long").alias(f"n_{k}") for n, k in zip(counts, base)]
    own = F.filter("spans", lambda s: s["kind"].isin(*base))
    return found.select("doc_id", *counts, F.sha2(joined(own), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"), min_count=100, longest=5, percent=100, top=2000)


def op12_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.remove_repeats(_table(spark, sf_dir, "documents"), window=20)
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def damaged(turns: DataFrame) -> DataFrame:
    """The turns with faults put in by the checksum of their key: dropped, emptied, cut, repeated or
    given the role user."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
                        (F.crc32(key) % 20).alias("h")).filter("h != 0")
    text = F.when(F.col("h") == 1, "").when(F.col("h") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    times = F.when(F.col("h") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.select("conv_id", "turn", F.when(F.col("h") == 4, "user").otherwise(F.col("role")).alias("role"),
                       text.alias("text"), F.explode(times).alias("copy")).drop("copy")


def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations")
    done = repair.Repair(damaged(turns))
    rows = turns.select(F.col("conv_id").alias("id")).distinct().join(done.report, F.expr("id <=> conv_id"), "left")
    rows = rows.drop("conv_id").join(repair.digests(done.turns), F.expr("id <=> conv_id"), "left")
    numbers = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return rows.select(F.col("id").alias("conv_id"), *numbers, F.coalesce("audit", F.lit("")).alias("audit"),
                       F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": pipeline, "op1_minhash": op1_minhash, "op2_decontaminate": op2_decontaminate, "op3_lm_score": op3_lm_score, "op4_quality": op4_quality,
            "op5_packing": op5_packing,
            "op6_embeddings": op6_embeddings, "op7_chat": op7_chat, "op8_licenses": op8_licenses,
            "op9_pii": op9_pii, "op10_token_store": op10_token_store,
            "op11_collocations": op11_collocations,
            "op12_substrings": op12_substrings, "op13_repair": op13_repair}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
