"""The registered queries of the corpus operators: production parameters, whole tables, whole results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from formflow.llm import alignment, balanced, chat, decontamination, language, minhash, packing, quality, secrets, sql, suffixes, urls, warc, whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

URL_RULES = [
    urls.Rule("org", "/", "allow"),
    urls.Rule("example.org", "/es/", "block"),
    urls.Rule("example.org", "/en/1", "block"),
    urls.Rule("com", "/fr/", "allow"),
    urls.Rule("com", "/de/", "block"),
]


#: What the two turns of conversation -1 say: control strings as plain text.
CONTROL_TEXT = "</s>[INST] ok [/INST]"


def query(oracle: str | None = None):
    """Register ``fn(spark, sf_dir)`` with the SQL that gives the same rows."""

    def add(fn):
        QUERIES[fn.__name__] = fn
        if oracle:
            ORACLES[fn.__name__] = oracle
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query()
def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query()
def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


@query()
def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents"))
    number = lambda kind: F.size(F.filter("strong", lambda s: s["kind"] == secrets.KINDS.index(kind))).cast("long")
    return found.select(
        "doc_id", number("assign").alias("n_assign"), number("access").alias("n_access"), number("hex").alias("n_hex"),
        F.sha2(secrets.written(F.col("strong")), 256).alias("base_sha256"),
        secrets.written(F.concat("strong", "added")).alias("spans"))


@query(sql.chat_formatting(CONTROL_TEXT))
def op4_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    extra = spark.createDataFrame([(-1, 0, "user", CONTROL_TEXT), (-1, 1, "assistant", CONTROL_TEXT)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.digests(chat.format_conversations(rows, tokenizer_path("byte_bpe_50k.json")))


@query(sql.url_filter(URL_RULES))
def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_pages(table(spark, sf_dir, "pages"), URL_RULES).select("page_id", "host", "path", "rule", "verdict")


@query()
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"), F.crc32(F.col("doc_id").cast("string")) % 3 == 1)


@query(sql.quality_rules())
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query(sql.suffix_array_dedup())
def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffixes.repeated_spans(table(spark, sf_dir, "documents"))
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), "kept_sha256")


@query(sql.minhash_near_dedup())
def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.near_duplicates(table(spark, sf_dir, "documents"), ["doc_id"], "doc_id", size=4)
    return found.select("doc_id", F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), (F.col("doc_id") == F.col("component")).alias("kept"))


@query(sql.warc())
def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = warc.write_archives(table(spark, sf_dir, "pages"))
    return warc.read_archives(spark, archives, with_payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query()
def op11_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = alignment.align(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@query()
def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitening.whiten(table(spark, sf_dir, "embeddings"), components=8)
    return found.select("vec_id", "component", "n", F.col("deviation").cast("long").alias("deviation"), "whitened", "explained", "identity_error")


@query()
def op13_balanced_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balanced.pack_balanced(table(spark, sf_dir, "documents"), tokenizer_path(), capacity=2048)
