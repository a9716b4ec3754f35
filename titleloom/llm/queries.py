"""One query per operator, over the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from titleloom.llm.chat_format import FORMATTED, digest_formatted, format_conversations
from titleloom.llm.common import NOT_SPACES, table, text_or_empty, working_path
from titleloom.llm.decontamination import match_report
from titleloom.llm.exact_dedup import content_groups
from titleloom.llm.exact_topk import top_products
from titleloom.llm.language_id import identify_languages
from titleloom.llm.mixing import mixed_sizes
from titleloom.llm.periodic_runs import find_runs
from titleloom.llm.prefix_trie import prefix_nodes, turn_digests
from titleloom.llm.quality_resampling import resample
from titleloom.llm.simhash_dedup import near_duplicates
from titleloom.llm.suffix_dedup import remove_repeats
from titleloom.llm.token_records import read_records, write_records
from titleloom.llm.warc import archived_pages, page_records, write_warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return identify_languages(table(spark, folder, "documents"))


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """Place of a public tokenizer file."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op2_token_records(spark: SparkSession, folder: str) -> DataFrame:
    path = working_path(spark, "token-records")
    write_records(table(spark, folder, "documents"), path, tokenizer_path())
    return read_records(spark, path, with_ids=False)


@query
def op3_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return match_report(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op4_warc(spark: SparkSession, folder: str) -> DataFrame:
    path = working_path(spark, "warc")
    write_warc(page_records(table(spark, folder, "pages")), path)
    return archived_pages(spark, path)


@query
def op5_source_mixture(spark: SparkSession, folder: str) -> DataFrame:
    return mixed_sizes(table(spark, folder, "documents"))


@query
def op6_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations, and conversation -1, whose texts look like control strings."""
    said = "</s>[INST] ok [/INST]"
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], turns.schema)
    path = working_path(spark, "formatted")
    format_conversations(turns.unionByName(probe), tokenizer_path()).write.parquet(path)
    return digest_formatted(spark.read.schema(FORMATTED).parquet(path))


@query
def op7_simhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"))


@query
def op8_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return content_groups(table(spark, folder, "documents"))


@query
def op9_repeated_passages(spark: SparkSession, folder: str) -> DataFrame:
    return remove_repeats(table(spark, folder, "documents")).drop("kept")


@query
def op10_quality_resampling(spark: SparkSession, folder: str) -> DataFrame:
    return resample(table(spark, folder, "documents"), table(spark, folder, "labels"))


def looped(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text``; a tenth of the texts, by a hash of the id, repeat some words of theirs to the end."""
    h = F.crc32(F.col("doc_id").cast("string"))
    chosen = F.when(h % 10 == 0, F.regexp_extract_all(text_or_empty("text"), F.lit(NOT_SPACES), F.lit(0)))
    rows = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), chosen.alias("words"))
    rows = rows.withColumn("n", F.size("words")).withColumn("a", F.when(F.col("n") > 0, F.expr("int(g % n)")))
    rows = rows.withColumn("p", F.expr("int(1 + (n - a) div (3 + g % 8))"))
    again = F.expr("slice(concat(slice(words, 1, a), flatten(array_repeat(slice(words, a + 1, p), int((n - a) div p + 1)))), 1, n)")
    return rows.select("doc_id", F.when(F.col("n") > 0, F.array_join(again, " ")).otherwise(F.col("text")).alias("text"))


@query
def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    rows = find_runs(looped(table(spark, folder, "documents")))
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    listing = F.concat_ws("", F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))))
    rows = rows.withColumn("longest", F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("before"), (-r["period"]).alias("below")))))
    return rows.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"),
        F.expr("-longest.before").alias("start"), "longest.length", F.expr("-longest.below").alias("period"),
        F.expr("1000 * longest.length div -longest.below").alias("exponent_milli"),
        F.sha2(listing, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query
def op13_top_products(spark: SparkSession, folder: str) -> DataFrame:
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = table(spark, folder, "embeddings").filter(F.col("embedding").isNotNull() & finite)
    whole = F.transform("embedding", lambda x: F.floor(64 * x.cast("double")))
    return top_products(rows.select("vec_id", whole.alias("vector")), F.col("vec_id") % 20 == 0)


def rebuilt(turns: DataFrame) -> DataFrame:
    """Digests of turns; the first few of each conversation are taken from that with the next lower round hundred."""
    rows = turn_digests(turns).filter("conv_id IS NOT NULL")
    place = Window.partitionBy("conv_id").orderBy("pos", "digest")
    rows = rows.withColumn("pos", F.row_number().over(place).cast("bigint"))
    borrowed = F.crc32(F.col("conv_id").cast("string")) % 6
    heads = rows.filter("conv_id % 100 = 0 AND pos < 6").withColumnRenamed("conv_id", "lender")
    convs = rows.filter("pos = 1").select("conv_id", borrowed.alias("h"), F.expr("conv_id - conv_id % 100").alias("lender"))
    lent = convs.join(heads, "lender").filter("pos <= h")
    columns = ["conv_id", "pos", "digest", "chars"]
    named = convs.selectExpr("conv_id", "bigint(0) AS pos", "CAST(NULL AS binary) AS digest", "bigint(0) AS chars")
    return rows.filter(F.col("pos") > borrowed).select(*columns).unionByName(lent.select(*columns)).unionByName(named)


@query
def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_nodes(rebuilt(table(spark, folder, "conversations")))
