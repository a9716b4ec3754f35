"""Character statistics, Huffman codes and compressed columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from titleloom.functions import huffman
from titleloom.functions.text import printable_char, unix_newlines
from titleloom.plans.sizing import dealt, fits, lookup_join


def _scope(scope: str | None) -> Column:
    return F.col(scope).cast("string") if scope else F.lit("all")


def char_frequencies(docs: DataFrame, scope: str | None = None, text: str = "text") -> DataFrame:
    """``(scope, ch, freq)`` by code point. Texts are counted where they are read, in pieces of a bounded
    size; a row leaves a task for each scope and character in it."""
    rows = docs.select(_scope(scope).alias("scope"), unix_newlines(F.col(text)).alias("text"))
    counted = rows.mapInArrow(huffman.count_characters, "scope string, ch string, n bigint")
    return counted.groupBy("scope", "ch").agg(F.sum("n").alias("freq"))


def huffman_codes(freqs: DataFrame) -> DataFrame:
    """``(scope, ch, freq, code, code_len)``: one prefix code per scope."""
    return freqs.groupBy("scope").applyInPandas(
        huffman.codes_of_scope,
        "scope string, ch string, freq bigint, code string, code_len int",
    )


def code_listing(codes: DataFrame) -> DataFrame:
    """Codes with printable characters, shortest first within each scope."""
    shown = codes.select("scope", printable_char(F.col("ch")).alias("char"), "code", "code_len", "ch")
    return shown.orderBy("scope", "code_len", "ch").drop("ch")


def code_tables(codes: DataFrame) -> DataFrame:
    """``(scope, table)``: the code of a scope as a JSON object."""
    pairs = F.sort_array(F.collect_list(F.struct("ch", "code")))
    return codes.groupBy("scope").agg(F.to_json(F.map_from_entries(pairs)).alias("table"))


def coded_bits(codes: DataFrame) -> DataFrame:
    """``(scope, symbols, coded_bits)`` of the counted text."""
    return codes.groupBy("scope").agg(
        F.count("*").alias("symbols"),
        F.sum(F.col("freq") * F.col("code_len")).alias("coded_bits"),
    )


def _json_length(ch: Column) -> Column:
    """Length of one character inside an ASCII JSON string."""
    point = F.ascii(ch)
    return (
        F.when(ch.isin('"', "\\", "\n", "\r", "\t", "\b", "\f"), 2)
        .when((point >= 32) & (point < 127), 1)
        .when(point > 65535, 12)
        .otherwise(6)
    )


def compression_report(
    docs: DataFrame, codes: DataFrame, scope: str | None = None, text: str = "text"
) -> DataFrame:
    """Size before and after, and percent saved, with all texts of a scope as one container.

    The size before is that of the raw bytes. NULL saving stands for "not applicable".
    """
    original = docs.groupBy(_scope(scope).alias("scope")).agg(
        F.coalesce(F.sum(F.octet_length(text)), F.lit(0)).alias("original_bytes")
    )
    # An entry is written as "c": "code", with ", " between entries and braces around them.
    entry = _json_length(F.col("ch")) + F.col("code_len") + 6
    sizes = codes.groupBy("scope").agg(
        F.sum(F.col("freq") * F.col("code_len")).alias("coded_bits"),
        (F.sum(entry) + (F.count("*") - 1) * 2 + 2).alias("header_bytes"),
    )
    packed = F.ceil(F.col("coded_bits") / 8).cast("bigint")
    size = (packed + 1 + 4 + F.col("header_bytes")).alias("compressed_bytes")
    report = original.join(sizes, "scope", "left").select(
        "scope", "original_bytes", "coded_bits", "header_bytes", size
    )
    saving = (1 - F.col("compressed_bytes") / F.col("original_bytes")) * 100
    return report.withColumn("saving_pct", F.when(F.col("original_bytes") > 0, saving))


def _coded(
    docs: DataFrame, codes: DataFrame, scope: str | None, source: Column, name: str, header: bool | None
) -> DataFrame:
    """Add ``source`` coded (``header`` given) or decoded (None) under the code of each row's scope.

    ``codes`` should be a stored table: its size is measured. Small tables go to the workers once, as a
    broadcast, and rows carry text and scope only. Beyond that a table is joined to rows by a salted key.
    """
    tables = code_tables(codes)
    if fits(codes, F.octet_length("ch") + F.col("code_len") + 16):
        known = {row["scope"]: row["table"] for row in tables.collect()}
        coder = huffman.shared_coder(docs.sparkSession.sparkContext.broadcast(known), header)
        return docs.withColumn(name, coder(source, _scope(scope)))
    named = tables.select(F.col("scope").alias("_scope"), F.col("table").alias("_table"))
    joined = lookup_join(docs.withColumn("_scope", _scope(scope)), named, "_scope", source, False)
    coder = {None: huffman.unpack_with, True: huffman.encode_with, False: huffman.pack_with}[header]
    return joined.withColumn(name, coder(source, F.col("_table"))).drop("_scope", "_table")


def compress_column(
    docs: DataFrame,
    codes: DataFrame,
    scope: str | None = None,
    text: str = "text",
    name: str = "blob",
    header: bool = True,
    tasks: int | None = None,
) -> DataFrame:
    """Add each text, coded with the code of its scope; NULL for empty text. ``tasks`` as for ``dealt``.

    With ``header`` every value is a container of its own. Without it the code table stays in
    ``codes`` and values hold code bits only, which suits many short texts.
    """
    return _coded(dealt(docs, tasks), codes, scope, unix_newlines(F.col(text)), name, header)


def compress_alone(
    docs: DataFrame, text: str = "text", name: str = "blob", tasks: int | None = None
) -> DataFrame:
    """Add each text as a container under a code of its own. ``tasks`` as for ``dealt``."""
    return dealt(docs, tasks).withColumn(name, huffman.encode_alone(unix_newlines(F.col(text))))


def decompress_column(
    docs: DataFrame,
    blob: str = "blob",
    name: str = "text",
    codes: DataFrame | None = None,
    scope: str | None = None,
    tasks: int | None = None,
) -> DataFrame:
    """Add the text of a container column, or of a column without headers when given ``codes``.

    ``tasks`` as for ``dealt``; 0 where rows come from a step that has dealt them.
    """
    docs = dealt(docs, tasks)
    if codes is None:
        return docs.withColumn(name, huffman.decode(F.col(blob)))
    return _coded(docs, codes, scope, F.col(blob), name, None)
