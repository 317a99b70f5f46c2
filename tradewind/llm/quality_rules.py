"""Quality rules: base counts and a hashed n-gram log-likelihood ratio between trusted and raw text.

DataFrame functions only. The multinomials run over hashed pairs of neighbouring words, each word reduced
to its last three characters so that the cells are dense. Every document's mean log ratio between the
trusted-target and the raw-corpus multinomial is compared with a fixed threshold.

Every text is split once. Its base counts and the cells of its pairs are written as one narrow row; both multinomials, the
scores and the verdicts are taken from those rows, so no text is shuffled and a filter on the result meets stored columns.

Defined results: a null or empty text has no words and fails the base rules; rows with equal ids are
scored and judged row by row, and all of them are trusted if their id is; a null id is never trusted; with no trusted
rows every ratio is 0 and only the base rules decide; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import WORD_SPLIT, stored

SYMBOLS = "#*$%&|<>"
CELLS = 1 << 16
UNIT = 1_000_000
#: Documents below this mean log ratio, in millionths, are dropped.
THRESHOLD = -400_000
TAIL = 3


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WORD_SPLIT), "")


def _duplicate_lines(text: Column) -> Column:
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    return (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


def counted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_cells: int = CELLS) -> DataFrame:
    """One row per row of ``docs``: id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, and cells.

    ``cells`` has the hashed cell of the pair that ends with each word, the first pair beginning with nothing, less half of
    ``n_cells``, so that two bytes hold it as a rule. Repeated three-word windows are found per row by sorting (hash, position) packed into one long; the
    hash takes all bits that positions leave free.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    symbols = F.length(F.regexp_replace(text, "[^" + "".join("\\" + c for c in SYMBOLS) + "]+", ""))
    rows = docs.select(
        F.col(id_col).alias("id"),
        words(F.col(text_col)).alias("w"),
        symbols.cast("long").alias("n_symbols"),
        _duplicate_lines(F.col(text_col)).alias("n_dup_lines"),
    )
    pair = F.expr(f"transform(w, (x, i) -> crc32(cast(concat(right(coalesce(get(w, i - 1), ''), {TAIL}), ' ', right(x, {TAIL})) as binary)) % {n_cells} - {n_cells // 2})")
    rows = rows.select(
        "id", "n_symbols", "n_dup_lines", pair.cast("array<smallint>" if n_cells <= CELLS else "array<int>").alias("cells"), F.size("w").cast("long").alias("n_words"),
        F.length(F.concat_ws("", "w")).cast("long").alias("word_chars"),
        F.when(F.size("w") >= 3, F.expr("transform(arrays_zip(w, slice(w, 2, size(w)), slice(w, 3, size(w))), x -> xxhash64(x.w, x.`1`, x.`2`))"))
        .otherwise(F.array().cast("array<bigint>")).alias("h"),
    )
    # the last two entries are no full windows
    rows = rows.withColumn("h", F.expr("slice(h, 1, greatest(size(h) - 2, 0))"))
    rows = rows.withColumn("any_twice", F.size(F.array_distinct("h")) < F.size("h")).withColumn("m", F.size("h").cast("long"))
    sort_keys = F.sort_array(F.transform("h", lambda h, i: F.pmod(h, F.expr("9223372036854775807 div m - 1")) * F.col("m") + i))
    rows = rows.withColumn("s", F.when(F.col("any_twice"), sort_keys))
    same_as_next = F.expr("zip_with(s, slice(s, 2, greatest(size(s), 1)), (a, b) -> coalesce(a div m = b div m, false))")
    rows = rows.withColumn("e", same_as_next)
    positions = F.expr(
        "array_compact(zip_with(s, zip_with(e, concat(array(false), slice(e, 1, size(e) - 1)), (x, y) -> x or y), (k, f) -> if(f, k % m, null)))"
    )
    rows = rows.withColumn("p", positions)
    covered = F.array_union(F.array_union("p", F.transform("p", lambda x: x + 1)), F.transform("p", lambda x: x + 2))
    return rows.select(
        "id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
        F.when(F.col("any_twice"), F.size(covered)).otherwise(0).cast("long").alias("n_repeat_words"), "cells",
    )


def log_ratios(rows: DataFrame, trusted_ids: DataFrame, n_cells: int = CELLS) -> DataFrame:
    """At most ``n_cells`` rows (cell, weight): ln of the smoothed trusted over the smoothed raw share, in millionths.

    ``rows`` holds (id, cells) of all documents, ``trusted_ids`` one column of ids, all of which are used. The join is the
    same at every size. Both counts come from one pass over the cells, summed by cell before the shuffle.
    """
    marked = trusted_ids.select(F.col(trusted_ids.columns[0]).alias("trusted_id")).distinct()
    flagged = rows.select("id", "cells").join(marked.hint("merge"), F.col("id") == F.col("trusted_id"), "left")
    pairs = flagged.select(F.col("trusted_id").isNotNull().cast("long").alias("trusted"), F.explode("cells").alias("cell"))
    counts = stored(pairs.groupBy("cell").agg(F.sum("trusted").alias("t"), F.count("*").alias("r")), "cell-counts")
    totals = counts.agg(F.coalesce(F.sum("t"), F.lit(0)).alias("total_t"), F.coalesce(F.sum("r"), F.lit(0)).alias("total_r")).first()
    share = lambda count, total: (F.col(count) + 1) / F.lit(float(total + n_cells))
    weight = F.round((F.log(share("t", totals.total_t)) - F.log(share("r", totals.total_r))) * UNIT).cast("long")
    return counts.select("cell", (weight if totals.total_t else F.lit(0).cast("long")).alias("weight"))


def quality_rules(
    docs: DataFrame, trusted_ids: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = THRESHOLD, n_cells: int = CELLS
) -> DataFrame:
    """Base counts, base_failed, the summed log ratio ``llr_sum`` (millionths) over n_words pairs, and kept.

    The table of log ratios has at most ``n_cells`` rows, so it may be broadcast.
    """
    rows = stored(counted(docs, id_col, text_col, n_cells).withColumn("row", F.monotonically_increasing_id()), "counted")
    weights = log_ratios(rows, trusted_ids, n_cells)
    scores = (
        rows.select(F.col("row").alias("scored"), F.explode("cells").alias("cell"))
        .join(F.broadcast(weights), "cell")
        .groupBy("scored")
        .agg(F.sum("weight").alias("score"))
    )
    judged = rows.drop("cells").join(scores, F.col("row") == F.col("scored"), "left")
    llr = F.coalesce(F.col("score"), F.lit(0).cast("long"))
    failed = (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    return judged.select(
        F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
        (~failed & (llr >= F.lit(threshold) * F.col("n_words"))).alias("kept"), llr.alias("llr_sum"),
    )
