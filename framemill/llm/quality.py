"""Text quality statistics per document, and the documents that are not prose.

Every line of a text is measured natively (lengths, words, common words, cells,
markers, symbols, repetition, its neighbours' lengths) and given a class by an
ordered rule list. The rules were induced by incremental reduced-error pruning
on labelled lines (framemill.llm.rules, framemill.llm.training) and are applied
as one SQL CASE expression. A document is what more than half of its characters are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framemill.llm.learned import RULES
from framemill.llm.rules import to_case
from framemill.session import spread

CLASSES = ("list", "table", "junk")
#: Common words the driver may put into one pattern; the table is a vocabulary, not data.
MAX_COMMON = 20_000

#: What opens a list entry (bullets, boxes, numbers, letters).
MARKER = r"^\s*(?:[-*•·–—+>◦‣▪→]|\[[ xX]\]|\(?(?:[0-9]{1,4}|[A-Za-z]|[ivxIVX]{1,5})[.)])\s+\S"

#: A semicolon that parts cells: not one that ends a clause, a character entity or a call.
SEMICOLON = r"(?<!&#?\w{1,6})(?<!\));(?! )"

#: Numeric features of a line, in the order in which training sees them; and what statistics need besides.
FEATURES = (
    "length", "words", "word_length", "common", "letters", "digits", "cells", "cells_near", "marked", "marked_near",
    "distinct", "token", "mixed", "same", "length_before", "length_after", "longest_near", "commas",
)
BESIDES = ("symbols", "ends")


def common_list(common: DataFrame) -> list[str]:
    """The distinct words of a common_words table (lang, word), in lower case; nulls and blanks are passed over."""
    rows = common.select(F.lower(F.trim("word")).alias("word")).where("word is not null and word <> ''").distinct().limit(MAX_COMMON + 1).collect()
    if len(rows) > MAX_COMMON:
        raise ValueError(f"more than {MAX_COMMON} common words")
    return sorted(r.word for r in rows)


#: Blanks inside and around lines.
BLANKS = " \t\f\x0b\r"


def clean(text: Column) -> Column:
    """Line ends as one character, outer blanks and byte-order marks gone."""
    return F.btrim(F.replace(F.replace(text, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n")), F.lit(BLANKS + "\n\ufeff"))


def _times(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))


def _chars(text: Column, runs: str) -> Column:
    """Characters in runs of a kind: the runs are cut out, which makes one text where counting would make one per character."""
    return F.length(text) - F.length(F.regexp_replace(text, runs, ""))


def _where(text: Column, sign: str, count: Column) -> Column:
    """A count that needs a sign, made only for texts that have it."""
    return F.when(F.contains(text, F.lit(sign)), count).otherwise(0)


def _signs(text: Column, sign: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(sign), F.lit("")))


def _parts(text: Column) -> Column:
    """The text cut at blanks."""
    return F.array_remove(F.split(text, " "), "")


def lines(documents: DataFrame, common: list[str]) -> DataFrame:
    """doc_id, at, line, the FEATURES and what is BESIDES them of every line that is not blank; whole texts, whatever their length.

    A word is a run of letters; common words are looked up in lower case, those
    that are no run of letters match nothing. Lines stand without outer blanks. Null and blank texts have no lines.
    """
    d = spread(documents.select("doc_id", "text"), "doc_id").select("doc_id", clean(F.col("text")).alias("_t_")).where("_t_ <> ''")
    d = d.select("doc_id", F.array_remove(F.transform(F.split("_t_", "\n"), lambda x: F.btrim(x, F.lit(BLANKS))), "").alias("_lines_"))
    d = d.withColumns({"_size_": F.transform("_lines_", F.length), "_mark_": F.transform("_lines_", lambda x: x.rlike(MARKER).cast("int")), "_cells_": F.transform("_lines_", _cells)})
    # what a line needs of its neighbours goes with it, so that no row carries the whole text along
    pick = lambda x, i: F.struct(x.alias("line"), *(F.coalesce(F.get(c, i + by), F.lit(0)).alias(f"{c}{by}") for c in ("_size_", "_mark_", "_cells_") for by in (-1, 0, 1)), *(F.coalesce((F.get("_lines_", i + by) == x).cast("int"), F.lit(0)).alias(f"_same_{by}") for by in (-1, 1)))
    e = d.select("doc_id", F.posexplode(F.transform("_lines_", pick)).alias("at", "_l_")).select("doc_id", "at", "_l_.*")
    best = lambda c: F.greatest(F.col(f"{c}-1"), F.col(f"{c}1"))
    line, low, size = F.col("line"), F.col("_low_"), F.col("_size_0")
    e = e.withColumn("_low_", F.lower("line"))
    e = e.withColumns({"_words_": _parts(F.regexp_replace(low, r"[^\p{L}]+", " ")), "_tokens_": _parts(_spaced(low)), "_digits_": _chars(line, r"\p{N}+")})
    e = e.withColumns({"_letters_": F.length(F.array_join("_words_", "")), "_n_": F.size("_words_"), "_m_": F.size("_tokens_")})
    known = F.size(F.filter("_words_", lambda w: w.isin(*common))) if common else F.lit(0)
    share = lambda x: x / F.greatest(size, F.lit(1))
    per_word = lambda x: x / F.greatest(F.col("_n_"), F.lit(1))
    measured = {
        "length": size, "words": F.col("_n_"), "word_length": per_word(F.col("_letters_")), "common": per_word(known),
        "letters": share(F.col("_letters_")), "digits": share(F.col("_digits_")), "symbols": share(F.greatest(size - F.col("_letters_") - F.col("_digits_") - _signs(line, " ") - sum(_where(line, c, _signs(line, c)) for c in BLANKS[1:-1]), F.lit(0))),
        "cells": F.col("_cells_0"), "cells_near": best("_cells_"), "marked": F.col("_mark_0"),
        "marked_near": F.col("_mark_-1") + F.col("_mark_1"),
        # on a scale of logarithms, on which texts of any length compare: 0 for one token over and over, 1 for no token twice
        "ends": line.rlike(r"[.!?…]['\"”’)]*$").cast("int"), "distinct": F.when(F.col("_m_") > 1, F.log(F.size(F.array_distinct("_tokens_")).cast("double")) / F.log(F.col("_m_").cast("double"))).otherwise(1.0),
        "token": F.array_max(F.transform("_tokens_", F.length)), "mixed": share(_times(line, r"\p{L}\p{N}|\p{N}\p{L}|\p{Ll}\p{Lu}")),
        "same": F.col("_same_-1") + F.col("_same_1"),
        "length_before": F.col("_size_-1"), "length_after": F.col("_size_1"),
        "longest_near": best("_size_"), "commas": _signs(line, ", ") / 2,
    }
    return e.select("doc_id", "at", "line", *(measured[f].cast("double").alias(f) for f in FEATURES + BESIDES))


def _spaced(text: Column) -> Column:
    """The text with every blank a space."""
    other = BLANKS[1:-1]  # a carriage return has become a line end
    return F.when(text.rlike(f"[{other}]"), F.regexp_replace(text, f"[{other}]", " ")).otherwise(text)


def _cells(line: Column) -> Column:
    """Cells of a line under the separator that makes most: bars, tabs, semicolons, commas without a blank, wide gaps."""
    commas = _signs(line, ",") - (_signs(line, ", ") / 2).cast("int")
    return 1 + F.greatest(_signs(line, "|"), _signs(line, "\t"), _where(line, ";", _times(line, SEMICOLON)), commas, _where(line, "  ", _times(line, r"\S {2,}(?=\S)")))


def statistics(documents: DataFrame, common: list[str]) -> DataFrame:
    """Per document: doc_id, lines, chars, words, mean_word_length, symbol_ratio, punctuated_lines, common_words, list, table, junk, prose, text_class.

    Ratios are of the document's characters, lines or words; list, table, junk and
    prose are the shares of its characters by class of line. text_class is the
    largest class when more than half is not prose, else 'prose'. A document
    whose text is null or blank has no lines and no row. doc_id is taken as
    unique: rows with the same id are measured together. Extra columns are ignored.
    """
    kind = F.expr(to_case(RULES))
    each = lines(documents, common).withColumn("kind", kind)
    held = lambda k: F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("length"))), F.lit(0.0)) / F.sum("length")
    whole = each.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("length").cast("bigint").alias("chars"), F.sum("words").cast("bigint").alias("words"),
        (F.sum(F.col("word_length") * F.greatest(F.col("words"), F.lit(1))) / F.greatest(F.sum("words"), F.lit(1))).alias("mean_word_length"),
        (F.sum(F.col("symbols") * F.col("length")) / F.sum("length")).alias("symbol_ratio"), F.avg("ends").alias("punctuated_lines"),
        (F.sum(F.col("common") * F.greatest(F.col("words"), F.lit(1))) / F.greatest(F.sum("words"), F.lit(1))).alias("common_words"),
        *(held(k).alias(k) for k in (*CLASSES, "prose")),
    )
    largest = F.when((F.col("table") >= F.col("list")) & (F.col("table") >= F.col("junk")), "table").when(F.col("list") >= F.col("junk"), "list").otherwise("junk")
    return whole.withColumn("text_class", F.when(F.col("prose") < 0.5, largest).otherwise("prose"))


def found(documents: DataFrame, common: list[str]) -> DataFrame:
    """doc_id, text_class of the documents of which more than half of the characters are not prose."""
    return statistics(documents, common).where("text_class <> 'prose'").select("doc_id", "text_class")
