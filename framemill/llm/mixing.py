"""Mixing sources to target shares of tokens.

Texts get hash-random keys and are sorted by range within their source;
distributed running totals of tokens tell where each source's exact budget ends,
which may be inside a text: of that one only the tokens before the cut are used.
A budget beyond the source's tokens repeats the source, whole epochs first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framemill.functions.ranks import running_total
from framemill.llm.tokens import source_key
from framemill.session import written


def text_key(column: str = "text") -> Column:
    """128 bits that are equal for texts equal up to line ends and outer blanks; null for null and blank texts."""
    text = F.regexp_replace(F.regexp_replace(column, r"\r\n?", "\n"), r"^[\s\x{FEFF}]+|\s+$", "")
    return F.when(text != "", F.md5(text))


def unique_texts(counted: DataFrame) -> DataFrame:
    """source, doc_id, tokens of each distinct text: the copy with the smallest doc_id stands for all.

    counted: doc_id, source, text_key, tokens. Texts without a key are left out.
    """
    first = counted.where("text_key is not null and doc_id is not null and tokens > 0").groupBy("text_key").agg(F.min(F.struct("doc_id", "source", "tokens")).alias("first"))
    return first.select("first.source", "first.doc_id", "first.tokens")


def budgets(totals: DataFrame, targets: DataFrame, tokens: int | None = None) -> DataFrame:
    """source, target_share, max_repeats, total, budget: one row per target.

    tokens: size of the mix; by default the largest in which every target source
    that has texts reaches its share within its repeats. A source without texts,
    or with too few for a given size, gets what it can.
    """
    t = targets.select(source_key().alias("source"), F.col("target_share").cast("double").alias("target_share"), F.greatest(F.coalesce("max_repeats", F.lit(1)), F.lit(0)).alias("max_repeats"))
    t = t.where("target_share > 0").join(totals, "source", "left").withColumn("total", F.coalesce("total", F.lit(0)))
    most = F.col("total") * F.col("max_repeats")
    size = F.lit(float(tokens)) if tokens is not None else t.where("total > 0").agg(F.coalesce(F.min(most / F.col("target_share")), F.lit(0.0)).alias("size")).first()["size"]
    size = F.lit(float(size)) if not isinstance(size, Column) else size
    return t.withColumn("budget", F.least(size * F.col("target_share"), most.cast("double")))


def mix(counted: DataFrame, targets: DataFrame, tokens: int | None = None) -> DataFrame:
    """source, doc_id, epoch (from 1), tokens, text_tokens: one row per use of a text.

    counted: doc_id, source (read loosely), text_key, tokens; targets: source,
    target_share, max_repeats. Copies of a text are one text, so none is used more
    often than max_repeats of its source. tokens are those used: all text_tokens,
    but for the one text of a source at which its budget ends. Sources that are no
    target, null and blank texts are left out.
    """
    texts = written(unique_texts(counted.select("doc_id", source_key().alias("source"), "text_key", "tokens")).withColumn("_key_", F.xxhash64("doc_id")))
    totals = texts.groupBy("source").agg(F.sum("tokens").alias("total"))
    plan = budgets(totals, targets, tokens).where("total > 0")
    plan = plan.select(F.col("source").alias("_source_"), F.floor(F.col("budget") / F.col("total")).cast("int").alias("whole"), F.round(F.col("budget") % F.col("total")).cast("bigint").alias("rest"), "max_repeats")
    ran = running_total(texts, ["source"], "_key_", ["doc_id"], F.col("tokens"), texts.count())
    ran = ran.join(plan, F.col("source") == F.col("_source_")).withColumn("part", F.greatest(F.least(F.col("rest") - F.col("before"), F.col("tokens")), F.lit(0)))
    used = ran.withColumn("uses", F.least(F.col("whole") + F.when(F.col("part") > 0, 1).otherwise(0), F.col("max_repeats"))).where("uses > 0")
    each = used.select("source", "doc_id", F.explode(F.sequence(F.lit(1), "uses")).alias("epoch"), F.col("tokens").alias("text_tokens"), "whole", "part")
    return each.select("source", "doc_id", "epoch", F.when(F.col("epoch") > F.col("whole"), F.col("part")).otherwise(F.col("text_tokens")).alias("tokens"), "text_tokens")


def shares(mixed: DataFrame, targets: DataFrame) -> DataFrame:
    """source, target_share, tokens, share, repeats (largest number of uses of a text), texts: the shares reached, one row per target."""
    per = mixed.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.max("epoch").alias("repeats"), F.count(F.when(F.col("epoch") == 1, 1)).alias("texts"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    t = targets.select(source_key().alias("source"), "target_share").join(per, "source", "left").select("source", "target_share", zero("tokens"), zero("repeats"), zero("texts"))
    whole = F.greatest(F.sum("tokens").over(Window.partitionBy(F.lit(0))), F.lit(1))  # one row per target
    return t.select("source", "target_share", "tokens", (F.col("tokens") / whole).alias("share"), "repeats", "texts")
