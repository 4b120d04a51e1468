"""Answers of a classification model, checked and applied as DataFrame operations.

The model itself is outside: ``answers`` has ``article_id`` and ``body``, the JSON that
it gave.  An answer that breaks the scheme is refused with a reason and changes nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import text

# Groups with their last sub-code letter, and caps per article.
LAST_SUB = {"1": "f", "2": "f", "3": "i"}
OUTSIDE = "x"
MOST_TICKERS, MOST_INDUSTRIES = 5, 3
FIELDS = "group sub confidence summary_ai tickers industries".split()
_ANSWER = "`group` string, sub string, confidence double, summary_ai string, tickers array<string>, industries array<string>"


@dataclass(frozen=True)
class Applied:
    articles: DataFrame
    tickers: DataFrame
    industries: DataFrame
    refused: DataFrame
    counts: DataFrame


def checked(answers: DataFrame, codes: DataFrame) -> DataFrame:
    """``article_id``, the parsed fields and ``error``, the first rule that an answer breaks, or null.

    A field that the scheme doesn't name is a broken rule, too.  ``codes`` is the closed list of industries (``industry``, ``industry_id``); lists that
    the model leaves out are empty.
    """
    none = F.array().cast("array<string>")
    rows = answers.select("article_id", F.from_json("body", _ANSWER, {"mode": "PERMISSIVE"}).alias("a"), F.json_object_keys("body").alias("keys"))
    a = rows.select("article_id", "keys", F.col("a.group").alias("group"), "a.sub", "a.confidence", "a.summary_ai", F.coalesce("a.tickers", none).alias("tickers"), F.coalesce("a.industries", none).alias("industries"))
    known = codes.agg(F.collect_set("industry").alias("known"))  # one row: a closed list of industries
    a = a.join(F.broadcast(known))
    in_group = F.lit(False)
    for g, last in LAST_SUB.items():
        in_group = in_group | ((F.col("group") == g) & F.col("sub").rlike(f"^{g}[a-{last}]$"))
    in_group = in_group | ((F.col("group") == OUTSIDE) & (F.col("sub") == OUTSIDE))
    broken = lambda ok: ~F.coalesce(ok, F.lit(False))
    error = (
        F.when(F.col("group").isNull() & F.col("sub").isNull() & F.col("confidence").isNull(), "no answer")
        .when(broken(F.size(F.array_except("keys", F.array(*map(F.lit, FIELDS)))) == 0), "fields")
        .when(broken(F.col("group").isin(*LAST_SUB, OUTSIDE)), "group")
        .when(broken(in_group), "sub")
        .when(broken(F.col("confidence").between(0, 1)), "confidence")
        .when(F.col("summary_ai").isNull(), "summary")
        .when(F.size(F.array_except("industries", "known")) > 0, "industry")
    )
    return a.select("article_id", "group", "sub", "confidence", "summary_ai", "tickers", "industries", error.alias("error"))


def _first(values: Column, most: int) -> Column:
    return F.slice(F.array_distinct(values), 1, most)


def apply(articles: DataFrame, answers: DataFrame, listed: DataFrame, codes: DataFrame, issuer_industry: DataFrame) -> Applied:
    """What accepted answers change.

    ``articles`` has ``article_id``, ``url``, ``title``, ``sapo``, ``group_from_feed`` and
    ``ticker_step_ran``; ``listed`` ``ticker``, ``security_id``, ``issuer_id``.  Tickers
    are of group 3 only: those of the URL and of title and summary where that step
    hasn't run, and listed ones of the model, ``MOST_TICKERS`` at most in its order.
    Industries are the model's first ``MOST_INDUSTRIES`` and those of all tickers' issuers.
    """
    good = checked(answers, codes).join(articles, "article_id")
    refused = good.where("error is not null").select("article_id", "error")
    group = F.when(F.col("group") != OUTSIDE, F.col("group").cast("int"))
    good = good.where("error is null").withColumn("group_no", group)
    changed = good.select(
        "article_id", "group_no", F.when(F.col("group_no").isNotNull(), F.col("sub")).alias("sub"), "confidence", "summary_ai",
        F.coalesce(F.col("group_from_feed").isNotNull() & ~F.col("group_no").eqNullSafe(F.col("group_from_feed")), F.lit(False)).alias("overridden"),
        F.when(F.col("group_no").isNull(), F.array(F.lit(OUTSIDE))).otherwise(F.array().cast("array<string>")).alias("labels"), (F.col("ticker_step_ran") | F.coalesce(F.col("group_no") == 3, F.lit(False))).alias("ticker_step_ran"),
    )
    third = good.where("group_no = 3")
    found = F.array_distinct(F.regexp_extract_all(F.concat_ws(" ", "title", "sapo"), F.lit(text.TICKER), F.lit(0)))
    looked = F.when(~F.col("ticker_step_ran"), F.array_except(found, F.array(*map(F.lit, text.AMBIGUOUS))))
    of_url = F.when(~F.col("ticker_step_ran"), F.array_compact(F.array(text.ticker_of_url(F.col("url")))))
    own = F.array_distinct(F.filter(F.transform("tickers", lambda t: F.upper(F.trim(t))), lambda t: t != ""))
    asked = third.select("article_id", F.explode(F.map_from_arrays(F.array(F.lit("url"), F.lit("lookup"), F.lit("ai")), F.array(of_url, looked, own))).alias("via", "list"))
    asked = asked.select("article_id", "via", F.posexplode("list").alias("at", "ticker")).join(listed, "ticker", "left")
    # of the model's tickers the first listed ones; an article has a handful
    kept = asked.where("security_id is not null").groupBy("article_id", "via").agg(F.sort_array(F.collect_list(F.struct("at", "security_id", "issuer_id"))).alias("l"))
    most = F.when(F.col("via") == "ai", MOST_TICKERS).otherwise(F.size("l"))
    tickers = kept.select("article_id", "via", F.explode(F.slice("l", F.lit(1), F.greatest(most, F.lit(1)))).alias("t")).select("article_id", "t.security_id", "t.issuer_id", "via")
    mine = good.select("article_id", F.explode(_first(F.col("industries"), MOST_INDUSTRIES)).alias("industry"), "confidence").join(codes, "industry")
    mine = mine.select("article_id", "industry_id", F.lit("ai").alias("via"), "confidence")
    theirs = tickers.join(issuer_industry.select("issuer_id", "industry_id"), "issuer_id").where("industry_id is not null").select("article_id", "industry_id", F.lit("ticker").alias("via"), F.lit(None).cast("double").alias("confidence")).distinct()
    lost = asked.where("via = 'ai'").groupBy("article_id").agg(F.count_if(F.col("security_id").isNull()).alias("dropped"), F.greatest(F.count_if(F.col("security_id").isNotNull()) - MOST_TICKERS, F.lit(0)).alias("capped"))
    counts = lost.agg(F.coalesce(F.sum("dropped"), F.lit(0)).alias("tickers_dropped"), F.coalesce(F.sum("capped"), F.lit(0)).alias("tickers_capped"))
    return Applied(changed, tickers.select("article_id", "security_id", "via").distinct(), mine.unionByName(theirs), refused, counts)
