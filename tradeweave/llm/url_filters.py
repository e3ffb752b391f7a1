"""URL filtering by listed rules and by association rules mined from the URLs they decide.

Listed rules name a host (with its subdomains) and a path prefix; the longest that fits wins. URLs that
they decide are the labelled examples: Spark's FP-growth mines combinations of URL tokens together with
the verdict, and combinations that foretell one verdict with enough support and confidence become
rules, shorter ones making longer ones with the same verdict superfluous. Other URLs meet these rules
by an inverted index from each rule's rarest token.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeweave.llm.common import scratch


def host_of(url: str = "url") -> Column:
    """After the first :// up to / ? # or the end, A-Z lower-cased; empty without ://."""
    host = F.regexp_extract(F.col(url), r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: str = "url") -> Column:
    """After the host up to ? # or the end; empty without ://."""
    return F.coalesce(F.regexp_extract(F.col(url), r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def listed_rule(rules: list[tuple[str, str]], host: Column, path: Column) -> tuple[Column, Column]:
    """(rule, verdict) of the longest listed rule that fits, else nulls."""
    rule = verdict = F.lit(None).cast("string")
    for kind, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):  # later ones are longer and win
        name, _, rest = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + rest)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def url_tokens(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens of a URL that can recur: scheme, the four last host labels and the three first path
    words by place, file extension, whether there is a query. Runs of digits count as 0."""
    plain = lambda c: F.regexp_replace(c, r"[0-9]+", "0")
    piece = lambda c, sep, n: F.get(F.split(c, sep), F.lit(n))
    labels = F.array_join(F.reverse(F.split(host, r"\.")), ".")
    words = F.regexp_replace(F.ltrim(F.regexp_replace(path, r"\.[^./]*$", "")), "^/+", "")
    named = [F.concat(F.lit("scheme "), F.regexp_extract(url, r"(?s)^(.*?)://", 1))]
    named += [F.concat(F.lit(f"host {n} "), plain(piece(labels, r"\.", n))) for n in range(4)]
    named += [F.concat(F.lit(f"path {n} "), plain(F.nullif(piece(words, "/+", n), F.lit("")))) for n in range(3)]
    named += [F.when(path.rlike(r"\.[^./]{1,8}$"), F.concat(F.lit("file "), F.lower(F.regexp_extract(path, r"\.([^./]{1,8})$", 1))))]
    named += [F.when(F.locate("?", url) > 0, F.lit("query"))]
    return F.array_distinct(F.array_compact(F.array(*named)))


def mine(labelled: DataFrame, support: float, confidence: float, longest: int) -> DataFrame:
    """Rules (tokens, verdict, confidence, n) from rows (tokens, verdict).

    A combination of at most `longest` tokens is a rule if a share `support` of all rows has it together
    with the verdict and a share `confidence` of the rows with the combination has that verdict. A rule is
    dropped if a part of its tokens is a rule for the same verdict.
    """
    said = F.concat(F.lit("verdict "), "verdict")
    baskets = labelled.select(F.concat("tokens", F.array(said)).alias("items"))
    parts = baskets.sparkSession.sparkContext.defaultParallelism
    sets = FPGrowth(itemsCol="items", minSupport=support, numPartitions=parts).fit(baskets).freqItemsets
    sets = sets.where(F.size("items") <= longest + 1).select(
        F.array_sort(F.filter("items", lambda i: ~i.startswith("verdict "))).alias("tokens"),
        F.get(F.filter("items", lambda i: i.startswith("verdict ")), F.lit(0)).alias("said"), "freq")
    alone = sets.where("said IS NULL AND size(tokens) > 0").select("tokens", F.col("freq").alias("of"))
    rules = (
        sets.where("said IS NOT NULL").join(alone, "tokens").withColumn("confidence", F.col("freq") / F.col("of"))
        .where(F.col("confidence") >= confidence)
        .select("tokens", F.substring("said", 9, 16).alias("verdict"), "confidence", F.col("freq").alias("n"))
    )
    fewer = F.expr("filter(flatten(array(transform(tokens, t -> array(t)), transform(tokens, t -> array_remove(tokens, t)))), s -> size(s) BETWEEN 1 AND size(tokens) - 1)")
    covered = (
        rules.select("tokens", "verdict", F.explode(fewer).alias("part"))
        .join(rules.select(F.col("tokens").alias("part"), F.col("verdict").alias("v")), "part")
        .where("v = verdict").select("tokens", "verdict").distinct()
    )
    return rules.join(covered, ["tokens", "verdict"], "left_anti")


def matched(combos: DataFrame, rules: DataFrame, labelled: DataFrame) -> DataFrame:
    """(tokens, verdict, confidence) of each combination that a rule fits: the surest, then the most frequent.

    Rules are found by their rarest token, so a combination meets only rules that share that token.
    """
    often = labelled.select(F.explode("tokens").alias("t")).groupBy("t").agg(F.count("*").alias("c"))
    index = (
        rules.withColumn("t", F.explode("tokens")).join(often, "t").groupBy("tokens", "verdict", "confidence", "n")
        .agg(F.min(F.struct("c", "t")).alias("rarest")).select(F.col("tokens").alias("need"), "verdict", "confidence", "n", F.col("rarest.t").alias("t"))
    )
    return (
        combos.select("tokens", F.explode("tokens").alias("t")).join(index, "t")
        .where(F.size(F.array_except("need", "tokens")) == 0).groupBy("tokens")
        .agg(F.max(F.struct("confidence", "n", F.col("verdict").alias("mined"), "need")).alias("best"))
        .select("tokens", "best.mined", F.col("best.confidence").alias("sureness"), F.col("best.need").alias("because"))
    )


def judge_urls(pages: DataFrame, rules: list[tuple[str, str]], support: float = 0.01, confidence: float = 0.9,
               longest: int = 3, default: str = "allow") -> DataFrame:
    """page_id, host, path, rule, verdict of every URL, and what the method says where no listed rule fits:
    because (tokens of the mined rule) and sureness (its confidence).

    Listed rules: (verdict, host/path). A URL that is null or has no :// has empty host and path and no rule,
    and like one that nothing fits it gets `default`. Repeated rows are judged alike and all returned. With no
    URL decided by a list nothing is mined.
    """
    spark = pages.sparkSession
    url, host, path = F.col("url"), F.col("host"), F.col("path")
    base = pages.select("page_id", url, host_of().alias("host"), path_of().alias("path"))
    rule, verdict = listed_rule(rules, host, path)
    base = base.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("listed"), url_tokens(url, host, path).alias("tokens"))
    tmp = scratch(spark, "urls")
    base = tmp.store(base.withColumn("tokens", F.when(host != "", F.col("tokens"))), "urls")
    labelled = base.where("listed IS NOT NULL").select("tokens", F.col("listed").alias("verdict"))
    columns = ["page_id", "host", "path", "rule"]
    if labelled.isEmpty():
        return base.select(*columns, F.coalesce("listed", F.lit(default)).alias("verdict"), F.lit(None).cast("array<string>").alias("because"), F.lit(None).cast("double").alias("sureness"))
    mined = tmp.store(mine(labelled, support, confidence, longest), "rules")
    combos = base.where("listed IS NULL AND tokens IS NOT NULL").groupBy("tokens").agg(F.count("*").alias("rows"))
    found = tmp.store(matched(combos, mined, labelled), "found")
    method = F.when(F.col("listed").isNull(), F.col("mined"))
    return base.join(found, "tokens", "left").select(
        *columns, F.coalesce("listed", method, F.lit(default)).alias("verdict"),
        F.when(F.col("listed").isNull(), F.col("because")).alias("because"), F.when(F.col("listed").isNull(), F.col("sureness")).alias("sureness"))
