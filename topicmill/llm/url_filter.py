"""URL verdicts: rules first, then the ratio of two character language models.

Accepted and rejected URLs (those that a rule decides) each train a variable-order Markov
model: the probability of a character after up to ``order`` others is smoothed with that
after one fewer, down to equal shares. A URL's score is its log-likelihood under the
rejected model less that under the accepted one, by character of the whole URL; only
equal URLs are scored once. A fifth of the URLs is held out to find the threshold; the
models that score count every ruled URL, the held-out ones too. Everything is built-in
DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicmill.llm.common import written
from topicmill.operators.lookup import join_words

#: A character that no URL holds stands before its start.
START = "\u0001"
LOWER = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Both empty for a null URL or one without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), *LOWER)
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def decided(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """Rule and verdict by the longest fitting of a short list of (verdict, host and path)."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, name in sorted(rules, key=lambda r: len(r[1])):
        of, slash, below = name.partition("/")
        fits = ((host == of) | host.endswith("." + of)) & path.startswith(slash + below)
        rule, verdict = F.when(fits, name).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return rule, verdict


def _grams(urls: DataFrame, order: int, *columns: str) -> DataFrame:
    """A row for each character of a URL: the ``order`` characters before it and itself.

    The URL is cut into characters once and stays in its row, so the work is linear in its length.
    """
    chars = F.concat(F.array_repeat(F.lit(START), order), F.split("url", ""))
    cut = urls.filter(F.length("url") > 0).select(*columns, F.length("url").alias("size"), chars.alias("chars"))
    shifted = [F.slice("chars", F.lit(k + 1), F.col("size")).alias(f"c{k}") for k in range(order + 1)]
    grams = F.transform(F.arrays_zip(*shifted), lambda g: F.concat(*[g[f"c{k}"] for k in range(order + 1)]))
    return cut.select(*columns, F.explode(grams).alias("gram"))


def character_ratios(trained: DataFrame, wanted: DataFrame, order: int, trust: float, alphabet: int) -> DataFrame:
    """``gram`` and ``ratio`` (log of rejected over accepted probability) of each wanted gram.

    ``trained`` has ``gram``, ``allow`` and ``block`` counts. With ``k`` characters of context
    the probability is (count + trust * probability with fewer) / (context's count + trust).
    """
    model = wanted.select("gram").distinct()
    chance = {c: F.lit(1.0 / alphabet) for c in ("allow", "block")}
    for k in range(order + 1):
        seen = f"seen{k}"
        last, before = F.substr("gram", F.lit(order + 1 - k), F.lit(k + 1)), F.substr("gram", F.lit(order + 1 - k), F.lit(k))
        grams = trained.groupBy(last.alias(seen)).agg(F.sum("allow").alias("allow"), F.sum("block").alias("block"))
        contexts = trained.groupBy(before.alias(seen)).agg(F.sum("allow").alias("allow_all"), F.sum("block").alias("block_all"))
        if k == 0:  # the empty context alone: one row
            contexts = F.broadcast(contexts)
        model = model.withColumn(seen, last).join(grams, seen, "left").withColumn(seen, before).join(contexts, seen, "left")
        step = [
            (
                (F.coalesce(F.col(c), F.lit(0)) + trust * chance[c]) / (F.coalesce(F.col(f"{c}_all"), F.lit(0)) + trust)
            ).alias(f"{c}_p")
            for c in ("allow", "block")
        ]
        model = model.select("gram", *step)
        chance = {c: F.col(f"{c}_p") for c in ("allow", "block")}
    return model.select("gram", (F.log("block_p") - F.log("allow_p")).alias("ratio"))


def scored(trained: DataFrame, wanted: DataFrame, order: int, trust: float, alphabet: int) -> DataFrame:
    """``wanted`` and ``score``; the URLs of ``trained`` count ``allow`` and ``block`` times each.

    Characters travel with the ``key`` of their URL, not with the URL. The grams with most
    rows, such as the first ones of every URL, meet their ratios without a shuffle.
    """
    counts = written(
        _grams(trained, order, "allow", "block")
        .groupBy("gram")
        .agg(F.sum("allow").alias("allow"), F.sum("block").alias("block")),
        "url-grams",
    )
    grams = _grams(wanted, order, "key")
    ratios = written(character_ratios(counts, grams, order, trust, alphabet), "url-ratios")
    totals = join_words(grams, ratios, "gram").groupBy("key").agg(F.avg("ratio").alias("score"))
    return wanted.join(totals, "key", "left").na.fill(0.0, ["score"])


def threshold(held: DataFrame, step: float = 0.005, most: float = 20.0) -> DataFrame:
    """One row ``cut``: the score above which a URL is blocked.

    Of the held-out URLs with a rule, the middle of the cuts at which the share of blocked
    URLs below it and of allowed ones not below it add up to least; scores count by
    steps, at most ``2 * most / step`` of them. Null without both kinds.
    """
    score = F.greatest(F.lit(-most), F.least(F.lit(most), F.col("score")))
    bins = (
        held.groupBy(F.floor(score / step).alias("bin"))
        .agg(F.sum("allow").alias("allow"), F.sum("block").alias("block"))
    )
    bins = bins.agg(
        F.sort_array(F.collect_list(F.struct("bin", "allow", "block"))).alias("bins"),
        F.sum("allow").alias("allow_all"),
        F.sum("block").alias("block_all"),
    ).filter("allow_all > 0 and block_all > 0")
    cuts = bins.select(
        "bins", "allow_all", "block_all", F.posexplode(F.concat(F.col("bins.bin"), F.array(F.element_at("bins.bin", -1) + 1)))
    ).select(F.col("col").alias("bin"), "bins", "allow_all", "block_all")
    below = lambda c: F.aggregate(
        F.filter("bins", lambda b: b["bin"] < F.col("bin")), F.lit(0).cast("long"), lambda n, b: n + b[c]
    )
    error = (F.col("allow_all") - below("allow")) / F.col("allow_all") + below("block") / F.col("block_all")
    errors = cuts.select("bin", F.round(error, 9).alias("error"))
    least = errors.groupBy("error").agg(F.min("bin").alias("low"), F.max("bin").alias("high"))
    return least.agg(F.min_by(F.struct("low", "high"), "error").alias("best")).select(
        ((F.col("best.low") + F.col("best.high")) / 2 * step).alias("cut")
    )


def judged(
    pages: DataFrame,
    rules: list[tuple[str, str]],
    order: int = 4,
    trust: float = 2.0,
    alphabet: int = 128,
) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``verdict`` and ``score`` of every row of ``pages``.

    A null URL is judged as an empty one, whose score is 0. Where held-out URLs of both kinds
    are missing, URLs without a rule are allowed. Repeated rows are judged each, a null
    ``page_id`` stays null, other columns are ignored, an empty table gives no rows. URLs are
    told apart by themselves when they are grouped, and by their MD5 when rows get their score.
    """
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"))
    rows = rows.select("page_id", host.alias("host"), path.alias("path"), "url")
    rule, verdict = decided(F.col("host"), F.col("path"), rules)
    rows = rows.select("page_id", "host", "path", "url", rule.alias("rule"), verdict.alias("ruled"))
    says = {c: F.count(F.when(F.col("ruled") == c, 1)).alias(c) for c in ("allow", "block")}
    held = F.pmod(F.crc32(F.col("url").cast("binary")), F.lit(5)) == 0
    key = F.md5(F.col("url").cast("binary"))
    urls = rows.groupBy("url").agg(*says.values()).select("*", held.alias("held"), key.alias("key"))
    urls = written(urls, "urls")
    ruled = urls.filter("allow + block > 0")
    model = (order, trust, alphabet)
    cut = threshold(scored(ruled.filter("not held"), ruled.filter("held"), *model))
    scores = written(scored(ruled, urls, *model), "url-scores")
    keyed = rows.select("page_id", "host", "path", "rule", "ruled", key.alias("key"))
    judged_rows = join_words(keyed, scores.select("key", "score"), "key").crossJoin(F.broadcast(cut))  # one row
    guess = F.when(F.col("score") >= F.col("cut"), "block").otherwise("allow")
    return judged_rows.select("page_id", "host", "path", "rule", F.coalesce("ruled", guess).alias("verdict"), "score")
