"""URL filters: a list of rules, and association rules mined from labelled URLs (free style).

The list decides first: a rule (host, path) fits its host and all subdomains
where the URL's path starts with the rule's; the longest fitting rule wins
(host plus path, in characters; ties: the longer host, then ``block``).

URLs that the list leaves open are judged by association rules.  A URL is a set
of tokens: scheme, host labels and their parts, words of path and query.  Spark's
FP-growth finds the token combinations that are frequent among labelled URLs
together with their label; a combination becomes a rule for its label if its
support, its confidence and its lift reach the bounds below and no part of it
does as well (``mine_rules``).  Of the rules that match a URL the one with the
highest confidence decides (ties: support, then the more tokens, then the tokens
in order); without one the URL is allowed.

Both kinds are matched by one inverted index: a list rule stands under its host,
a mined rule under its rarest token.  A URL looks up the suffixes of its host
and its tokens and checks the rules that it meets.  The index is joined by
``attach``-like size check: broadcast only if its measured size is within the
library's bound, else shuffled with frequent tokens split.

FP-growth reads all tokens of all labelled URLs, but only one of the tokens that
occur in exactly the same labelled URLs, such as the words of a path that always
come together: a rule with two of them has a part that is as good.  The rules found
are then given for each of these tokens (``_token_classes``), so nothing is lost.
The support is the only bound on what is kept.

A NULL URL, or one without ``://``, has an empty host and path, no tokens, and
is allowed.  Repeated rows give repeated rows; a label that is repeated counts
once (the worse one); empty tables give no rules or no rows.  Only the named
columns are read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shroud.functions.joins import attach
from shroud.llm.common import write_stage
from shroud.llm.exact_dedup import lower_ascii

MIN_SUPPORT = 0.001    # of the labelled URLs, and
MIN_URLS = 10          # at least so many of them
MIN_CONFIDENCE = 0.8
MIN_LIFT = 1.05        # against the label's share among all labelled URLs
MAX_TOKENS = 4         # tokens of a rule

_RULE = "kind string, verdict string, host string, path string, tokens array<string>, confidence double, support double"


def host_of(url: Column) -> Column:
    return F.coalesce(lower_ascii(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def suffixes_of(host: Column) -> Column:
    """The host and the hosts that it is a subdomain of."""
    labels = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(labels)),
                       lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def tokens_of(url: Column) -> Column:
    """The distinct tokens of a URL: scheme, host labels and their parts, words of path and query."""
    def named(prefix: str, words: Column) -> Column:
        return F.transform(F.array_remove(words, ""), lambda w: F.concat(F.lit(prefix), w))

    host = host_of(url)
    scheme = lower_ascii(F.regexp_extract(url, r"(?s)^(.*?)://", 1))
    query = F.regexp_extract(url, r"(?s)^.*?://[^?#]*\?([^#]*)", 1)
    tokens = F.array_distinct(F.concat(
        named("scheme:", F.array(scheme)), named("host:", F.split(host, r"\.")),
        named("host:", F.split(host, "[^a-z0-9]+")), named("path:", F.split(path_of(url), "[^A-Za-z0-9]+")),
        named("query:", F.split(query, "[^A-Za-z0-9]+"))))
    return F.coalesce(F.when(url.contains("://"), tokens), F.array().cast("array<string>"))


def list_rules(spark: SparkSession, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """(verdict, 'host/path') pairs as the table of the list."""
    rows = []
    for verdict, rule in rules:
        host, slash, path = rule.partition("/")
        rows.append(("list", verdict, host.lower(), slash + path, None, None, None))
    return spark.createDataFrame(rows, _RULE)


def _token_classes(baskets: DataFrame, least: float) -> DataFrame:
    """(token, members, freq): one token for all that occur in the same rows of ``baskets(row, tokens, label)``,
    of those in ``least`` rows or more.

    Equal rows have equal counts and two equal sums of 64-bit hashes.  All members of a class are in one URL."""
    held = baskets.select("row", F.explode("tokens").alias("token"))
    rows = held.groupBy("token").agg(
        F.count(F.lit(1)).alias("freq"), F.bit_xor(F.xxhash64("row")).alias("h1"),
        F.bit_xor(F.xxhash64(F.lit(1), F.col("row"))).alias("h2")).filter(F.col("freq") >= least - 1e-6)
    classes = rows.groupBy("freq", "h1", "h2").agg(F.min("token").alias("token"), F.sort_array(
        F.collect_list("token")).alias("members"))
    return write_stage(classes.select("token", "members", "freq"), "url-tokens")[0]


def mine_rules(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_urls: int = MIN_URLS,
               min_confidence: float = MIN_CONFIDENCE, min_lift: float = MIN_LIFT) -> DataFrame:
    """Association rules of ``labelled(tokens array<string>, label string)``: a written table like the list's,
    with tokens in ascending order, and the token ``anchor`` that is rarest among the labelled URLs."""
    spark = labelled.sparkSession
    baskets, _ = write_stage(labelled.select(
        F.monotonically_increasing_id().alias("row"), F.array_distinct("tokens").alias("tokens"), "label"), "url-baskets")
    n = baskets.count()
    if not n:
        return spark.createDataFrame([], _RULE + ", anchor string")
    support = min(1.0, max(min_support, min_urls / n))
    classes = _token_classes(baskets, support * n)
    chosen = attach(baskets.select("row", "label", F.explode_outer("tokens").alias("token")),
                    classes.select("token", F.col("token").alias("known")), ["token"])
    items = chosen.groupBy("row").agg(F.concat(
        F.collect_list("known"), F.array(F.concat(F.lit("label:"), F.first("label")))).alias("items"))
    items, _ = write_stage(items.select("items"), "url-items")
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=min_confidence).fit(items)
    rules = model.associationRules.filter(
        F.col("consequent")[0].startswith("label:") & (F.size("antecedent") <= MAX_TOKENS)
        & (F.col("lift") >= min_lift))
    rules, _ = write_stage(rules.select(
        F.array_sort("antecedent").alias("tokens"), F.substring(F.col("consequent")[0], 7, 64).alias("verdict"),
        "confidence", "support"), "url-rules")
    # a rule goes if some part of its tokens gives the same label with the same confidence or a higher one
    parted = rules.filter("size(tokens) > 1").select("tokens", "verdict", "confidence", F.expr(
        "explode(sequence(1, shiftleft(1, size(tokens)) - 2))").alias("chosen"))
    parted = parted.withColumn("part", F.expr("filter(tokens, (t, i) -> shiftright(chosen, i) % 2 = 1)"))
    shorter = rules.select(F.col("tokens").alias("part"), "verdict", F.col("confidence").alias("as_good"))
    beaten = (parted.join(shorter, ["part", "verdict"]).filter("as_good >= confidence")
              .select("tokens", "verdict").distinct())
    kept = rules.join(beaten, ["tokens", "verdict"], "left_anti")
    # the same rule for every choice of one token of each class; the rarest token is one of the rarest class
    taken = kept.select("tokens", "verdict", F.explode("tokens").alias("token")).join(classes, "token")
    taken = taken.groupBy("tokens", "verdict").agg(F.collect_list("members").alias("choices"))
    kept = kept.join(taken, ["tokens", "verdict"]).drop("tokens")
    grown = F.expr("aggregate(choices, array(cast(array() AS array<string>)), (a, members) -> "
                   "flatten(transform(a, t -> transform(members, m -> concat(t, array(m))))))")
    kept = kept.select("verdict", "confidence", "support", F.explode(grown).alias("tokens")).withColumn(
        "tokens", F.array_sort("tokens"))
    singles = classes.select(F.explode("members").alias("token"), "freq")
    rarest = (kept.select("tokens", "verdict", F.explode("tokens").alias("token")).join(singles, "token")
              .groupBy("tokens", "verdict").agg(F.min(F.struct("freq", "token")).alias("rarest")))
    out = kept.join(rarest, ["tokens", "verdict"]).select(
        F.lit("mined").alias("kind"), "verdict", F.lit(None).cast("string").alias("host"),
        F.lit(None).cast("string").alias("path"), "tokens", "confidence", "support",
        F.col("rarest.token").alias("anchor"))
    return write_stage(out, "url-kept-rules")[0]


def judge_urls(pages: DataFrame, rules: DataFrame, mined: DataFrame, id_col: str = "page_id",
               url_col: str = "url") -> DataFrame:
    """(id, host, path, rule, verdict, method_rule, method_confidence) for each row.

    ``rule`` is the list's rule that decided, ``method_rule`` the tokens of the mined rule that did."""
    url = F.col(url_col).cast("string")
    rows, _ = write_stage(pages.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), host_of(url).alias("host"),
        path_of(url).alias("path"), tokens_of(url).alias("tokens")), "url-rows")
    listed = rules.select(F.concat(F.lit("suffix:"), "host").alias("key"), F.struct(*rules.columns).alias("rule"))
    found = mined.select(F.col("anchor").alias("key"), F.struct(*rules.columns).alias("rule"))
    index = listed.unionByName(found)
    keys = F.concat(F.transform(suffixes_of(F.col("host")), lambda s: F.concat(F.lit("suffix:"), s)), "tokens")
    asked = rows.select("row", "path", "tokens", F.explode(keys).alias("key"))
    met = attach(asked, index, ["key"]).filter("rule IS NOT NULL")
    by_list = (F.col("rule.kind") == "list") & F.col("path").startswith(F.col("rule.path"))
    by_method = ((F.col("rule.kind") == "mined")
                 & (F.size(F.array_except("rule.tokens", "tokens")) == 0))
    text = F.concat("rule.host", "rule.path")
    best = met.filter(by_list | by_method).groupBy("row").agg(
        F.max(F.when(by_list, F.struct(F.length(text).alias("length"), F.length("rule.host").alias("hosts"),
                                       F.col("rule.verdict").alias("verdict"), text.alias("rule")))).alias("listed"),
        F.max(F.when(by_method, F.struct(F.col("rule.confidence").alias("confidence"), F.col("rule.support").alias("support"),
                                         F.size("rule.tokens").alias("n"), F.col("rule.tokens").alias("tokens"),
                                         F.col("rule.verdict").alias("verdict")))).alias("mined"))
    out = rows.select("row", "id", "host", "path").join(best, "row", "left")
    open_ = F.col("listed").isNull()
    return out.select(
        F.col("id").alias(id_col), "host", "path", F.col("listed.rule").alias("rule"),
        F.coalesce("listed.verdict", "mined.verdict", F.lit("allow")).alias("verdict"),
        F.when(open_, F.array_join("mined.tokens", " ")).alias("method_rule"),
        F.when(open_, F.col("mined.confidence")).alias("method_confidence"))


def filter_urls(pages: DataFrame, labels: DataFrame, rules: Sequence[tuple[str, str]], id_col: str = "page_id",
                url_col: str = "url", label_id_col: str = "doc_id") -> DataFrame:
    """``judge_urls`` with rules mined from ``labels(doc_id, quality, toxic)`` of the pages: a page whose
    document has quality 0 or is toxic counts for ``block``, any other labelled page for ``allow``."""
    bad = F.coalesce(F.col("quality") == 0, F.lit(False)) | F.coalesce(F.col("toxic") == 1, F.lit(False))
    known = labels.filter(F.col(label_id_col).isNotNull()).groupBy(F.col(label_id_col).alias("id")).agg(
        F.max(F.when(bad, F.lit("block")).otherwise(F.lit("allow"))).alias("label"))
    urls = pages.filter(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"))
    labelled = attach(urls, known, ["id"]).filter("label IS NOT NULL").select(tokens_of(F.col("url")).alias("tokens"), "label")
    return judge_urls(pages, list_rules(pages.sparkSession, rules), mine_rules(labelled), id_col, url_col)
