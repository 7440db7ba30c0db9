"""URL filter: listed rules by host and path, and for the rest association rules mined from labelled URLs."""

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, functions as F, types as T

#: (verdict, host, path) of the listed rules
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
ALLOW, BLOCK = "verdict=allow", "verdict=block"
#: support is a share of the labelled URLs
MIN_SUPPORT, MIN_CONFIDENCE = 0.002, 0.5
#: labelled URLs that a rule has to hold for at least, and deviations by which its confidence is lowered
MIN_COUNT, DEVIATIONS = 5, 1.64
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def parts(url: Column) -> tuple[Column, Column]:
    """Host and path; both empty for null and for URLs without ``://``."""
    at = F.locate("://", url)
    rest = F.coalesce(F.when(at > 0, url.substr(at + F.lit(3), F.length(url))), F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest.substr(F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


def listed_rule(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits as struct (rule, verdict), else null. ``rules`` is a parameter list, held in the plan."""
    by_host: dict[str, list] = {}
    for verdict, rule_host, rule_path in rules:
        by_host.setdefault(rule_host, []).append(
            F.struct(F.lit(rule_path).alias("path"), F.lit(verdict).alias("verdict")))
    if not by_host:
        return F.lit(None).cast("struct<rule:string,verdict:string>")
    index = F.create_map(*[x for h, own in by_host.items() for x in (F.lit(h), F.array(*own))])
    labels = F.split(host, r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    fits = F.flatten(F.transform(suffixes, lambda s: F.transform(
        F.filter(F.coalesce(F.try_element_at(index, s), F.array().cast("array<struct<path:string,verdict:string>>")),
                 lambda r: F.startswith(path, r["path"])),
        lambda r: F.struct(F.length(F.concat(s, r["path"])).alias("size"), F.concat(s, r["path"]).alias("rule"), r["verdict"].alias("verdict")))))
    best = F.array_max(fits)
    return F.when(best.isNotNull(), F.struct(best["rule"].alias("rule"), best["verdict"].alias("verdict")))


def tokens(url: Column) -> Column:
    """Sorted distinct tokens of a URL: host labels, path words and query names; numbers say nothing and are left out."""
    host, path = parts(url)
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"\?([^#]*)", 1)
    made = F.concat(
        F.transform(F.split(host, r"\."), lambda t: F.concat(F.lit("host:"), t)),
        F.transform(F.split(path, r"[/.]"), lambda t: F.concat(F.lit("path:"), t)),
        F.transform(F.split(query, "&"), lambda t: F.concat(F.lit("query:"), F.split(t, "=")[0])))
    return F.array_sort(F.array_distinct(F.filter(made, lambda t: ~F.rlike(t, F.lit(r":\d*$")))))


RULE_SCHEMA = "rule_tokens array<string>, verdict string, confidence double, support double, size int"


def mined_rules(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """Token combinations that tell a verdict, from ``url, block`` rows, as ``rule_tokens, verdict, confidence, support, size``.

    FP-growth runs on the tokens of each URL and its verdict. Kept are rules that meet support and confidence, hold for
    ``MIN_COUNT`` labelled URLs or more, beat the verdict's own frequency even by the lower bound of their confidence, and
    have no shorter rule of the same verdict inside them that is as confident. Without labelled URLs there are no rules.
    """
    spark = labelled.sparkSession
    rows = labelled.where("block is not null").select(
        F.concat(tokens(F.col("url")), F.array(F.when(F.col("block"), BLOCK).otherwise(ALLOW))).alias("items"))
    total = rows.count()
    if total < MIN_COUNT:
        return spark.createDataFrame([], RULE_SCHEMA)
    least = max(min_support, min(1.0, MIN_COUNT / total))
    model = FPGrowth(itemsCol="items", minSupport=least, minConfidence=min_confidence).fit(rows)
    # Wilson's lower bound of the confidence, from the rule's own number of URLs
    n, z2 = F.col("support") / F.col("confidence") * total, DEVIATIONS ** 2
    p = F.col("confidence")
    lowest = (p + z2 / (2 * n) - DEVIATIONS * F.sqrt(p * (1 - p) / n + z2 / (4 * n * n))) / (1 + z2 / n)
    verdict = F.col("consequent")[0]
    rules = model.associationRules.where(
        verdict.isin(ALLOW, BLOCK) & ~F.array_contains("antecedent", ALLOW) & ~F.array_contains("antecedent", BLOCK)
        & (F.col("lift") > 1) & (lowest > p / F.col("lift"))
    ).select(F.array_sort("antecedent").alias("rule_tokens"), F.substring_index(verdict, "=", -1).alias("verdict"), "confidence", "support",
             F.size("antecedent").alias("size"))
    # a rule's shorter rules share one of its tokens, so they meet there
    inside = rules.select("rule_tokens", "verdict", "confidence", F.explode("rule_tokens").alias("token"))
    shorter = rules.select(F.col("rule_tokens").alias("less"), F.col("verdict").alias("same"), F.col("confidence").alias("as_good"),
                           F.col("rule_tokens")[0].alias("first"))
    covered = inside.join(shorter, (F.col("token") == F.col("first")) & (F.col("verdict") == F.col("same"))).where(
        (F.size("less") < F.size("rule_tokens")) & (F.col("as_good") >= F.col("confidence"))
        & (F.size(F.array_except("less", "rule_tokens")) == 0)).select("rule_tokens", "verdict").distinct()
    return rules.join(covered, ["rule_tokens", "verdict"], "left_anti")


def matched(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``url_tokens, mined`` for each distinct token set of ``urls`` that a rule fits: the most confident rule's verdict.

    The index has each rule under its rarest token only.
    """
    sets = urls.select(tokens(F.col("url")).alias("url_tokens")).distinct()
    each = rules.select("*", F.explode("rule_tokens").alias("token"))
    frequency = each.groupBy("token").agg(F.count("*").alias("n"))
    index = (
        each.join(frequency, "token").groupBy("rule_tokens", "verdict", "confidence", "size")
        .agg(F.min_by("token", F.struct("n", "token")).alias("token")))
    hits = sets.select("url_tokens", F.explode("url_tokens").alias("token")).join(index, "token").where(
        F.size(F.array_except("rule_tokens", "url_tokens")) == 0)
    return hits.groupBy("url_tokens").agg(
        F.max_by("verdict", F.struct("confidence", "size", "verdict")).alias("mined"))


def url_verdicts(pages: DataFrame, labelled: DataFrame, rules=RULES, min_support: float = MIN_SUPPORT,
                 min_confidence: float = MIN_CONFIDENCE, default: str = "allow") -> DataFrame:
    """Per row of ``pages``: ``page_id, host, path, rule, verdict``.

    The longest listed rule decides; URLs without one get the verdict of the most confident mined rule, and
    where none fits, ``default``. Of mined rules that are equally confident the longer one counts, then the greater verdict
    (block). Null URLs have empty host and path and no rule; repeated rows all stay; an empty table gives no rows, and
    labels that are empty or all null no mined rules.
    """
    mined = matched(pages.select("url"), mined_rules(labelled, min_support, min_confidence))
    host, path = parts(F.col("url"))
    rows = pages.select(F.col("page_id"), F.col("url").cast("string").alias("url")).select(
        "page_id", host.alias("host"), path.alias("path"), tokens(F.col("url")).alias("url_tokens"))
    rows = rows.withColumn("listed", listed_rule(F.col("host"), F.col("path"), rules))
    return rows.join(mined, "url_tokens", "left").select(
        "page_id", "host", "path", F.col("listed.rule").alias("rule"),
        F.coalesce("listed.verdict", "mined", F.lit(default)).alias("verdict"))


def document_of(url: Column) -> Column:
    """Id of the document that a URL names: the number at the end of its path."""
    _, path = parts(url)
    return F.regexp_extract(path, r"/(\d{1,18})(\.[a-z]+)?/?$", 1).try_cast(T.LongType())


def labelled_urls(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """``url, block`` of the pages whose document has a quality label; low quality means block."""
    quality = labels.groupBy(F.col("doc_id").alias("named")).agg(F.min("quality").alias("quality"))
    return pages.select("url", document_of(F.col("url")).alias("named")).join(quality, "named").select(
        "url", (F.col("quality") == 0).alias("block"))
