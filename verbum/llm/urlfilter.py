"""URL filters: given host and path rules, then association rules that Spark
FP-growth mines from labelled URLs.  DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from verbum.llm import common as C

# (verdict, host, path)
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/"))
BLOCK, ALLOW = "=block", "=allow"       # label items; no URL token starts with "="
MIN_ROWS = 3          # labelled URLs that a token set must stand in to become a rule


def url_parts(url) -> tuple[Column, Column, Column]:
    """Host (A-Z lower-cased), path and the rest; empty without ``://``."""
    u = F.coalesce(F.col(url), F.lit(""))
    at = F.instr(u, "://")
    rest = F.when(at > 0, u.substr(at + 3, F.length(u))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), C.UPPER, C.LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.regexp_extract(rest, r"^[^?#]*(?s)(.*)$", 1)


def rule_match(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """The longest fitting rule as ``struct(rule, verdict)``, else null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, h, p in sorted(rules, key=lambda x: (len(x[1] + x[2]), len(x[1]))):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def url_tokens(host: Column, path: Column, rest: Column) -> Column:
    """Distinct tokens of a URL: host labels and the host's last three labels,
    path words, the extension, query keys and values, and the fragment.  Digit
    runs of the path become one token, since they number the pages."""
    labels = F.filter(F.split(host, r"\."), lambda x: x != "")
    words = F.filter(F.split(F.regexp_replace(F.lower(path), r"[0-9]+", "0"), r"[^\p{L}\p{N}-]+"), lambda x: x != "")
    query = F.filter(F.split(F.lower(rest), r"[?&=#]+"), lambda x: x != "")
    tail = F.slice(labels, F.greatest(F.size(labels) - 2, F.lit(1)), 3)
    return F.array_distinct(F.concat(
        F.transform(labels, lambda x: F.concat(F.lit("h:"), x)), F.array(F.concat(F.lit("d:"), F.array_join(tail, "."))),
        F.transform(words, lambda x: F.concat(F.lit("p:"), x)), F.transform(query, lambda x: F.concat(F.lit("q:"), x))))


def token_classes(sets: DataFrame) -> DataFrame:
    """``(token, item)``: tokens that stand in the same labelled sets
    ``(set_id, tokens)`` share one item, the first of them.  A long URL's own
    tokens are one item, so that its subsets are not mined one by one."""
    where = (sets.dropDuplicates(["set_id"]).select("set_id", F.explode("tokens").alias("token")).groupBy("token")
             .agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("set_id")).alias("x"), F.bit_xor(F.xxhash64("set_id", F.lit(1))).alias("y")))
    first = where.groupBy("n", "x", "y").agg(F.min("token").alias("item"))
    return where.join(first, ["n", "x", "y"]).select("token", "item")


def in_items(sets: DataFrame, classes: DataFrame) -> DataFrame:
    """``(set_id, tokens)`` with items in place of tokens; sets without a token
    of a labelled URL go, as no rule can fire on them."""
    return (sets.dropDuplicates(["set_id"]).select("set_id", F.explode("tokens").alias("token")).join(classes, "token")
            .groupBy("set_id").agg(F.collect_set("item").alias("tokens")))


def mine_rules(labelled: DataFrame, min_support: float, min_confidence: float, min_lift: float = 1.2) -> DataFrame:
    """Rules ``(rule_id, tokens, verdict, confidence, support)`` from
    ``(tokens, label)`` rows.

    FP-growth counts token sets together with the label item; a rule stays if
    its support, confidence and lift suffice and no shorter rule with the same
    verdict, made of some of its tokens, is as confident."""
    baskets = labelled.select(F.concat("tokens", F.array("label")).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(baskets)
    rules = (model.associationRules
             .where(F.col("consequent")[0].isin(BLOCK, ALLOW) & ~F.exists("antecedent", lambda x: x.isin(BLOCK, ALLOW)))
             .where(F.col("lift") >= min_lift)
             .select(F.sort_array("antecedent").alias("tokens"), F.col("consequent")[0].alias("label"),
                     "confidence", "support"))
    rules = rules.withColumn("rule_id", F.xxhash64("tokens", "label"))
    short = rules.select("label", F.col("rule_id").alias("s"), F.col("tokens").alias("st"), F.col("confidence").alias("sc"))
    # a shorter rule is found by one of its tokens, its first
    longer = (rules.select("rule_id", "label", "tokens", "confidence", F.explode("tokens").alias("k"))
              .join(short.withColumn("k", F.col("st")[0]), ["label", "k"])
              .where((F.size("st") < F.size("tokens")) & (F.size(F.array_except("st", "tokens")) == 0) & (F.col("sc") >= F.col("confidence")))
              .select("rule_id").distinct())
    return rules.join(longer, "rule_id", "left_anti").withColumn(
        "verdict", F.when(F.col("label") == BLOCK, "block").otherwise("allow"))


def apply_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``(set_id, mined)`` for each token set that some rule fires on; the most
    confident rule speaks (ties: more support, longer, smaller id).

    Inverted index: a rule stands under its rarest token alone; the other
    tokens are compared afterwards.  Equal token sets are looked up once."""
    sets = urls.select("set_id", "tokens").dropDuplicates(["set_id"])
    posted = sets.select(F.explode("tokens").alias("token"))
    df = posted.groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    index = (rules.select("rule_id", "tokens", "verdict", "confidence", "support", F.explode("tokens").alias("token"))
             .join(df, "token", "left")
             .groupBy("rule_id").agg(
                 F.min_by("token", F.struct(F.coalesce("df", F.lit(0)), "token")).alias("token"),
                 F.first("tokens").alias("need"), F.first("verdict").alias("verdict"),
                 F.first("confidence").alias("confidence"), F.first("support").alias("support")))
    return (sets.select("set_id", "tokens", F.explode("tokens").alias("token")).join(index, "token")
            .where(F.size(F.array_except("need", "tokens")) == 0)
            .groupBy("set_id").agg(F.max_by(
                F.struct("verdict", F.array_join("need", " ").alias("why")),
                F.struct("confidence", "support", F.size("need"), (-1 - F.col("rule_id")).alias("first"))).alias("mined")))


def judge_urls(spark: SparkSession, pages: DataFrame, labels: DataFrame, rules=RULES, key: str = "page_id",
               min_support: float = 0.002, min_confidence: float = 0.6, default: str = "allow") -> DataFrame:
    """Verdict on every row of ``pages`` (``page_id``, ``url``).

    The number in a URL's path is the id of the document that the page shows;
    ``labels`` (``doc_id``, ``quality``, ``toxic``) says whether that document
    is bad (quality 0 or toxic), and FP-growth learns from those URLs.  A given
    rule decides first, then the mined rules, then ``default``.  Null URLs and
    URLs without ``://`` have an empty host and path and get the method's
    verdict; null labels count as unlabelled; repeated rows are each judged.
    With no labelled URL nothing is mined.  A rule needs at least ``MIN_ROWS``
    labelled URLs; tokens that always come together in those count as one, and
    a URL with any of them has it.  Other columns are not read."""
    host, path, rest = url_parts("url")
    urls = (pages.select(F.col(key), F.col("url"))
            .withColumn("host", host).withColumn("path", path).withColumn("tokens", url_tokens(F.col("host"), F.col("path"), rest))
            .withColumn("set_id", F.xxhash64(F.sort_array("tokens"))))
    bad = (labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id"))
           .agg(F.max(((F.col("quality") == 0) | (F.coalesce("toxic", F.lit(0)) == 1)).cast("int")).alias("bad")))
    known = (urls.withColumn("doc_id", F.regexp_extract("path", r"(?:^|/)([0-9]{1,18})(?:[./]|$)", 1).try_cast("long"))
             .join(bad, "doc_id").select("set_id", "tokens", F.when(F.col("bad") == 1, BLOCK).otherwise(ALLOW).alias("label")))
    known = C.written(spark, known, "url-labelled")
    classes = C.written(spark, token_classes(known), "url-tokens")
    baskets = known.select("set_id", "label").join(in_items(known, classes), "set_id").select("tokens", "label")
    floor = MIN_ROWS / max(known.count(), MIN_ROWS)
    rules_table = C.written(spark, mine_rules(baskets, max(min_support, floor), min_confidence), "url-rules")
    fired = apply_rules(in_items(urls.select("set_id", "tokens"), classes), rules_table)
    given = rule_match(F.col("host"), F.col("path"), rules)
    return (urls.drop("tokens").join(fired, "set_id", "left").withColumn("given", given)
            .select(key, "host", "path", F.col("given.rule").alias("rule"),
                    F.coalesce("given.verdict", "mined.verdict", F.lit(default)).alias("verdict"),
                    F.when(F.col("given").isNull(), F.col("mined.why")).alias("mined_rule")))
