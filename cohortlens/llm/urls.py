"""URL filter: per host a tree of path templates, judged by labelled purity.

Variable segments (numbers, hex strings, dates) become wildcards at once; then, level
by level, a literal branch is merged into its parent's wildcard if its share of good
labels does not differ from its parent's by more than chance (two-proportion z-test),
however many branches there are; one without labels does not differ. Names with digits
are literal, and their wildcard keeps the extension. What is left per host are
templates with pooled label counts. A template is rejected if
its purity, smoothed towards the share of good labels overall, is below
`MIN_PURITY`. Listed rules overrule the method.

Defined results: a null url or one without `://` has an empty host and path and is
judged like any other template; a host without labels has the overall share.
Labels of a page are counted once per page row. Empty tables give empty tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cohortlens.llm.common import ascii_lower, keep

# Listed rules as (verdict, host, path).
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"),
         ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))

SAME_Z = 1.96         # branches closer than this to their parent are alike
PRIOR = 10.0          # weight of the overall share, in labels
MIN_PURITY = 0.5
WILD = "*"

_VARIABLE = (r"^(?:[0-9]+|[0-9a-fA-F]{8,}|[0-9A-Fa-f]{8}-[0-9A-Fa-f-]{27}|[0-9]{4}-[0-9]{2}(?:-[0-9]{2})?"
             r")(\.[A-Za-z][A-Za-z0-9]{0,4})?$")
# Names with digits, ids among them: literal until they are merged.
_MIXED = r"^[A-Za-z_-]*[0-9][0-9A-Za-z_-]*(\.[A-Za-z][A-Za-z0-9]{0,4})?$"


def parts(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return (ascii_lower(F.regexp_extract(rest, r"^[^/?#]*", 0)),
            F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1))


def listed(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Longest rule that fits, and its verdict; null if none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, h, p in sorted(rules, key=lambda r: len(r[1]) + len(r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, what).otherwise(verdict)
    return rule, verdict


def _segments(path: Column) -> Column:
    """Non-empty segments; variable ones as a wildcard that keeps its extension."""
    return F.transform(F.filter(F.split(path, "/"), lambda s: s != ""),
                       lambda s: F.when(s.rlike(_VARIABLE), F.concat(F.lit(WILD), F.regexp_extract(s, _VARIABLE, 1)))
                       .otherwise(s))


def template_tree(paths: DataFrame) -> DataFrame:
    """host, shape, template for every distinct path shape.

    paths: host, shape (array of segments), n, good, bad; one row per shape.
    """
    depth = paths.agg(F.coalesce(F.max(F.size("shape")), F.lit(0))).first()[0]
    rows = paths.withColumn("template", F.array().cast("array<string>"))
    for level in range(depth):
        seg = F.get(F.col("shape"), F.lit(level))
        here = rows.withColumn("seg", seg)
        branch = (here.where("seg is not null").groupBy("host", "template", "seg")
                  .agg(*[F.sum(c).alias(c) for c in ("n", "good", "bad")]))
        node = branch.groupBy("host", "template").agg(
            F.count(F.lit(1)).alias("branches"), *[F.sum(c).alias(f"all_{c}") for c in ("n", "good", "bad")])
        judged = branch.join(node, ["host", "template"])
        own, everyone = F.col("good") + F.col("bad"), F.col("all_good") + F.col("all_bad")
        others = everyone - own
        share = F.col("all_good") / F.when(everyone > 0, everyone)
        spread = share * (1 - share) * (1 / F.when(own > 0, own) + 1 / F.when(others > 0, others))
        gap = F.col("good") / F.when(own > 0, own) - (F.col("all_good") - F.col("good")) / F.when(others > 0, others)
        differs = F.coalesce(gap * gap > SAME_Z * SAME_Z * spread, F.lit(False))
        merged = ~differs & (F.col("branches") > 1)
        wild = F.concat(F.lit(WILD), F.regexp_extract("seg", _MIXED, 1))
        names = judged.select(F.col("host").alias("h"), F.col("template").alias("p"), F.col("seg").alias("s"),
                              F.when(merged, wild).otherwise(F.col("seg")).alias("name"))
        rows = (here.join(names, (F.col("host") == F.col("h")) & (F.col("template") == F.col("p"))
                          & (F.col("seg") == F.col("s")), "left")
                .select("host", "shape", "n", "good", "bad",
                        F.when(F.col("name").isNull(), F.col("template"))
                        .otherwise(F.concat("template", F.array("name"))).alias("template")))
        rows = keep(rows, "paths")
    return rows


def judge_urls(pages: DataFrame, labels: DataFrame, rules=RULES, min_purity: float = MIN_PURITY) -> DataFrame:
    """page_id, host, path, template, purity, rule and verdict of every page.

    labels: page_id, good (boolean).
    """
    host, path = parts(F.col("url"))
    rows = (pages.select("page_id", host.alias("host"), path.alias("path"))
            .withColumn("shape", _segments(F.col("path"))))
    known = (labels.where("good is not null and page_id is not null").groupBy("page_id")
             .agg(F.min("good").alias("is_good")))
    seen = rows.select("page_id", "host", "shape").join(known, "page_id", "left")
    paths = keep(seen.groupBy("host", "shape").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("is_good").alias("good"),
        F.count_if(~F.col("is_good")).alias("bad")), "paths")
    total = paths.agg(F.coalesce(F.sum("good"), F.lit(0)), F.coalesce(F.sum("bad"), F.lit(0))).first()
    overall = total[0] / (total[0] + total[1]) if total[0] + total[1] else 1.0

    tree = template_tree(paths)
    pooled = tree.groupBy("host", "template").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))
    purity = (F.col("good") + PRIOR * overall) / (F.col("good") + F.col("bad") + PRIOR)
    judged = (tree.select("host", "shape", "template")
              .join(pooled.select("host", "template", purity.alias("purity")), ["host", "template"]))
    rule, verdict = listed(F.col("host"), F.col("path"), rules)
    method = F.when(F.col("purity") < min_purity, "block").otherwise("allow")
    return (rows.join(judged, ["host", "shape"], "left")
            .select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, method).alias("verdict"),
                    F.concat(F.lit("/"), F.array_join("template", "/")).alias("template"),
                    F.round("purity", 6).alias("purity")))


def labels_by_number(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """Labels of the document that a url ends in, as labels of the page."""
    _, path = parts(F.col("url"))
    number = F.regexp_extract(path, r"/0*([0-9]{1,18})(?:\.[A-Za-z0-9]+)?/?$", 1)
    numbered = pages.select("page_id", number.alias("_n")).selectExpr("page_id", "try_cast(_n as bigint) as doc_id")
    good = (F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)
    return numbered.join(labels.select("doc_id", good.alias("good")), "doc_id").select("page_id", "good")


def urls_digest(pages: DataFrame, labels: DataFrame) -> DataFrame:
    return judge_urls(pages, labels_by_number(pages, labels))
