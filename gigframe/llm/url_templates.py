"""URL verdicts: fixed rules first, then a tree of path templates per host.

Paths are grouped by host and shape (numbers and long hex runs become wildcards). Level
by level, the segments under a node become one wildcard where they are mostly different,
and branches that are statistically similar are merged: those with labelled urls where the
labels agree with their siblings' (two-proportion test), those without where their form
(letters or digits) is the same and as many of their urls end there (the same test). The
labelled urls are those that a rule decides. A template's purity is its share of allowed
labelled urls, smoothed towards the same template on other hosts of the domain, that towards
the host's labelled urls, and those towards a prior. Urls without a rule are blocked where
the purity of their template is low. So the label evidence of a host decides about its
unlabelled templates, the more urls of it are labelled; a host without any keeps the prior.

Everything is DataFrame functions over counts per (host, shape); single urls are only
grouped once and joined once, with a salt, so a host may hold most of all urls.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .components import written

#: Levels of the tree; deeper segments belong to the last one.
DEPTH = 4
#: A node is variable where it has more than this many different segments, and
#: more than this share of its urls have one of their own.
FEW, DIFFERENT = 20, 0.3
#: Branches differ where the test's z is beyond this.
Z = 2.58
#: Purity before any label, and in urls the weights of that, of the host and of the domain.
PRIOR, HOST_URLS, DOMAIN_URLS, URLS = 0.7, 20.0, 10.0, 5.0
LEAST = 0.4
SALTS = 32


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without '://'."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    host = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null without one.

    A rule is (verdict, 'host/path'); it fits its host and all subdomains where the
    path starts with the rule's.
    """
    rule = verdict = F.lit(None).cast("string")
    for what, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        at = text.index("/")
        name, prefix = text[:at], text[at:]
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit(prefix))
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def shape(path: Column) -> Column:
    """The path's segments with numbers as {n} and hex runs of 8 or more as {x}."""
    clean = F.regexp_replace(F.lower(path), r"/+$", "")
    clean = F.regexp_replace(clean, r"(?<![0-9a-z])(?=[a-f]*[0-9])[0-9a-f-]{8,}(?![0-9a-z])", "{x}")
    clean = F.regexp_replace(clean, r"[0-9]+", "{n}")
    return F.split(F.regexp_replace(clean, r"^/", ""), "/")


def form(seg: Column) -> Column:
    """A shape's segment with every run of letters as {w}."""
    marked = F.regexp_replace(seg, r"\{([nx])\}", "\u0001$1\u0002")
    words = F.regexp_replace(marked, "(?<!\u0001)[\\p{L}]+(?!\u0002)", "{w}")
    return F.translate(words, "\u0001\u0002", "{}")


def domain(host: Column) -> Column:
    """The last two labels of a host."""
    return F.substring_index(host, ".", -2)


def differ(hits: Column, n: Column, all_hits: Column, all_n: Column) -> Column:
    """Whether a branch's share of hits differs from that of its siblings (two-proportion test)."""
    rest = all_n - n
    p = all_hits / F.nullif(all_n, F.lit(0))
    z = ((hits / F.nullif(n, F.lit(0)) - (all_hits - hits) / F.nullif(rest, F.lit(0)))
         / F.sqrt(F.nullif(p * (1 - p), F.lit(0.0)) * (1 / F.nullif(n, F.lit(0))
                                                        + 1 / F.nullif(rest, F.lit(0)))))
    return F.coalesce(F.abs(z) > Z, F.lit(False))


def templates(counts: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(host, shape) with ``template`` and its smoothed ``purity``.

    ``counts`` has host, shape (array), n (urls), good and bad (labelled ones).
    """
    # One row per (host, shape); written per level, or the plan would double with each.
    cur = written(counts.withColumn("prefix", F.lit("")), "shapes")
    for level in range(depth):
        last = level == depth - 1
        seg = (F.array_join(F.slice(F.col("shape"), level + 1, 10**6), "/") if last
               else F.coalesce(F.try_element_at("shape", F.lit(level + 1)), F.lit("")))
        here = cur.withColumn("seg", seg)
        ends = F.when(F.lit(last) | (F.size("shape") <= level + 1), F.col("n")).otherwise(F.lit(0))
        kids = here.groupBy("host", "prefix", "seg").agg(
            F.sum("n").alias("n"), F.sum("good").alias("good"), F.sum("bad").alias("bad"),
            F.sum(ends).alias("ends"))
        kids = kids.withColumn("form", form(F.col("seg"))).withColumn(
            "labelled", F.col("good") + F.col("bad") > 0)
        all_ = W.partitionBy("host", "prefix")
        alike = W.partitionBy("host", "prefix", "labelled", "form")
        kids = (kids.withColumn("kinds", F.count("*").over(all_))
                .withColumn("urls", F.sum("n").over(all_))
                .withColumn("g", F.sum("good").over(all_)).withColumn("b", F.sum("bad").over(all_))
                .withColumn("alike_n", F.sum("n").over(alike))
                .withColumn("alike_ends", F.sum("ends").over(alike)))
        variable = (F.col("kinds") > FEW) & (F.col("kinds") > DIFFERENT * F.col("urls"))
        by_label = differ(F.col("good"), F.col("good") + F.col("bad"), F.col("g"), F.col("g") + F.col("b"))
        by_ends = differ(F.col("ends"), F.col("n"), F.col("alike_ends"), F.col("alike_n"))
        alone = (F.when(~F.col("labelled") & by_ends, F.col("seg"))
                 .when(~F.col("labelled"), F.concat(F.lit("{unlabelled}"), F.col("form")))
                 .when(by_label, F.col("seg")).otherwise(F.lit("{similar}")))
        # The end of a path is a branch of its own; a lone child needs no test.
        branch = (F.when(F.col("seg") == "", F.lit("")).when(variable, F.lit("*"))
                  .when(F.col("kinds") == 1, F.col("seg")).otherwise(alone))
        kids = kids.select("host", "prefix", "seg", branch.alias("branch"))
        cur = here.join(kids, ["host", "prefix", "seg"]).withColumn(
            "prefix", F.concat("prefix", F.lit("/"), "branch")).drop("seg", "branch")
        cur = written(cur, "shapes")
    per = cur.groupBy("host", "prefix").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))
    per = per.withColumn("seen", F.col("good") + F.col("bad")).withColumn("domain", domain(F.col("host")))
    host = per.groupBy("host").agg(((F.sum("good") + HOST_URLS * PRIOR)
                                    / (F.sum("seen") + HOST_URLS)).alias("host_purity"))
    there = per.groupBy("domain", "prefix").agg(F.sum("good").alias("all_good"),
                                                F.sum("seen").alias("all_seen"))
    like = ((F.col("all_good") - F.col("good") + DOMAIN_URLS * F.col("host_purity"))
            / (F.col("all_seen") - F.col("seen") + DOMAIN_URLS))
    per = per.join(host, "host").join(there, ["domain", "prefix"]).select(
        "host", "prefix", ((F.col("good") + URLS * like) / (F.col("seen") + URLS)).alias("purity"))
    return (cur.join(per, ["host", "prefix"])
            .select("host", "shape", F.col("prefix").alias("template"), "purity"))


def verdicts(pages: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """One row per row of ``pages`` (page_id, url).

    Columns: page_id, host, path, rule, verdict, template, purity. A null url, or one
    without '://', has host and path '' and is judged by that host's only template.
    """
    host, path = host_and_path(F.col("url"))
    rows = (pages.select("page_id", "url").withColumn("host", host).withColumn("path", path)
            .drop("url"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = (rows.withColumn("rule", rule).withColumn("ruled", verdict)
            .withColumn("shape", shape(F.col("path")))
            .withColumn("salt", F.pmod(F.xxhash64("page_id", "path"), F.lit(SALTS)).cast("int")))
    counts = rows.groupBy("host", "shape").agg(
        F.count("*").alias("n"), F.count_if(F.col("ruled") == "allow").alias("good"),
        F.count_if(F.col("ruled") == "block").alias("bad"))
    found = templates(counts).withColumn(
        "salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return (rows.join(found, ["host", "shape", "salt"])
            .select("page_id", "host", "path", "rule",
                    F.coalesce("ruled", F.when(F.col("purity") < LEAST, "block")
                               .otherwise("allow")).alias("verdict"), "template", "purity"))
