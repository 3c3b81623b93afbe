"""URL filter: rules first, gradient-boosted trees on lexical features for the rest. Only DataFrame expressions.

The trees are trained on labelled URLs, a sample bounded by ``sample_rows`` in the order of a seeded hash. In the query
the labelled URLs are those that a rule decides. Suffix statistics (the share of blocked URLs and the number of labelled URLs of a
host's last label) are counted over all labelled URLs; the MAX_SUFFIXES best known ones are broadcast.

Defined cases: a null URL or one without ``://`` has an empty host and path and goes to the trees with the features of its
text (null: of an empty text); very long URLs are read whole; repeated rows are judged alike; an empty table gives no rows; no labelled
URL: all allowed; columns named like an output column are replaced, others may have any name.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltworks.llm.boosted_trees import fit, margin
from siltworks.llm.common import packed

#: Bound of the table of suffix statistics, which is broadcast.
MAX_SUFFIXES = 100_000

#: (verdict, host, path); the longest that fits wins.
Rules = list[tuple[str, str, str]]


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), string.ascii_uppercase, string.ascii_lowercase)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(host: Column, path: Column, rules: Rules) -> tuple[Column, Column]:
    """(rule's text, its verdict), null where none fits. Rules are tried from the longest."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for said, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, h + p).otherwise(name), F.when(fits, said).otherwise(verdict)
    return name, verdict


def lexical_features(url: Column, host: Column, path: Column) -> list[Column]:
    """Length, depth, digit ratio, entropy, parameter counts, labels and hyphens of the host."""
    url = F.coalesce(url, F.lit(""))
    n = F.greatest(F.length(url), F.lit(1))
    letters = F.split(url, "")
    entropy = F.aggregate(
        F.array_distinct(letters), F.lit(0.0),
        lambda total, c: total - F.when(c == "", 0.0).otherwise((F.length(url) - F.length(F.replace(url, c, F.lit("")))) / n * F.log2((F.length(url) - F.length(F.replace(url, c, F.lit("")))) / n)),
    )
    count = lambda c, what: F.length(c) - F.length(F.translate(c, what, ""))
    return [
        F.length(url).cast("double"), count(path, "/").cast("double"), count(url, string.digits) / n, entropy, count(url, "=").cast("double"), count(url, "&").cast("double"),
        F.length(host).cast("double"), count(host, ".").cast("double"), count(host, "-").cast("double"), count(path, string.digits).cast("double"), F.length(F.regexp_extract(path, r"^/([^/]*)", 1)).cast("double"),
        url.startswith("https").cast("double"),
    ]


def url_filter(pages: DataFrame, rules: Rules, labelled: DataFrame | None = None, url: str = "url", sample_rows: int = 20_000, seed: int = 4) -> DataFrame:
    """pages with host, path, rule, verdict (allow or block) and score (over 0: block).

    labelled: frame with columns url and blocked (0 or 1); by default the URLs of pages that a rule decides.
    """
    new = ("host", "path", "rule", "verdict", "score")
    rows, carried = packed(pages, new)
    address = F.col(f"_row.`{url}`")
    if labelled is None:
        labelled = pages.select(F.col(f"`{url}`").alias("url"), (rule_for(*host_and_path(F.col(f"`{url}`")), rules)[1] == "block").cast("int").alias("blocked")).where("blocked is not null")
    h, p = host_and_path(F.col("url"))
    suffix = lambda host: F.regexp_extract(host, r"([^.]*)$", 1)
    told = labelled.groupBy(suffix(h).alias("_suffix")).agg(F.sum("blocked").alias("n_blocked"), F.count("*").alias("n"))
    # the best known suffixes, so many at most that they can be broadcast; a suffix beyond them counts as unknown
    statistics = told.orderBy(F.desc("n"), "_suffix").limit(MAX_SUFFIXES).select("_suffix", ((F.col("n_blocked") + 1) / (F.col("n") + 2)).alias("_share"), F.log1p("n").alias("_known"))

    def featured(df: DataFrame, address: Column, host: Column, path: Column) -> tuple[DataFrame, Column]:
        joined = df.withColumn("_suffix", suffix(host)).join(F.broadcast(statistics), "_suffix", "left")
        return joined, F.array(*lexical_features(address, host, path), F.coalesce("_share", F.lit(0.5)), F.coalesce("_known", F.lit(0.0)))

    sample = labelled.select("url", "blocked").orderBy(F.xxhash64(F.lit(seed), "url"), "url", "blocked").limit(sample_rows).persist()
    train, x = featured(sample, F.col("url"), h, p)
    trees = fit(train.select(x.alias("x"), F.col("blocked")), "x", "blocked")
    sample.unpersist()
    host, path = host_and_path(address)
    known, x = featured(rows.withColumns({"_host": host, "_path": path}), address, F.col("_host"), F.col("_path"))
    score = margin(trees, [F.col("_x")[i] for i in range(14)])
    rule, said = rule_for(F.col("_host"), F.col("_path"), rules)
    judged = known.withColumn("_x", x).withColumns({"_rule": rule, "_said": said, "_score": score})
    verdict = F.coalesce("_said", F.when(F.col("_score") > 0, "block").otherwise("allow"))
    return judged.select(*(F.col(f"_row.`{c}`") for c in carried), F.col("_host").alias("host"), F.col("_path").alias("path"), F.col("_rule").alias("rule"), verdict.alias("verdict"), F.col("_score").alias("score"))
