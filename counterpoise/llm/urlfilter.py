"""URL filter: host rules first, then a path-template tree with smoothed labelled purity.

1. A url's host and path are cut out; the longest rule that fits (host and its
   subdomains, path prefix) judges the url.
2. Paths become templates: digits of a segment become ``#``, and a segment is variable,
   that is the wildcard ``*``, where fewer than ``least`` urls of its host have it at that
   place of the tree and fewer than ``least`` of all hosts together.  More data keeps
   more sections and turns none into a wildcard, however many others a host has.  The
   tree is as deep as the labelled paths; what lies below has the purity of its node.
3. Every node counts its labelled urls (allowed, blocked).  By default the urls that a
   rule judged are the labels.  Going down a host's tree, a child whose share of blocked
   urls does not differ from its parent's purity (two standard errors) is merged into
   the parent.  The children above and those below are pooled, each group by itself:
   those that do not differ from their group's purity are merged with each other; another
   child's purity is its own counts smoothed by ``k`` pseudo-urls of its group's purity
   and of the same template's purity over all hosts.  Without labels of its own it takes
   the mean of its parent's and that template's, or its parent's where no host has labels there.
4. An unruled url is blocked where its template's purity exceeds one half.

Urls are aggregated to distinct (host, raw template) rows first, so a hot host is a few
rows per template; everything is joins and sums of such rows, no host is ever collected.

Defined cases: a null url or one without ``://`` has an empty host and path and is
judged like any other host; without labels the prior is one half and nothing is
blocked; repeated rows are judged alike; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from counterpoise.llm.common import staged

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST, PSEUDO = 10, 10.0
SQL_DEPTH = 8  # the DuckDB form is written out level by level: labelled paths of up to eight segments

Rule = tuple[str, str]  # ("host/path-prefix", "allow" or "block")


def host_and_path(url: Column) -> tuple[Column, Column]:
    known = F.coalesce(url, F.lit(""))
    host = F.translate(F.regexp_extract(known, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(known, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _rule(rules: list[Rule], host: Column, path: Column, value) -> Column:
    out = F.lit(None).cast("string")
    for rule, verdict in sorted(rules, key=lambda r: len(r[0])):  # the longest is asked first
        rule_host, _, rest = rule.partition("/")
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith("/" + rest)
        out = F.when(fits, F.lit(value(rule, verdict))).otherwise(out)
    return out


def judge_urls(pages: DataFrame, rules: list[Rule], labels: DataFrame | None = None, id_col: str = "page_id", url_col: str = "url",
               least: int = LEAST, k: float = PSEUDO) -> DataFrame:
    """``(page_id, host, path, rule, verdict, template, purity)``; ``labels``: optional ``(url, blocked int)`` beside the rules'."""

    def cut(df: DataFrame, url: str) -> DataFrame:
        host, path = host_and_path(F.col(url))
        segments = F.filter(F.split(F.regexp_replace("path", "[0-9]+", "#"), "/"), lambda s: s != "")
        return df.withColumn("host", host).withColumn("path", path).withColumn("_s", segments)

    def parts(df: DataFrame) -> DataFrame:
        raw = [F.coalesce(F.get("_s", F.lit(i)), F.lit("")).alias(f"t{i}") for i in range(depth - 1)]
        tail = F.array_join(F.slice("_s", depth, F.greatest(F.size("_s"), F.lit(1))), "/").alias(f"t{depth - 1}")
        return df.select("*", *raw, tail).drop("_s")

    urls = cut(pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url")), "url")
    urls = urls.withColumn("rule", _rule(rules, F.col("host"), F.col("path"), lambda r, v: r))
    urls = urls.withColumn("ruled", _rule(rules, F.col("host"), F.col("path"), lambda r, v: v))
    more = cut(labels.select(F.col("url"), F.col("blocked").cast("int").alias("blocked")), "url") if labels is not None else None
    deepest = urls.where("ruled IS NOT NULL").agg(F.max(F.size("_s"))).first()[0] or 0
    if more is not None:
        deepest = max(deepest, more.agg(F.max(F.size("_s"))).first()[0] or 0)
    depth = deepest + 1  # and one level for all that lies deeper
    raw = [f"t{i}" for i in range(depth)]
    urls = parts(urls)
    seen = urls.groupBy("host", *raw).agg(F.count_if(F.col("ruled") == "allow").alias("a"), F.count_if(F.col("ruled") == "block").alias("b"), F.count(F.lit(1)).alias("n"))
    if more is not None:
        more = parts(more).groupBy("host", *raw).agg(F.count_if(F.col("blocked") == 0).alias("a"), F.count_if(F.col("blocked") > 0).alias("b"), F.count(F.lit(1)).alias("n"))
        seen = seen.unionByName(more).groupBy("host", *raw).agg(*[F.sum(c).alias(c) for c in ("a", "b", "n")])
    tree = staged(seen, "url-templates")

    # Variable segments, level by level: those that are rare here and everywhere become one wildcard.
    made: list[str] = []
    for i in range(depth):
        here = tree.groupBy("host", *made, f"t{i}").agg(F.sum("n").alias("_here"))
        everywhere = here.groupBy(*made, f"t{i}").agg(F.sum("_here").alias("_all"))
        kept = here.join(everywhere, [*made, f"t{i}"]).where((F.col("_here") >= least) | (F.col("_all") >= least) | (F.col(f"t{i}") == "")).select("host", *made, f"t{i}", F.lit(True).alias("_kept"))
        tree = tree.join(kept, ["host", *made, f"t{i}"], "left").withColumn(f"g{i}", F.when(F.col("_kept"), F.col(f"t{i}")).otherwise(F.lit("*"))).drop("_kept")
        made.append(f"g{i}")
        if i % 2 or i == depth - 1:  # each level reads the one before twice
            tree = staged(tree, "url-tree")

    total = tree.agg(F.coalesce(F.sum("a"), F.lit(0)), F.coalesce(F.sum("b"), F.lit(0))).first()
    prior = (total[1] + 1.0) / (total[0] + total[1] + 2.0)
    sums = [F.sum("a").cast("double").alias("na"), F.sum("b").cast("double").alias("nb")]
    hosts = tree.groupBy("host").agg(*sums)
    nodes = hosts.select("host", ((F.col("nb") + k * F.lit(prior)) / (F.col("na") + F.col("nb") + k)).alias("purity"))
    for i in range(depth):
        own = tree.groupBy("host", *made[: i + 1]).agg(*sums)
        everywhere = own.groupBy(*made[: i + 1]).agg(F.sum("na").alias("ta"), F.sum("nb").alias("tb"))
        n, p, t = F.col("na") + F.col("nb"), F.col("purity"), F.col("ta") + F.col("tb")
        shared = (F.col("tb") + k * F.lit(prior)) / (t + k)
        # |b / n - p| < 2 sqrt(p (1 - p) / n), without dividing by n.
        alike = lambda p: (n > 0) & (F.abs(F.col("nb") - p * n) < 2.0 * F.sqrt(p * (1.0 - p) * n))
        side = F.when(n == 0, 0).when(alike(p), 0).when(F.col("nb") > p * n, 1).otherwise(-1)
        placed = staged(own.join(nodes, ["host", *made[:i]]).join(everywhere, made[: i + 1]).withColumn("side", side), "url-nodes")
        pools = placed.where("side <> 0").groupBy("host", *made[:i], "side").agg(F.sum("na").alias("ga"), F.sum("nb").alias("gb"))
        placed = placed.join(pools, ["host", *made[:i], "side"], "left")
        pooled = (F.col("gb") + k * p) / (F.col("ga") + F.col("gb") + k)
        apart = (F.col("nb") + k * ((pooled + shared) / 2.0)) / (n + k)
        purity = (F.when((n == 0) & (t == 0), p).when(n == 0, (p + shared) / 2.0).when(F.col("side") == 0, p).when(alike(pooled), pooled).otherwise(apart))
        nodes = placed.select("host", *made[: i + 1], purity.alias("purity"))
    judged = tree.join(nodes, ["host", *made]).select("host", *raw, F.concat_ws("/", F.lit(""), *[F.nullif(F.col(g), F.lit("")) for g in made]).alias("template"), "purity")
    judged = staged(judged, "url-judged")
    out = urls.join(judged, ["host", *raw])
    method = F.when(F.col("purity") > 0.5, F.lit("block")).otherwise(F.lit("allow"))
    return out.select("page_id", "host", "path", "rule", F.coalesce("ruled", method).alias("verdict"), "template", "purity")


def duckdb_sql(rules: list[Rule], source: str = "pages", depth: int = SQL_DEPTH, least: int = LEAST, k: float = PSEUDO) -> str:
    """The same filter (labels from the rules) as DuckDB SQL, for labelled paths of fewer than ``depth`` segments."""

    def cases(value):
        whens = []
        for rule, verdict in sorted(rules, key=lambda r: -len(r[0])):
            rule_host, _, rest = rule.partition("/")
            whens.append(f"WHEN (host = '{rule_host}' OR ends_with(host, '.{rule_host}')) AND starts_with(path, '/{rest}') THEN '{value(rule, verdict)}'")
        return "CASE " + " ".join(whens) + " END"

    raw = [f"t{i}" for i in range(depth)]
    made = [f"g{i}" for i in range(depth)]
    raws = ", ".join([f"coalesce(s[{i + 1}], '') AS t{i}" for i in range(depth - 1)] + [f"coalesce(array_to_string(s[{depth}:], '/'), '') AS t{depth - 1}"])
    ctes = [
        f"u0 AS (SELECT page_id, coalesce(url, '') AS url, strpos(coalesce(url, ''), '://') AS cut FROM {source})",
        "u1 AS (SELECT page_id, CASE WHEN cut = 0 THEN '' ELSE substr(url, cut + 3) END AS rest FROM u0)",
        f"u2 AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host, "
        "regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u1)",
        "u3 AS (SELECT *, list_filter(string_split(regexp_replace(path, '[0-9]+', '#', 'g'), '/'), lambda x: x <> '') AS s FROM u2)",
        f"urls AS (SELECT page_id, host, path, {raws}, {cases(lambda r, v: r)} AS rule, {cases(lambda r, v: v)} AS ruled FROM u3)",
        f"w0 AS (SELECT host, {', '.join(raw)}, count(*) FILTER (WHERE ruled = 'allow') AS a, count(*) FILTER (WHERE ruled = 'block') AS b, count(*) AS n FROM urls GROUP BY ALL)",
    ]
    for i in range(depth):
        up, at = ", ".join([*made[:i], f"t{i}"]), f"t{i}"
        ctes.append(f"h{i} AS (SELECT host, {up}, sum(n) AS here FROM w{i} GROUP BY ALL)")
        ctes.append(f"k{i} AS (SELECT host, {up}, here >= {least} OR sum(here) OVER (PARTITION BY {up}) >= {least} OR {at} = '' AS kept FROM h{i})")
        ctes.append(f"w{i + 1} AS (SELECT w.*, CASE WHEN kept THEN w.{at} ELSE '*' END AS g{i} FROM w{i} w JOIN k{i} USING (host, {up}))")
    ctes.append(f"prior AS (SELECT (coalesce(sum(b), 0) + CAST(1 AS DOUBLE)) / (coalesce(sum(a), 0) + coalesce(sum(b), 0) + CAST(2 AS DOUBLE)) AS q FROM w{depth})")
    ctes.append(f"n0 AS (SELECT host, (nb + {k!r} * q) / (na + nb + {k!r}) AS purity FROM (SELECT host, CAST(sum(a) AS DOUBLE) AS na, CAST(sum(b) AS DOUBLE) AS nb "
                f"FROM w{depth} GROUP BY host), prior)")
    for i in range(depth):
        keys, up = ", ".join(made[: i + 1]), ", ".join(["host", *made[:i]])
        ctes.append(f"o{i} AS (SELECT host, {keys}, CAST(sum(a) AS DOUBLE) AS na, CAST(sum(b) AS DOUBLE) AS nb FROM w{depth} GROUP BY ALL)")
        ctes.append(f"e{i} AS (SELECT {keys}, sum(na) AS ta, sum(nb) AS tb FROM o{i} GROUP BY ALL)")
        kd = f"{k!r}::DOUBLE"
        differs = lambda p: f"abs(nb - {p} * (na + nb)) >= 2.0::DOUBLE * sqrt({p} * (1.0::DOUBLE - {p}) * (na + nb))"
        ctes.append(f"s{i} AS (SELECT *, (tb + {kd} * q) / (ta + tb + {kd}) AS shared, CASE WHEN na + nb = 0 OR NOT ({differs('purity')}) THEN 0 WHEN nb > purity * (na + nb) THEN 1 ELSE -1 END AS side "
                    f"FROM o{i} JOIN n{i} USING ({up}) JOIN e{i} USING ({keys}), prior)")
        ctes.append(f"p{i} AS (SELECT *, (sum(nb) OVER g + {kd} * purity) / (sum(na) OVER g + sum(nb) OVER g + {kd}) AS pooled FROM s{i} WINDOW g AS (PARTITION BY {up}, side))")
        ctes.append(
            f"n{i + 1} AS (SELECT host, {keys}, CASE WHEN na + nb = 0 AND ta + tb = 0 THEN purity WHEN na + nb = 0 THEN (purity + shared) / 2.0::DOUBLE WHEN side = 0 THEN purity "
            f"WHEN NOT ({differs('pooled')}) THEN pooled ELSE (nb + {kd} * ((pooled + shared) / 2.0::DOUBLE)) / (na + nb + {kd}) END AS purity FROM p{i})")
    return ("WITH " + ",\n".join(ctes) + f"\nSELECT page_id, host, path, rule, coalesce(ruled, CASE WHEN purity > 0.5 THEN 'block' ELSE 'allow' END) AS verdict "
            f"FROM urls JOIN w{depth} USING (host, {', '.join(raw)}) JOIN n{depth} USING (host, {', '.join(made)})")
