"""DuckDB SQL twins of the Spark queries (the correctness oracle).

The SQL is written from the same definitions as the Spark code, not
generated from it: labelled frames, the md5 uniform draw, the Poisson CDF
built in SQL from the class counts, min-max scaling and the naive-Bayes
closed form.  Column names and types match the Spark results.
"""

from __future__ import annotations


def hu(id_expr: str, seed) -> str:
    """The md5 uniform draw of ``counterpoise.functions.hashing.hash_uniform``."""
    return f"(('0x' || substr(md5('{seed}:' || CAST({id_expr} AS VARCHAR)), 1, 8))::BIGINT / 4294967296.0)"


def cut_draw(id_expr: str, copy_expr, seed) -> str:
    """The draw of a row's copy for PCARD's cut rows."""
    return hu(f"CAST({id_expr} AS VARCHAR) || ':' || CAST({copy_expr} AS VARCHAR)", f"cuts-{seed}")


def _doc(target: str) -> str:
    def cnt(pattern):
        return f"CAST(length(d.text) - length(regexp_replace(d.text, '{pattern}', '', 'g')) AS DOUBLE)"

    return f"""SELECT l.doc_id AS id, CAST(l.{target} AS DOUBLE) AS label,
  [CAST(d.n_chars AS DOUBLE), {cnt(chr(10))} + 1.0, {cnt(' ')}, {cnt('[0-9]')}, {cnt('[A-Z]')}] AS features
FROM labels l JOIN documents d ON l.doc_id = d.doc_id"""


LP = {
    "emb": "SELECT vec_id AS id, CAST(label = 0 AS DOUBLE) AS label, CAST(embedding AS DOUBLE[]) AS features FROM embeddings",
    "toxic": _doc("toxic"),
    "quality": _doc("quality"),
    "orders": """SELECT o.o_orderkey AS id, CAST(o.o_orderpriority = '1-URGENT' AS DOUBLE) AS label,
  [o.o_totalprice, CAST(coalesce(li.n_lines, 0) AS DOUBLE), coalesce(li.sum_qty, 0.0), coalesce(li.max_disc, 0.0), coalesce(li.max_tax, 0.0)] AS features
FROM orders o LEFT JOIN (SELECT l_orderkey, count(*) AS n_lines, sum(l_quantity) AS sum_qty,
                           max(l_discount) AS max_disc, max(l_tax) AS max_tax
                    FROM lineitem GROUP BY l_orderkey) li ON o.o_orderkey = li.l_orderkey""",
}


def split_sql(frame: str, part: str, fraction: float, seed) -> str:
    op = "<" if part == "train" else ">="
    return f"SELECT * FROM ({LP[frame]}) WHERE {hu('id', seed)} {op} {fraction!r}"


def ros_copies_ctes(src: str, rate: float, seed, prefix: str = "r") -> str:
    """CTEs ``{p}_cnt, {p}_par, {p}_cdf, {p}_copies`` over the relation ``src``
    (columns id, label, ...).  ``{p}_copies`` = src rows with binary labels + copies."""
    p = prefix
    return f"""{p}_cnt AS (SELECT count_if(label = 0) AS n0, count_if(label = 1) AS n1 FROM {src}),
{p}_par AS (SELECT CASE WHEN n1 > n0 THEN 0.0 ELSE 1.0 END AS minority,
                   CASE WHEN n1 > n0 THEN CAST(n1 AS DOUBLE) * {float(rate)!r} / CAST(n0 AS DOUBLE)
                        ELSE CAST(n0 AS DOUBLE) * {float(rate)!r} / CAST(n1 AS DOUBLE) END AS lam FROM {p}_cnt),
{p}_pmf AS (SELECT t.k, exp(-lam + t.k * ln(lam) - lgamma(t.k + 1)) AS pk
            FROM {p}_par, range(0, 100000) t(k) WHERE t.k <= lam + 10 * sqrt(lam) + 20),
{p}_cdf AS (SELECT k, sum(pk) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS c FROM {p}_pmf),
{p}_u AS (SELECT s.*, {hu('s.id', seed)} AS u FROM {src} s WHERE s.label IN (0, 1)),
{p}_copies AS (SELECT x.* EXCLUDE (u),
    CAST(CASE WHEN x.label = (SELECT minority FROM {p}_par)
              THEN (SELECT count(*) FROM {p}_cdf WHERE {p}_cdf.c <= x.u) ELSE 1 END AS INTEGER) AS copies
  FROM {p}_u x)"""


def rus_ctes(src: str, seed, prefix: str = "u") -> str:
    p = prefix
    return f"""{p}_cnt AS (SELECT count_if(label = 0) AS n0, count_if(label = 1) AS n1 FROM {src}),
{p}_par AS (SELECT CASE WHEN n1 > n0 THEN 1.0 ELSE 0.0 END AS majority,
                   CASE WHEN n1 > n0 THEN CAST(n0 AS DOUBLE) / CAST(n1 AS DOUBLE)
                        ELSE CAST(n1 AS DOUBLE) / CAST(n0 AS DOUBLE) END AS fraction FROM {p}_cnt),
{p}_kept AS (SELECT s.* FROM {src} s, {p}_par
  WHERE s.label IN (0, 1) AND (s.label <> majority OR {hu('s.id', seed)} < fraction))"""


def long_form(src: str) -> str:
    """(id, label, j, x) rows of an array-feature relation."""
    return f"SELECT id, label, UNNEST(range(0, len(features))) AS j, UNNEST(features) AS x FROM {src}"


def minmax_ctes(fit_src: str, prefix: str = "m") -> str:
    """``{p}_range(j, lo, hi)`` fitted on ``fit_src`` (long form)."""
    return f"{prefix}_range AS (SELECT j, min(x) AS lo, max(x) AS hi FROM ({long_form(fit_src)}) GROUP BY j)"


def scaled_long(src: str, prefix: str = "m") -> str:
    return f"""SELECT l.id, l.label, l.j,
  CASE WHEN r.hi > r.lo THEN least(greatest((l.x - r.lo) / (r.hi - r.lo), 0.0), 1.0) ELSE 0.0 END AS x
FROM ({long_form(src)}) l JOIN {prefix}_range r ON l.j = r.j"""
