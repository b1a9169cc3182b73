"""Fill-in-the-middle documents by counted quantifiers, in one match per document.

A document is a sequence of units (``[A-Za-z]+|[^A-Za-z]``).  ``regexp_count`` gives
their number n; two draws from the document's id cut it after a and after b units.  The
pattern of a row is then ``\\A((?:unit){a}+)((?:unit){b-a}+)(.*)\\z``: one match captures
prefix, middle and suffix, and one replacement writes them in their new order.  The
quantifiers are possessive: the engine repeats the unit in a loop and keeps no way back,
so a text of a million units needs neither stack nor retries, and nothing of the text
leaves the JVM.

Forms: ``psm`` is ``<P>`` prefix ``<S>`` suffix ``<M>`` middle; ``spm`` is ``<S>`` suffix
``<P>`` prefix ``<M>`` middle; ``plain`` is the text itself.

Defined cases: a null text counts as empty; an empty text, and one that holds a mark
(``<P>``, ``<S>``, ``<M>``), stays plain; a null id draws as the empty string; rows that
repeat an id draw alike, each for its own text; an empty table gives an empty result.
Columns of the input with the names of the result's are replaced, others are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNIT = "[A-Za-z]+|[^A-Za-z]"
_ONE = "(?:[A-Za-z]++|[^A-Za-z])"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARK = "<[PSM]>"


def draw(id_col: Column, i: int, seed: int = 1) -> Column:
    """The i-th (from 0) 8-digit group of the hex sha256 of ``seed:id`` as an unsigned integer."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))), 256)
    return F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long")


def fim_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", plain_percent: int = 10, spm_percent: int = 20,
                  seed: int = 1) -> DataFrame:
    """``(doc_id, n, form, prefix_chars, middle_chars, text, output)``: one projection, no shuffle.

    ``plain_percent`` of the documents stay as they are; of the others ``spm_percent``
    give the suffix first.
    """
    i = F.col(id_col)
    text = docs.select(i.alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    drawn = text.select("doc_id", "text", F.regexp_count("text", F.lit(UNIT)).cast("long").alias("n"),
                        *[draw(F.col("doc_id"), k, seed).alias(f"_h{k + 1}") for k in range(4)])
    one, two = F.col("_h1") % (F.col("n") + 1), F.col("_h2") % (F.col("n") + 1)
    plain = (F.col("text") == "") | F.col("text").rlike(MARK) | (F.col("_h3") % 100 >= 100 - plain_percent)
    formed = drawn.select(
        "doc_id", "text", "n",
        F.when(plain, "plain").when(F.col("_h4") % 100 < spm_percent, "spm").otherwise("psm").alias("form"),
        F.concat(F.lit("(?s)\\A("), F.lit(_ONE + "{"), F.least(one, two).cast("string"), F.lit("}+)("),
                 F.lit(_ONE + "{"), F.abs(one - two).cast("string"), F.lit("}+)(.*)\\z")).alias("_pattern"),
    )
    order = F.when(F.col("form") == "psm", f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2").otherwise(f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2")
    out = formed.withColumn("output", F.when(F.col("form") == "plain", F.col("text")).otherwise(F.regexp_replace("text", F.col("_pattern"), order)))
    # The text holds no mark, so a mark's first place in the output is where it was put.
    p, s, m = (F.expr(f"locate('{x}', output)") for x in (PREFIX, SUFFIX, MIDDLE))
    return out.select(
        "doc_id", "n", "form",
        F.when(F.col("form") == "psm", s - 4).when(F.col("form") == "spm", m - p - 3).cast("long").alias("prefix_chars"),
        F.when(F.col("form") != "plain", F.char_length("output") - m - 2).cast("long").alias("middle_chars"),
        "text", "output",
    )


def restored(output: Column, form: Column) -> Column:
    """The text of an output, from the output and its form alone."""
    back = F.regexp_replace(output, F.lit(f"(?s)\\A(?:{PREFIX}|{SUFFIX})(.*?)(?:{SUFFIX}|{PREFIX})(.*?){MIDDLE}(.*)\\z"),
                            F.when(form == "psm", "$1$3$2").otherwise("$2$3$1"))
    return F.when(form == "plain", output).otherwise(back)


def fim_digests(docs: DataFrame, **options) -> DataFrame:
    """The documents' forms, cuts and digests of the output and of the text rebuilt from it."""
    out = fim_documents(docs, **options)
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                      F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


def duckdb_sql() -> str:
    """The same over lists of units; DuckDB's engine has no counted quantifier beyond 1000."""
    group = "('0x' || substr(sha256('1:' || coalesce(doc_id::VARCHAR, '')), {}, 8))::BIGINT"
    return f"""
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
         {group.format(1)} AS h1, {group.format(9)} AS h2, {group.format(17)} AS h3, {group.format(25)} AS h4
  FROM documents),
placed AS (
  SELECT *, len(u)::BIGINT AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM cut),
parts AS (
  SELECT doc_id, text, n, form, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:b], '') AS m, array_to_string(u[b + 1:n], '') AS s FROM placed),
made AS (
  SELECT *, CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END AS o FROM parts)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p)::BIGINT END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m)::BIGINT END AS middle_chars,
       sha256(o) AS output_sha256, sha256(text) AS restored_sha256
FROM made
"""
