"""Fill-in-middle transformation by counted-quantifier regular expressions.

A text is a sequence of units (lines by default) that a regular expression
matches left to right.  ``regexp_count`` gives their number n; two hashes of
the row's id choose the cuts a <= b; and a pattern of the row's own,

    \\A((?:unit){a}+)((?:unit){b - a}+)(.*)\\z

captures prefix, middle and suffix in one match, which the replacement
rearranges as it matches.  The counted groups are possessive: the regex engine
repeats them in a loop that keeps no state to come back to, so a text of a
million lines takes no more stack than one of two.

Everything is a column expression of the row alone: no shuffle, no Python, and
a lost task is simply run again.

Forms: ``psm`` writes <P>prefix<S>suffix<M>middle, ``spm`` writes
<S>suffix<P>prefix<M>middle, ``plain`` the text as it is.  Only texts that hold
no marker are rearranged, and a part of such a text beside a marker cannot
form another one, so the first occurrence of each marker is the one written
and the text can be rebuilt from output and form.

Defined cases: null counts as the empty text; empty texts and texts that hold
a marker are plain; a null id hashes as the empty string; repeated rows are
transformed alike; the cuts may coincide or lie at either end, which gives
empty parts; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

LINES = r"[^\n]*\n|[^\n]+"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"


def id_hashes(id_col: Column, seed: int, count: int = 4) -> list[Column]:
    """The first ``count`` 8-digit groups of the hex sha256 of ``seed:id``, as longs."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(count)]


def fill_in_middle(docs: DataFrame, seed: int = 7, rate: int = 100, spm: int = 50, unit: str = LINES,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n (units), form, prefix_chars, middle_chars, output, restored.

    ``rate`` percent of the texts that can be are rearranged, ``spm`` percent
    of these with the suffix first.  ``unit`` is a regular expression without
    capturing groups that matches no empty string and leaves nothing out.
    ``restored`` is rebuilt from output and form alone.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    h = id_hashes(F.col(id_col), seed)
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"),
                       *(c.alias(f"h{i + 1}") for i, c in enumerate(h)))
    rows = rows.withColumn("n", F.regexp_count("text", F.lit(unit)).cast("long"))
    holds = F.lit(False)
    for marker in (PREFIX, SUFFIX, MIDDLE):
        holds = holds | F.col("text").contains(marker)
    form = (F.when((F.col("text") == "") | holds | (F.col("h3") % 100 >= rate), "plain")
            .when(F.col("h4") % 100 < spm, "spm").otherwise("psm"))
    units = F.col("n") + 1
    rows = rows.select("doc_id", "text", "n", form.alias("form"),
                       F.least(F.col("h1") % units, F.col("h2") % units).alias("a"),
                       F.greatest(F.col("h1") % units, F.col("h2") % units).alias("b"))
    rows = rows.withColumn("output", _output(unit))
    return rows.select("doc_id", "n", "form", _chars(True).alias("prefix_chars"), _chars(False).alias("middle_chars"),
                       "output", restored(F.col("output"), F.col("form")).alias("restored"))


def _output(unit: str) -> Column:
    counted = lambda n: (F.lit(f"((?:{unit}){{"), n.cast("string"), F.lit("}+)"))
    pattern = F.concat(F.lit(r"(?s)\A"), *counted(F.col("a")), *counted(F.col("b") - F.col("a")), F.lit(r"(.*)\z"))
    order = (F.when(F.col("form") == "psm", f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2")
             .otherwise(f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2"))
    return F.when(F.col("form") == "plain", F.col("text")).otherwise(F.regexp_replace("text", pattern, order))


def _chars(prefix: bool) -> Column:
    """Code points of the prefix or the middle, read off the output."""
    out = F.col("output")
    p, s, m = (F.locate(marker, out) for marker in (PREFIX, SUFFIX, MIDDLE))
    middle = F.length(out) - m - len(MIDDLE) + 1
    size = F.when(F.col("form") == "psm", s - p).otherwise(m - p) - len(PREFIX) if prefix else middle
    return F.when(F.col("form") != "plain", size.cast("long"))


def restored(output: Column, form: Column) -> Column:
    """The text that ``output`` was made from."""
    psm = F.regexp_replace(output, rf"(?s)\A{PREFIX}(.*?){SUFFIX}(.*?){MIDDLE}(.*)\z", "$1$3$2")
    spm = F.regexp_replace(output, rf"(?s)\A{SUFFIX}(.*?){PREFIX}(.*?){MIDDLE}(.*)\z", "$2$3$1")
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def digests(transformed: DataFrame) -> DataFrame:
    """``fill_in_middle``'s rows with the texts replaced by their sha256 (lowercase hex)."""
    sha = lambda c: F.sha2(F.col(c).cast("binary"), 256).alias(f"{c}_sha256")
    return transformed.select("doc_id", "n", "form", "prefix_chars", "middle_chars", sha("output"), sha("restored"))
