"""Fill-in-the-middle transformation with counted quantifiers.

A text is cut into units (white space and the word after it; closing white space is a
unit of its own). ``regexp_count`` gives their number ``n``, a hash of the document id
two cut points ``a <= b``, and one match of a pattern made for the row,
``\\A(unit{a}+)(unit{b-a}+)(.*)\\z``, captures prefix, middle and suffix; the replacement
puts them in order between sentinels. The counted groups are possessive: they never
give units back, so a match takes time and stack independent of ``a`` beyond one pass.

Everything is a per-row expression in the JVM: no shuffle, no Python, any number of
executors may be lost. ``restore`` rebuilds the text from output and form alone.

Defined cases: a null text is empty; an empty text, and a text that holds a sentinel
itself, stays plain; a null id hashes as empty text; repeated rows and ids are
transformed row by row, equal ones equally; long texts are cut whole; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwise.llm.common import quoted

SPACE = r"\x20\x09-\x0D"
UNIT = rf"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+"
SENTINELS = ("<P>", "<S>", "<M>")


def _check(sentinels) -> None:
    """Parts can be told apart again if no sentinel overlaps another (or itself) in an output."""
    for i, x in enumerate(sentinels):
        for j, y in enumerate(sentinels):
            if not x or (i != j and x in y) or any(x.endswith(y[:k]) for k in range(1, min(len(x), len(y)))):
                raise ValueError(f"sentinels {x!r} and {y!r} may be mistaken for each other")


def _literal(s: str) -> str:
    """A string as a Java pattern."""
    return re.sub(r"([^A-Za-z0-9 ])", r"\\\1", s)


def _order(form: str, sentinels) -> list[tuple[str, int]]:
    """(sentinel, group of the cutting pattern) in output order."""
    p, s, m = zip(sentinels, (1, 3, 2))
    return [p, s, m] if form == "psm" else [s, p, m]


def _hash_part(doc_id: Column, seed: int, k: int) -> Column:
    """Group ``k`` of 8 hex digits of sha256("seed:id") as a number."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long")


def transform(docs: DataFrame, fim_percent: int = 50, spm_percent: int = 80, seed: int = 42,
              sentinels: tuple[str, str, str] = SENTINELS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n, form, output, prefix_chars, middle_chars) of every document.

    ``fim_percent`` of the texts are cut, ``spm_percent`` of these with the suffix first.
    """
    _check(sentinels)
    p, s, m = sentinels
    text, n = F.col("t"), F.col("n")
    rows = docs.select(quoted(id_col).alias("id"), F.coalesce(quoted(text_col).cast("string"), F.lit("")).alias("t"),
                       *[_hash_part(quoted(id_col), seed, k).alias(f"h{k + 1}") for k in range(4)])
    rows = rows.withColumn("n", F.regexp_count(text, F.lit(UNIT)).cast("long"))
    held = F.lit(False)
    for x in sentinels:
        held = held | F.contains(text, F.lit(x))
    form = (F.when((text == "") | held | (F.col("h3") % 100 >= fim_percent), "plain")
            .when(F.col("h4") % 100 < spm_percent, "spm").otherwise("psm"))
    first, second = F.col("h1") % (n + 1), F.col("h2") % (n + 1)
    rows = rows.select("id", "t", "n", form.alias("form"), F.least(first, second).alias("a"), F.greatest(first, second).alias("b"))
    # the unit's own quantifiers are possessive as well: a unit has one way to match
    unit = f"(?:[{SPACE}]*+[^{SPACE}]++|[{SPACE}]++)"
    pattern = F.concat(F.lit(rf"(?s)\A({unit}{{"), F.col("a").cast("string"), F.lit(rf"}}+)({unit}{{"),
                       (F.col("b") - F.col("a")).cast("string"), F.lit(r"}+)(.*)\z"))
    plan = {f: "".join(re.sub(r"([\\$])", r"\\\1", x) + f"${g}" for x, g in _order(f, sentinels)) for f in ("psm", "spm")}
    moved = F.regexp_replace(text, pattern, F.when(F.col("form") == "psm", plan["psm"]).otherwise(plan["spm"]))
    out = rows.select("id", "n", "form", F.when(F.col("form") == "plain", text).otherwise(moved).alias("output"))
    at = lambda x: F.instr("output", F.lit(x)).cast("long")
    psm, spm = F.col("form") == "psm", F.col("form") == "spm"
    prefix = F.when(psm, at(s) - at(p) - len(p)).when(spm, at(m) - at(p) - len(p))
    middle = F.when(psm | spm, F.length("output") - at(m) - len(m) + 1)
    return out.select(F.col("id").alias(id_col), "n", "form", "output", prefix.cast("long").alias("prefix_chars"),
                      middle.cast("long").alias("middle_chars"))


def restore(output: Column, form: Column, sentinels: tuple[str, str, str] = SENTINELS) -> Column:
    """The text that ``transform`` was given, from its output and form."""
    def back(f: str) -> Column:
        order = _order(f, sentinels)
        found = r"(?s)\A" + "".join(_literal(x) + ("(.*)" if x == order[-1][0] else "(.*?)") for x, _ in order) + r"\z"
        place = {g: i + 1 for i, (_, g) in enumerate(order)}
        return F.regexp_replace(output, F.lit(found), F.lit("".join(f"${place[g]}" for g in (1, 2, 3))))

    return F.when(form == "plain", output).when(form == "psm", back("psm")).otherwise(back("spm"))
