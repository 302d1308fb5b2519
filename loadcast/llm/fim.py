"""Fill-in-the-middle transformation by a counted-quantifier regular expression.

A text is a row of units: its lines, each with its line feed. ``regexp_count`` gives their number, a hash of the id
the two cuts a <= b, and a pattern made for the row, ``(unit{a}+)(unit{b-a}+)(rest)``, captures prefix, middle and
suffix in one match, whose replacement is the rearranged text. The counts are possessive: a match never steps back
into a unit, and the matcher loops over them instead of recursing, so texts of any number of lines can be cut.

Everything is a column expression; no row is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_of

# The marks and the unit.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
UNIT = r"[^\n]*\n|[^\n]+"

SEED = 7
FIM_PERCENT = 100
SPM_PERCENT = 50

# The cut text in each form, and the groups of a formed text in reading order.
_FORMED = {"psm": f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2", "spm": f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2"}
_FORMS = {
    "psm": (rf"(?s)\A{PREFIX}(.*?){SUFFIX}(.*?){MIDDLE}(.*)\z", "$1$3$2"),
    "spm": (rf"(?s)\A{SUFFIX}(.*?){PREFIX}(.*?){MIDDLE}(.*)\z", "$2$3$1"),
}


def draws(doc_id: Column, seed: int = SEED) -> list[Column]:
    """Four unsigned 32-bit numbers per id: the first 8-digit groups of the hex sha256 of ``seed:id``."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def fill_in_middle(docs: DataFrame, seed: int = SEED, fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT) -> DataFrame:
    """doc_id, text, n (units), form, output, prefix_chars, middle_chars (code points) of every row.

    ``fim_percent`` of the texts are rearranged, ``spm_percent`` of these with the suffix first (``spm``), else prefix
    first (``psm``); the others stay (``plain``: output is the text, the two lengths are null), as do empty texts and
    texts that hold a mark, so :func:`restored` is exact for all. Prefix, middle and suffix may be empty; all but an
    empty text have a unit.

    A null text is an empty one. A null doc_id is drawn for as an empty id; equal ids are cut by the same draws,
    repeated rows alike. Texts of any length are cut whole. An empty table gives no rows. Other columns are not read.
    """
    doc_id = F.col("doc_id").cast("long")
    given = docs.select(doc_id.alias("doc_id"), text_of().alias("text"))
    h = draws(F.col("doc_id"), seed)
    counted = given.withColumn("n", F.regexp_count("text", F.lit(UNIT)).cast("long")).select("*", *[x.alias(f"h{k}") for k, x in enumerate(h, 1)])
    marked = F.lit(False)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        marked = marked | F.contains("text", F.lit(mark))
    plain = (F.col("text") == "") | marked | (F.col("h3") % 100 >= fim_percent)
    form = F.when(plain, "plain").when(F.col("h4") % 100 < spm_percent, "spm").otherwise("psm")
    cuts = [F.col(c) % (F.col("n") + 1) for c in ("h1", "h2")]
    cut = counted.select("doc_id", "text", "n", form.alias("form"), F.least(*cuts).alias("a"), F.greatest(*cuts).alias("b"))
    pattern = F.format_string(rf"(?s)\A((?:{UNIT}){{%d}}+)((?:{UNIT}){{%d}}+)(.*)\z", "a", F.col("b") - F.col("a"))
    formed = F.when(F.col("form") == "psm", _FORMED["psm"]).otherwise(_FORMED["spm"])
    whole = cut.withColumn("output", F.when(F.col("form") == "plain", F.col("text")).otherwise(F.regexp_replace("text", pattern, formed)))
    # No text with a mark is cut, so the first place of each mark is the mark itself.
    at = {m: F.locate(m, F.col("output")) for m in (PREFIX, SUFFIX, MIDDLE)}
    after_prefix = F.when(F.col("form") == "psm", at[SUFFIX]).otherwise(at[MIDDLE])
    moved = F.col("form") != "plain"
    return whole.select(
        "doc_id", "text", "n", "form", "output",
        F.when(moved, after_prefix - at[PREFIX] - len(PREFIX)).cast("long").alias("prefix_chars"),
        F.when(moved, F.length("output") - at[MIDDLE] - len(MIDDLE) + 1).cast("long").alias("middle_chars"),
    )


def restored(output: Column | str, form: Column | str) -> Column:
    """The text before :func:`fill_in_middle`, from its output and form alone."""
    out, kind = (F.col(c) if isinstance(c, str) else c for c in (output, form))
    back = out
    for name, (pattern, order) in _FORMS.items():
        back = F.when(kind == name, F.regexp_replace(out, F.lit(pattern), F.lit(order))).otherwise(back)
    return back
