"""Fill-in-middle examples by one counted match per text.

A unit is a run of ASCII letters or any other single character. ``regexp_count`` gives the
number n of units; two draws from the hash of doc_id say after how many units the prefix and
the middle end, and the text's own pattern counts them off: a group of exactly a units, one
of b - a units, and the rest, captured in a single match and put in order by the same call.
The counted groups are possessive: a unit once taken is never given back, so the matcher
runs through them in a loop, without a stack that grows with the text.

Everything is built-in expressions: one pass, no shuffle, no Python worker.

Null text is empty; empty texts and texts that hold a marker stay plain. A null doc_id draws
from the hash of the seed alone. Repeated rows give repeated results. Other columns, whatever
their names, are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
_UNIT = "[A-Za-z]+|[^A-Za-z]"
_ORDERS = {"psm": "<P>$1<S>$3<M>$2", "spm": "<S>$3<P>$1<M>$2"}


def _draw(number: int, seed: int) -> Column:
    """The number-th group of eight hexadecimal digits of a hash of doc_id."""
    name = F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit(""))
    digits = F.sha2(F.concat(F.lit(f"{seed}:"), name), 256).substr(8 * number - 7, 8)
    return F.conv(digits, 16, 10).cast("long")


def transformed(docs: DataFrame, percent: int = 90, spm_percent: int = 20, seed: int = 1) -> DataFrame:
    """doc_id, n, form (plain, psm, spm), prefix_chars, middle_chars and output.

    ``percent`` of the texts are rearranged, ``spm_percent`` of those with the suffix first.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    counted = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"),
        F.regexp_count(text, F.lit(_UNIT)).cast("long").alias("n"),
        *(_draw(k, seed).alias(f"draw{k}") for k in range(1, 5)),
    )
    one, other = (F.col(f"draw{k}") % (F.col("n") + 1) for k in (1, 2))
    stays = (F.col("text") == "") | F.col("text").rlike("<[PSM]>") | (F.col("draw3") % 100 >= percent)
    form = F.when(stays, "plain").when(F.col("draw4") % 100 < spm_percent, "spm").otherwise("psm")
    cut = counted.select(
        "doc_id", "text", "n", form.alias("form"),
        F.least(one, other).cast("string").alias("before"),
        F.abs(one - other).cast("string").alias("between"),
    )
    pattern = F.concat(
        F.lit(f"(?s)\\A((?:{_UNIT}){{"), "before", F.lit(f"}}+)((?:{_UNIT}){{"), "between", F.lit("}+)(.*)\\z")
    )
    order = F.when(F.col("form") == "psm", _ORDERS["psm"]).otherwise(_ORDERS["spm"])
    moved = F.when(F.col("form") == "plain", F.col("text")).otherwise(F.regexp_replace("text", pattern, order))
    out = cut.select("doc_id", "n", "form", moved.alias("output"))
    at = {mark: F.instr("output", mark) for mark in (PREFIX, SUFFIX, MIDDLE)}
    prefix = F.when(F.col("form") == "psm", at[SUFFIX]).when(F.col("form") == "spm", at[MIDDLE]) - at[PREFIX] - 3
    middle = F.when(F.col("form") != "plain", F.char_length("output") - at[MIDDLE] - 2)
    return out.select(
        "doc_id", "n", "form", prefix.cast("long").alias("prefix_chars"),
        middle.cast("long").alias("middle_chars"), "output",
    )


def restored(output: Column, form: Column) -> Column:
    """The text an output was made from. No marker occurs in such a text, and none can
    arise across the joints, so the three markers found are the ones put in."""
    psm = F.regexp_replace(output, r"(?s)\A<P>(.*?)<S>(.*?)<M>(.*)\z", "$1$3$2")
    spm = F.regexp_replace(output, r"(?s)\A<S>(.*?)<P>(.*?)<M>(.*)\z", "$2$3$1")
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
