"""I-Match fingerprints with randomised lexicons, in DataFrame operations only.

The lexicon is the terms (words, lower-cased) whose document frequency over all documents
lies in a band. As the share of documents has a lower bound, the lexicon has at most the
mean number of terms of a document divided by that bound, however many documents there are;
it is passed on as a bit set over term hashes. A document's lexicon terms are sorted and
hashed for each of 144 random subsets of the lexicon: 16 that together are the whole
lexicon, and 128 of a 512th each. A subset without terms of the document stays blank.

Likeness of two fingerprints: among the subsets that are not blank in both, the share in
which they agree. A subset agrees if no term in it was added or lost, so for small subsets
this follows the share of terms in common.

The band reaches up to half of all documents, so the terms of a group of copies, or of a
template, that holds a third of the rows are still in the lexicon. A text without any lexicon
term is fingerprinted by all its terms.

A text without terms is fingerprinted by the text itself; an empty one is blank
everywhere. Null text is empty. Null doc_id comes last in the order from the largest
doc_id down; rows with the same doc_id follow each other by text. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierstream.llm.frames import parts

_BITS = 1 << 20
_BLANK = -1
_SENTINELS = [*(f"{i:02X}!" for i in range(128)), *(f"G{i:X}!" for i in range(16))]


def term_hashes(text: Column) -> Column:
    terms = F.filter(F.split(F.lower(text), r"[\x20\x09-\x0D]+"), lambda t: t != "")
    return F.array_distinct(F.transform(terms, lambda t: F.xxhash64(t)))


def lexicon_bits(texts: DataFrame, least: float, most: float) -> str:
    """The bit set of the terms found in a share of documents from ``least`` to ``most``.

    _BITS / 64 numbers, comma-separated: the size does not depend on the data.
    """
    n = texts.count()
    frequency = texts.select(F.explode(term_hashes(F.col("text"))).alias("term")).groupBy("term").count()
    at = F.pmod(F.col("term"), F.lit(_BITS))
    words = (
        frequency.where(F.col("count").between(least * n, most * n))
        .select((at / 64).cast("int").alias("word"), F.expr(f"shiftleft(1L, CAST(pmod(term, {_BITS}) % 64 AS INT))").alias("bit"))
        .groupBy("word").agg(F.bit_or("bit").alias("bits")).collect()
    )
    bits = ["0"] * (_BITS // 64)
    for row in words:
        bits[row["word"]] = str(row["bits"])
    return ",".join(bits)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with the value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _own_terms(text: Column) -> Column:
    """All terms of a text; the text itself where it has none."""
    return _let(term_hashes(text), lambda t: F.when((F.size(t) == 0) & (text != ""), F.array(F.xxhash64(text))).otherwise(t))


def fingerprint(text: Column, bits: str) -> Column:
    """The marks of a text's lexicon terms; of all its terms where none is in the lexicon."""
    words = F.split(F.lit(bits), ",").cast("array<bigint>")  # constant: evaluated once, in planning
    word = lambda t: F.get(words, F.floor(F.pmod(t, F.lit(_BITS)) / 64).cast("int"))
    known = lambda t: F.getbit(word(t), F.pmod(F.pmod(t, F.lit(_BITS)), F.lit(64)).cast("int")) == 1
    chosen = lambda own: _let(F.filter(own, known), lambda found: F.when(F.size(found) == 0, own).otherwise(found))
    return marks(_let(_own_terms(text), chosen))


def marks(terms: Column) -> Column:
    """144 short hashes, blank where no term is in the subset."""
    names = F.transform(terms, lambda t: F.lpad(F.hex(F.xxhash64(t, F.lit(1))), 16, "0"))

    # A term's name starts with the number of its small subset; a quarter of the terms are
    # in one. The last digit is the number of its large subset.
    def placed(x: Column) -> Column:
        large = F.concat(F.lit("G"), F.substring(x, -1, 1), x)
        return F.when((x < "8") & (F.substring(x, 3, 1) < "8"), F.array(x, large)).otherwise(F.array(large))

    heads = F.split(F.lit(",".join(_SENTINELS)), ",")
    in_order = F.array_join(F.sort_array(F.concat(heads, F.flatten(F.transform(names, placed)))), "")
    found = F.split(in_order, "[0-9A-G][0-9A-F]!")
    return F.transform(
        F.slice(found, 2, len(_SENTINELS)),
        lambda x: F.when(x == "", F.lit(_BLANK)).otherwise(F.pmod(F.xxhash64(x), F.lit(1024))).cast("short"),
    )


def likeness(one: Column, other: Column) -> Column:
    """Share of agreeing subsets among those that are not blank in both; 1 for two blanks."""
    each = F.zip_with(
        one, other,
        lambda x, y: F.when((x == _BLANK) & (y == _BLANK), 0).otherwise(F.when(x == y, 1001).otherwise(1000)),
    )
    total = F.aggregate(each, F.lit(0), lambda a, x: a + x)

    def share(total: Column) -> Column:
        filled = F.floor(total / 1000)
        return F.when(filled == 0, F.lit(1.0)).otherwise((total - filled * 1000) / filled).cast("double")

    return _let(total, share)


def with_next(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Each row with ``next``, a struct of the columns of the row with the next smaller
    doc_id; after the smallest comes the largest.

    Rows are dealt into ranges of doc_id of about equal numbers of rows, and each range also
    gets the first row of the range below, so no task sees more than one range.
    """
    spark = rows.sparkSession
    n = 4 * parts(spark)
    shares = [i / n for i in range(1, n)]
    borders = rows.agg(F.percentile_approx("doc_id", shares, max(10_000, 10 * n))).first()[0] or []
    texts = F.split(F.lit(",".join(str(b) for b in sorted(set(borders)))), ",")  # constant, n - 1 numbers
    below = F.size(F.filter(texts.cast("array<bigint>"), lambda b: b <= F.col("doc_id")))
    ranged = rows.withColumn("range", below if borders else F.lit(0))
    firsts = {r["range"]: r["first"] for r in ranged.groupBy("range").agg(F.max("doc_id").alias("first")).collect()}
    order = sorted(firsts)
    # The row that opens a range also closes the range above it.
    closing = [(firsts[at], order[i + 1]) for i, at in enumerate(order[:-1])]
    if order:
        closing.append((firsts[order[-1]], order[0]))
    extra = spark.createDataFrame(closing, "closing long, range int")  # one per range
    own = ranged.withColumn("extra", F.lit(False))
    copies = rows.join(F.broadcast(extra), F.col("doc_id").eqNullSafe(F.col("closing")))
    copies = copies.select(*rows.columns, "range", F.lit(True).alias("extra"))
    window = Window.partitionBy("range").orderBy("extra", F.desc_nulls_last("doc_id"), "text")
    following = F.lead(F.struct(*columns)).over(window)
    return own.unionByName(copies).withColumn("next", following).where(~F.col("extra")).drop("range", "extra")


def edited_fingerprints(docs: DataFrame, least: float = 1 / 500, most: float = 0.5) -> DataFrame:
    """Each document's fingerprint and that of an edited text.

    The edited text is the document with its second half (code points, rounded down)
    replaced by as many of the next document's first. doc_id, n_chars, edited_sha256, both
    fingerprints, and the likeness to the edited text's and to the next document's.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    bits = lexicon_bits(texts, least, most)
    own = texts.withColumn("print", fingerprint(F.col("text"), bits))
    half = F.floor(F.char_length("text") / 2).cast("int")
    edited = F.concat(
        F.substring("text", F.lit(1), F.char_length("text") - half), F.substring(F.col("next.text"), F.lit(1), half)
    )
    pairs = with_next(own, ["text", "print"]).select(
        "doc_id", "text", edited.alias("edited"), "print", F.col("next.print").alias("next_print")
    )
    done = pairs.withColumn("edited_print", fingerprint(F.col("edited"), bits))
    written = lambda c: F.array_join(F.col(c).cast("array<string>"), " ")
    return done.select(
        "doc_id", F.char_length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        written("print").alias("fingerprint"), written("edited_print").alias("edited_fingerprint"),
        likeness(F.col("print"), F.col("edited_print")).alias("near_edited"),
        likeness(F.col("print"), F.col("next_print")).alias("near_next"),
    )
