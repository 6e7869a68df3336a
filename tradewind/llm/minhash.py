"""Fingerprints of texts by one-permutation MinHash, in built-in functions only.

The 64-bit hashes of all runs of `shingle` words are binned once, by their leading bits; a bin keeps its least
hash. An empty bin takes the value of another one (optimal densification): it asks bins in an order drawn for
it alone, the same in every text, until one is not empty: first ATTEMPTS draws of a universal hash, then all bins
in the order of a hash of both. Of each bin the low `bits` bits are stored, packed into 64-bit words. Two
fingerprints agree by chance in 1 of 2^bits bins; `likeness` takes that out.

Words are what ASCII white space parts, in lower case; fewer words than `shingle` are one run. A null
text counts as empty. Texts without a word have an empty fingerprint: like each other (1), unlike all others (0).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.llm.common import materialize

SPACE = " \t\n\x0b\x0c\r"  # parts words
BINS = 256
BITS = 8
SHINGLE = 5
ATTEMPTS = 8


def bound_to(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is computed once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def shingle_hashes(text: Column, shingle: int) -> Column:
    """Hashes of all runs of words, in order of the text; an empty array where there is no word."""
    def hashed(own: Column) -> Column:
        return F.when(own == "", F.array().cast("array<bigint>")).otherwise(
            F.transform(F.split(own, f"[{SPACE}]+"), lambda w: F.xxhash64(w)))

    def runs(own: Column) -> Column:
        whole = F.when(F.size(own) > 0, F.array(F.xxhash64(own))).otherwise(own)
        many = F.transform(F.sequence(F.lit(0), F.size(own) - shingle),
                           lambda i: F.xxhash64(*(own[i + j] for j in range(shingle))))
        return F.when(F.size(own) < shingle, whole).otherwise(many)

    plain = F.btrim(F.lower(F.coalesce(text, F.lit(""))), F.lit(SPACE))
    return bound_to(bound_to(plain, hashed), runs)


def least_of_bins(hashes: Column, bins: int) -> Column:
    """An array of `bins`: the least hash of each bin, null where it is empty."""
    shift = 64 - (bins.bit_length() - 1)

    def ends() -> Column:
        """The last hash of each bin, so that every bin has a member; it stands for an empty bin."""
        return F.transform(F.sequence(F.lit(-bins // 2), F.lit(bins // 2 - 1)),
                           lambda i: F.shiftleft(i.cast("bigint"), shift).bitwiseOR(F.lit((1 << shift) - 1)))

    def first(ordered: Column) -> Column:
        # a bin is a range of hashes, so its members stand together, the least one first
        heads = F.filter(ordered, lambda x, i: F.when(i == 0, F.lit(True)).otherwise(
            F.shiftright(x, shift) != F.shiftright(ordered[i - 1], shift)))
        return F.zip_with(heads, ends(), lambda x, end: F.nullif(x, end))

    return bound_to(F.sort_array(F.concat(hashes, ends())), first)


def densified(least: Column, bins: int) -> Column:
    """No bin is empty any more; at least one bin has a value."""
    def fill(own: Column, held: Column) -> Column:
        def ask(i: Column) -> Column:
            drawn = [own[F.xxhash64(i, F.lit(n)).bitwiseAND(F.lit(bins - 1)).cast("int")] for n in range(ATTEMPTS)]
            # the bin is kept in the low bits of what orders it
            ordered = F.transform(held, lambda j: F.xxhash64(i, j).bitwiseAND(F.lit(-bins)).bitwiseOR(j.cast("bigint")))
            return F.coalesce(*drawn, own[F.array_min(ordered).bitwiseAND(F.lit(bins - 1)).cast("int")])
        return F.transform(own, lambda x, i: F.when(x.isNull(), ask(i)).otherwise(x))

    def filled(own: Column) -> Column:
        numbers = F.filter(F.sequence(F.lit(0), F.lit(bins - 1)), lambda i: own[i].isNotNull())
        return bound_to(numbers, lambda held: fill(own, held))

    return bound_to(least, filled)


def packed(values: Column, bins: int, bits: int) -> Column:
    """The low bits of all values, in words of 64 bits, the first value highest."""
    def word(own: Column) -> Column:
        def take(i: Column) -> Column:
            parts = (F.shiftleft(own[i * (64 // bits) + n].bitwiseAND(F.lit((1 << bits) - 1).cast("bigint")), 64 - bits * (n + 1))
                     for n in range(64 // bits))
            return reduce(Column.bitwiseOR, parts)
        return F.transform(F.sequence(F.lit(0), F.lit(bins * bits // 64 - 1)), take)

    return bound_to(values, word)


def fingerprint(text: Column, bins: int = BINS, bits: int = BITS, shingle: int = SHINGLE) -> Column:
    """array<bigint>, empty for a text without words. bins: a power of 2, at least 64; bits: 1, 2, 4 or 8."""
    return bound_to(shingle_hashes(text, shingle), lambda hashes: F.when(
        F.size(hashes) == 0, F.array().cast("array<bigint>")).otherwise(
        packed(densified(least_of_bins(hashes, bins), bins), bins, bits)))


def written(print_: Column) -> Column:
    """Hex digits of a fingerprint."""
    return F.array_join(F.transform(print_, lambda x: F.lpad(F.lower(F.hex(x)), 16, "0")), "")


def likeness(a: Column, b: Column, bins: int = BINS, bits: int = BITS) -> Column:
    """Estimated Jaccard similarity of the sets of shingles, 0 to 1."""
    ones = sum(1 << (bits * n) for n in range(64 // bits))
    ones -= (1 << 64) if ones >= 1 << 63 else 0

    def differing(x: Column) -> Column:
        step = bits // 2
        while step:  # the lowest bit of each value becomes 1 where any of its bits differs
            x = x.bitwiseOR(F.shiftrightunsigned(x, step))
            step //= 2
        return F.bit_count(x.bitwiseAND(F.lit(ones)))

    unlike = F.aggregate(F.zip_with(a, b, lambda x, y: x.bitwiseXOR(y)), F.lit(0),
                         lambda total, x: total + differing(x))
    chance = 1 / (1 << bits)
    agreeing = (F.lit(bins) - unlike) / F.lit(float(bins))
    found = F.greatest(F.lit(0.0), (agreeing - chance) / (1 - chance))
    none = (F.size(a) == 0).cast("int") + (F.size(b) == 0).cast("int")
    return F.when(none == 2, 1.0).when(none == 1, 0.0).otherwise(found)


def followed(rows: DataFrame, parts: int) -> DataFrame:
    """All rows of (doc_id, row, ...) with `next_row`: the row after it by descending doc_id (nulls last), then row;
    the first one after the last. No task sees more than a range of ids."""
    order = [F.desc_nulls_last("doc_id"), F.asc("row")]
    ranged = materialize(rows.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()), "ranged")
    inside = ranged.withColumn("next_row", F.lead("row").over(Window.partitionBy("part").orderBy(*order)))
    # one row a part; the parts are as many as the session has
    heads = ranged.groupBy("part").agg(F.min(F.struct(F.col("doc_id").isNull(), -F.col("doc_id").cast("decimal(20,0)"), "row"))["row"].alias("head"))
    once_round = Window.orderBy("part")
    heads = heads.select("part", F.coalesce(F.lead("head").over(once_round), F.first("head").over(once_round)).alias("head"))
    return inside.join(heads, "part").withColumn("next_row", F.coalesce("next_row", "head")).drop("part", "head")


def fingerprints(docs: DataFrame, share: int = 3, bins: int = BINS, bits: int = BITS, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, next_doc_id of each row
    of docs (doc_id, text; further columns are not used).

    The edited text of a row has its last floor(n_chars / share) code points replaced by the first as many (or
    all) of the next row by descending doc_id; after the last comes the first. Rows that differ in text under one
    doc_id follow each other by a hash of both; rows equal in both are one row there and have equal results. Null
    ids come last. A single row follows itself. An empty table gives an empty table.
    """
    spark = docs.sparkSession
    text = F.coalesce("text", F.lit(""))
    row = F.unhex(F.sha2(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("none")), F.lit(" "), text), 256))
    rows = docs.select("doc_id", text.alias("text")).select("doc_id", "text", row.alias("row"))
    # a long row is read once: its fingerprint and length stand for it until the edit
    printed = materialize(rows.select("doc_id", "row", F.length("text").alias("n"),
                                      fingerprint(F.col("text"), bins, bits, shingle).alias("print")), "prints")
    chain = materialize(followed(printed.select("doc_id", "row", "n").distinct(), int(spark.conf.get("spark.sql.shuffle.partitions"))), "chain")
    # what the next row gives to this one: its fingerprint, and where its text begins, no more than is taken
    prints = printed.groupBy("row").agg(F.first("print").alias("print"))
    ahead = (chain.select(F.col("row").alias("asker"), F.col("next_row").alias("row")).join(prints, "row")
             .select(F.col("asker").alias("row"), F.col("print").alias("next_print")))
    take = F.expr(f"n div {share}").cast("int")
    asked = chain.select(F.col("row").alias("asker"), F.col("next_row").alias("row"), take.alias("take"))
    # the id goes along, so that both joins with the texts read one shuffle
    given = (rows.join(asked, "row").select("asker", "doc_id", F.substring(F.col("text"), F.lit(1), F.col("take")).alias("beginning"))
             .groupBy(F.col("asker").alias("row")).agg(F.first("beginning").alias("beginning"), F.first("doc_id").alias("next_doc_id")))
    found = rows.join(prints.join(ahead, "row").join(given, "row"), "row").withColumn("n", F.length("text"))
    edited = F.concat(F.substring(F.col("text"), F.lit(1), F.col("n") - take), F.col("beginning"))
    changed = found.select("doc_id", "n", "print", "next_print", "next_doc_id", edited.alias("edited"))
    both = changed.select("doc_id", "n", "print", "next_print", "next_doc_id", F.sha2("edited", 256).alias("edited_sha256"),
                          fingerprint(F.col("edited"), bins, bits, shingle).alias("edited_print"))
    return both.select(
        "doc_id", F.col("n").cast("bigint").alias("n_chars"), "edited_sha256", written(F.col("print")).alias("fingerprint"),
        written(F.col("edited_print")).alias("edited_fingerprint"),
        likeness(F.col("print"), F.col("edited_print"), bins, bits).alias("near_edited"),
        likeness(F.col("print"), F.col("next_print"), bins, bits).alias("near_next"), "next_doc_id")
