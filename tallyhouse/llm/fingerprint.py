"""Document fingerprints by one-permutation MinHash, in built-in column functions only.

Every shingle is hashed once. The top bits of the hash name its bin, and the smallest hash of each bin is kept. An
empty bin takes the value of a full one, found by trying bins in an order that depends on the empty bin alone (optimal
densification), so that equal sets fill alike. Of each bin's value the low bits are packed; chance agreement of those
bits is taken out of the estimate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm.common import KEY, keyed

SHINGLE = 5
BINS = 256
BITS = 4
# Bins tried one by one; after these an expression over all bins finds the next full one.
_TRIES = 24
_WORD_BITS = 64
_NIBBLE_ONES = 0x1111111111111111


def _shape(bins: int) -> int:
    bin_bits = bins.bit_length() - 1
    if bins != 1 << bin_bits or bins * BITS % _WORD_BITS:
        raise ValueError("the number of bins has to be a power of two and fill whole 64-bit words")
    return bin_bits


def _let(value: Column, body) -> Column:
    """`body(value)` with the value worked out once: inside, it is a bound name."""
    return F.element_at(F.transform(F.array(value), body), 1)


def shingle_hashes(text: Column, size: int = SHINGLE) -> Column:
    """Hashes of the runs of `size` words, in any order, repeats included; fewer words are one run; no words, none."""
    # Java's \s and this class differ: words end at space and the five control characters after the tab.
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    marks = F.transform(words, lambda w: F.xxhash64(w))

    def runs(a: Column) -> Column:
        few = F.array(F.xxhash64(a))
        starts = F.sequence(F.lit(1), F.size(a) - (size - 1))
        many = F.transform(starts, lambda i: F.xxhash64(*[F.get(a, i + (k - 1)) for k in range(size)]))
        return F.when(F.size(a) == 0, F.array().cast("array<bigint>")).when(F.size(a) < size, few).otherwise(many)

    return _let(marks, runs)


def bin_values(hashes: Column, bins: int = BINS) -> Column:
    """The smallest hash of each bin, empty bins filled; nulls where there is no hash at all."""
    shift = 64 - _shape(bins)

    def firsts(ordered: Column) -> Column:
        # In signed order hashes of one bin (top bits) are neighbours, and the first of them is the smallest.
        return F.filter(ordered, lambda x, i: (i == 0) | (F.shiftrightunsigned(x, shift) != F.shiftrightunsigned(F.get(ordered, i - 1), shift)))

    def by_bin(heads: Column) -> Column:
        return F.map_from_arrays(F.transform(heads, lambda x: F.shiftrightunsigned(x, shift).cast("int")), heads)

    def laid_out(found: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.lit(bins - 1)), lambda b: F.try_element_at(found, b))

    def filled(full: Column) -> Column:
        def tried(b: Column, t: Column) -> Column:
            # An odd stride walks through all bins; start and stride depend on the empty bin alone.
            start = F.shiftright(b.cast("bigint") * 0x9E3779B1 + 0x7F4A7C15, 7)
            stride = F.shiftright(b.cast("bigint") * 0x85EBCA6B + 0x42B2AE35, 9).bitwiseOR(F.lit(1).cast("bigint"))
            return F.get(full, F.pmod(start + t * stride, F.lit(bins)).cast("int"))

        def fill(b: Column) -> Column:
            rest = F.filter(F.transform(F.sequence(F.lit(_TRIES), F.lit(bins - 1)), lambda t: tried(b, t)), lambda x: x.isNotNull())
            return F.coalesce(F.get(full, b), *[tried(b, F.lit(t)) for t in range(_TRIES)], F.get(rest, F.lit(0)))

        return F.transform(F.sequence(F.lit(0), F.lit(bins - 1)), fill)

    return _let(_let(_let(_let(F.sort_array(hashes), firsts), by_bin), laid_out), filled)


def packed(text: Column, bins: int = BINS) -> Column:
    """The fingerprint of a text: low bits of all bins in 64-bit words; an empty array for a text without words."""
    per_word = _WORD_BITS // BITS
    low = (1 << BITS) - 1

    def pack(values: Column) -> Column:
        words = F.sequence(F.lit(0), F.lit(bins // per_word - 1))
        return F.transform(words, lambda g: F.aggregate(
            F.slice(values, g * per_word + 1, per_word), F.lit(0).cast("bigint"),
            lambda total, v: F.shiftleft(total, BITS).bitwiseOR(v)))

    def low_bits(values: Column) -> Column:
        # Mixed with the bin's number, or bins that were filled from one bin would agree by chance all at once.
        return F.transform(values, lambda v, b: F.xxhash64(v, b).bitwiseAND(F.lit(low).cast("bigint")))

    def of(hashes: Column) -> Column:
        return F.when(F.size(hashes) == 0, F.array().cast("array<bigint>")).otherwise(
            _let(_let(bin_values(hashes, bins), low_bits), pack))

    return _let(shingle_hashes(text), of)


def as_text(words: Column) -> Column:
    return F.array_join(F.transform(words, lambda w: F.lpad(F.lower(F.hex(w)), _WORD_BITS // 4, "0")), "")


def likeness(a: Column, b: Column, bins: int = BINS) -> Column:
    """Estimated Jaccard similarity of two packed fingerprints, 0 to 1. Two empty ones are alike, one is not."""
    def unlike(x: Column) -> Column:
        x = x.bitwiseOR(F.shiftrightunsigned(x, 1))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 2))
        return F.bit_count(x.bitwiseAND(F.lit(_NIBBLE_ONES).cast("bigint")))

    apart = F.aggregate(F.zip_with(a, b, lambda x, y: unlike(x.bitwiseXOR(y))), F.lit(0), lambda total, n: total + n)
    chance = 2.0 ** -BITS
    agreed = (1 - apart / F.lit(float(bins)) - chance) / (1 - chance)
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(
        F.greatest(F.lit(0.0), agreed))


def with_next(rows: DataFrame, key: str, columns: list[str], buckets: int | None = None) -> DataFrame:
    """`rows` with `_next`: the struct of `columns` in the row with the next larger key; after the last, the first.

    Keys are distinct. Rows are dealt to buckets at quantiles of the key, and the first row of each bucket is also
    given to the bucket before it, so that no bucket needs another one and none holds more than its share.
    """
    spark = rows.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    at = [i / n for i in range(1, n)] or [1.0]
    found = rows.agg(F.min(key).alias("least"), F.percentile_approx(key, at, 20 * n + 1000).alias("cuts")).first()
    heads = sorted({found.least, *found.cuts}) if found.least is not None else [0]
    place = F.size(F.filter(F.array(*[F.lit(h).cast("bigint") for h in heads[1:]]) if heads[1:] else F.array().cast("array<bigint>"), lambda h: h <= F.col(key)))
    before = F.pmod(F.col("_bucket") - 1, F.lit(len(heads)))
    copies = F.when(F.col(key).isin(*heads), F.array(F.struct(F.col("_bucket").alias("b"), F.lit(False).alias("copy")), F.struct(before.alias("b"), F.lit(True).alias("copy"))))
    copies = copies.otherwise(F.array(F.struct(F.col("_bucket").alias("b"), F.lit(False).alias("copy"))))
    dealt = rows.withColumn("_bucket", place).withColumn("_at", F.explode(copies)).select(*rows.columns, "_at.b", "_at.copy")
    following = F.lead(F.struct(*columns)).over(Window.partitionBy("b").orderBy("copy", key))
    return dealt.withColumn("_next", following).filter(~F.col("copy")).drop("b", "copy")


def report(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", bins: int = BINS) -> DataFrame:
    """Per document: its fingerprint, that of its edited text, and how alike they and the next document's are.

    The edited text is the text with its last half replaced by the start of the next document, by id. Null text: as
    empty, whose fingerprint is empty text. Null and repeated ids: each row is a document, ordered by id (null first)
    and text. Other columns are not read. One exchange moves the texts.
    """
    rows, _ = keyed(documents, id_col, text_col)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = rows.select(KEY, F.col(id_col).alias("_id"), text.alias("_text")).withColumn("_own", packed(F.col("_text"), bins))
    rows = with_next(rows, KEY, ["_text", "_own"])
    half = F.floor(F.char_length("_text") / 2).cast("int")
    kept = F.expr("substring(_text, 1, char_length(_text) - CAST(floor(char_length(_text) / 2) AS INT))")
    rows = rows.select("_id", "_text", "_own", F.concat(kept, F.substring(F.col("_next._text"), F.lit(1), half)).alias("_edited"), F.col("_next._own").alias("_other"))
    rows = rows.withColumn("_changed", packed(F.col("_edited"), bins))
    return rows.select(
        F.col("_id").alias(id_col), F.char_length("_text").cast("bigint").alias("n_chars"), F.sha2("_edited", 256).alias("edited_sha256"),
        as_text(F.col("_own")).alias("fingerprint"), as_text(F.col("_changed")).alias("edited_fingerprint"),
        likeness(F.col("_own"), F.col("_changed"), bins).alias("near_edited"), likeness(F.col("_own"), F.col("_other"), bins).alias("near_next"))
