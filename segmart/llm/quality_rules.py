"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document; the ledger keeps the measurements and one
failure bit per rule. Policies are named sets of rules, applied later as a mask, and
ablations are sums over the few distinct masks. Built-in expressions only.

Defined results: a null or empty text has no words, all its measurements are 0, and it
fails `few_words`. Repeated rows get a row each. An empty table gives an empty ledger.
Windows of three words are compared by 64-bit hashes: for the windows of a text of
20,000 words a false match has a chance of about 1 in 10^11.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segmart.llm.common import NO_SPACE, id_and_text, words
from segmart.session import staged

NO_SYMBOLS = r"[^#*$%&|<>]+"
NO_UPPER = r"[^\p{Lu}]+"
FEW_REPEATS = 32
MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper"
)

# Bit k of a ledger belongs to the k-th rule: append new rules, never reorder.
RULES: dict[str, str] = {
    "few_words": "n_words < 50",
    "repeated_windows": "100 * n_repeat_words > 50 * n_words",
    "symbols": "100 * n_symbols > 10 * n_words",
    "duplicate_lines": "100 * n_dup_lines > 30 * n_lines",
    "upper_case": "100 * n_upper > 50 * word_chars",
    "word_length": "word_chars < 2 * n_words OR word_chars > 20 * n_words",
}

POLICIES: dict[str, tuple[str, ...]] = {
    "base-1": ("few_words", "repeated_windows"),
    "junk-1": ("few_words", "repeated_windows", "symbols", "duplicate_lines", "upper_case"),
    "junk-2": ("few_words", "repeated_windows", "symbols", "upper_case", "word_length"),
}
CURRENT = "junk-2"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is evaluated once, also where the body is a lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def kept_chars(text: Column, others: str) -> Column:
    """How many characters are left once runs of the others are gone."""
    return F.length(F.regexp_replace(text, others, ""))


def windows_of(hashes: Column) -> Column:
    """One hash per window of three words, from the hashes of the words."""
    each = F.transform(
        hashes, lambda x, i: F.xxhash64(x, F.get(hashes, i + 1), F.get(hashes, i + 2))
    )
    n = F.size(hashes)
    return F.when(n < 3, F.slice(hashes, 1, 0)).otherwise(F.slice(each, F.lit(1), n - 2))


def repeated_of(windows: Column) -> Column:
    """The windows found twice or more; texts without any leave after one pass."""
    repeats = let(
        F.sort_array(windows),
        lambda s: F.array_distinct(F.filter(s, lambda x, i: F.get(s, i - 1).eqNullSafe(x))),
    )
    all_once = F.size(F.array_distinct(windows)) == F.size(windows)
    return F.when(all_once, F.slice(windows, 1, 0)).otherwise(repeats)


def covered_words(windows: Column, repeated: Column) -> Column:
    """Words that lie in a repeated window.

    A few repeated windows are looked up one by one; with many, windows are sorted with
    their places, so that no text takes quadratic time.
    """
    def words_at(places: Column) -> Column:
        spots = F.flatten(F.transform(places, lambda p: F.array(p, p + 1, p + 2)))
        return F.size(F.array_distinct(spots))

    def shared(ordered: Column) -> Callable[[Column, Column], Column]:
        def beside_equal(x: Column, i: Column) -> Column:
            before = F.get(ordered, i - 1)["h"].eqNullSafe(x["h"])
            return before | F.get(ordered, i + 1)["h"].eqNullSafe(x["h"])

        return beside_equal

    found = F.transform(windows, lambda h, i: F.when(F.array_contains(repeated, h), i))
    looked_up = words_at(F.filter(found, lambda p: p.isNotNull()))
    placed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("p"))))
    sorted_out = let(
        placed, lambda o: words_at(F.transform(F.filter(o, shared(o)), lambda x: x["p"]))
    )
    n = F.size(repeated)
    return F.when(n == 0, F.lit(0)).when(n <= FEW_REPEATS, looked_up).otherwise(sorted_out)


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the measurements of each row.

    Each array is a column of its own, which later expressions share; as one nested
    expression it would be evaluated at every use.
    """
    rows = id_and_text(docs, id_col, text_col)
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(NO_SPACE))
    parts = rows.select("doc_id", "text", words(F.col("text")).alias("words"), lines.alias("lines"))
    scalars = {
        "n_words": F.size("words"),
        "word_chars": F.length(F.array_join("words", "")),
        "n_symbols": kept_chars(F.col("text"), NO_SYMBOLS),
        "n_dup_lines": F.size("lines") - F.size(F.array_distinct("lines")),
        "n_lines": F.size("lines"),
        "n_upper": kept_chars(F.col("text"), NO_UPPER),
    }
    hashes = F.transform("words", lambda x: F.xxhash64(x)).alias("hashes")
    counted = parts.select(
        "doc_id", hashes, *[v.cast("bigint").alias(name) for name, v in scalars.items()]
    )
    windows = counted.withColumn("windows", windows_of(F.col("hashes"))).drop("hashes")
    repeats = windows.withColumn("repeats", repeated_of(F.col("windows")))
    repeat_words = covered_words(F.col("windows"), F.col("repeats")).cast("bigint")
    return repeats.withColumn("n_repeat_words", repeat_words).select("doc_id", *MEASURES)


def mask_of(policy: str) -> int:
    names = list(RULES)
    return sum(1 << names.index(rule) for rule in POLICIES[policy])


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, the measurements, and `fail_bits` with one bit per failed rule."""
    bits = [
        F.when(F.expr(rule), F.lit(1 << k)).otherwise(F.lit(0)).cast("bigint")
        for k, rule in enumerate(RULES.values())
    ]
    total = bits[0]
    for bit in bits[1:]:
        total = total.bitwiseOR(bit)
    return measured(docs, id_col, text_col).withColumn("fail_bits", total)


def stored_ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The ledger as a written table, so that each rule is evaluated once for all policies.

    A filter on an unwritten ledger would be pushed below the measurements and repeat them.
    """
    return staged(ledger(docs, id_col, text_col), "ledger")


def passes(policy: str, fail_bits: str = "fail_bits") -> Column:
    """Whether a ledger row passes a policy."""
    return F.col(fail_bits).bitwiseAND(F.lit(mask_of(policy)).cast("bigint")) == 0


def ablations(rows: DataFrame, policy: str = CURRENT) -> DataFrame:
    """Per rule of a policy: how many rows fail it, fail it alone, and pass without it.

    Rows are counted per distinct mask first, at most 2 ** rules of them, so the ledger
    is read once and one short row per mask is shuffled.
    """
    mask = mask_of(policy)
    masks = rows.groupBy(F.col("fail_bits").bitwiseAND(F.lit(mask).cast("bigint")).alias("bits")).agg(
        F.count("*").alias("n")
    )
    names = list(RULES)
    rules = F.explode(
        F.array(*[
            F.struct(F.lit(rule).alias("rule"), F.lit(1 << names.index(rule)).cast("bigint").alias("bit"))
            for rule in POLICIES[policy]
        ])
    ).alias("r")
    each = masks.select("bits", "n", rules).select("bits", "n", "r.rule", "r.bit")
    others = F.col("bits").bitwiseAND(F.bitwise_not("bit"))

    def rows_where(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("n")).otherwise(0)).cast("bigint")

    return each.groupBy("rule").agg(
        rows_where(F.col("bits").bitwiseAND(F.col("bit")) != 0).alias("failed"),
        rows_where(F.col("bits") == F.col("bit")).alias("failed_alone"),
        rows_where(others == 0).alias("kept_without"),
    )


def passing(
    docs: DataFrame, policy: str = CURRENT, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of `docs` that pass, all columns as they were, in one pass without a shuffle."""
    whole = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs[text_col].alias("text"))
    rows = ledger(whole, "row", "text")
    # A generator, as a filter would be pushed below the measurements and repeat them.
    stays = F.when(passes(policy), F.array("doc_id"))
    return rows.select(F.explode(stays).alias("doc_id")).select("doc_id.*")
