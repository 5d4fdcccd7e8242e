"""Which of many words does a text contain, as plain substrings.

A text that mentions `common-utils` also contains `common`. A few words become
array literals in a projection. Beyond that the words are indexed by one short run of
bytes each, the one that is rarest in the texts; texts are probed at their own runs, and
only the pairs found are tested. There is no all-against-all comparison in either case.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewarden.context import bounded_values, cut_lineage, small_or_shuffled

#: Bytes of an indexed run; a shorter word is its own run.
GRAM = 5
#: Texts are probed in blocks of so many bytes, so that no row holds all runs of a long text.
BLOCK = 1 << 16


def _grams(data: Column, size: int | Column) -> Column:
    """Every run of `size` bytes; none if there are fewer."""
    last = F.octet_length(data) - size + 1
    runs = F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))),
                       lambda i: F.substring(data, i, F.lit(size) if isinstance(size, int) else size))
    return F.when(last >= 1, runs).otherwise(F.array().cast("array<binary>"))


def _probes(texts: DataFrame, text: str, sizes: list[int]) -> DataFrame:
    """(_id, gram): the distinct runs of each block of each text."""
    data = F.col(text).cast("binary")
    begins = F.sequence(F.lit(1), F.greatest(F.octet_length(data), F.lit(1)), F.lit(BLOCK))
    # A block reaches into the next one, so that no run is cut in two.
    blocks = texts.select("_id", F.explode(F.transform(
        begins, lambda i: F.substring(data, i, F.lit(BLOCK + GRAM - 1)))).alias("block"))
    runs = F.array_distinct(F.concat(*[_grams(F.col("block"), n) for n in sizes]))
    return blocks.select("_id", F.explode(runs).alias("gram"))


def _nothing(df: DataFrame, kept: list[str], word: str) -> DataFrame:
    return df.select(*kept, F.lit(None).cast("string").alias(word)).filter(F.lit(False))


def contained_words(
    df: DataFrame, text: str, words: DataFrame, word: str, max_literals: int = 500
) -> DataFrame:
    """`df` without its text, one row per word of `words` that the text contains."""
    kept = [c for c in df.columns if c != text]
    words = words.select(word).filter(F.length(word) > 0)
    values = bounded_values(words, word, max_literals)
    if values is not None:
        if not values:
            return _nothing(df, kept, word)
        listed = F.array(*[F.lit(v) for v in values])
        found = F.filter(listed, lambda w: F.contains(F.col(text), w))
        return df.select(*kept, F.explode(found).alias(word))
    size = F.least(F.octet_length(word), F.lit(GRAM))
    runs = cut_lineage(words.distinct().select(
        word, F.explode(F.array_distinct(_grams(F.col(word).cast("binary"), size))).alias("gram")))
    sizes = sorted(r[0] for r in runs.select(F.octet_length("gram")).distinct().collect())
    # Written once: ids must stay, and the texts are read again for the pairs found.
    texts = cut_lineage(df.filter(F.length(text) > 0).withColumn("_id", F.monotonically_increasing_id()))
    probes = _probes(texts, text, sizes)
    wanted = small_or_shuffled(runs.select("gram").distinct())
    seen = cut_lineage(probes.join(wanted, "gram", "left_semi").groupBy("gram").agg(F.count("*").alias("n")))
    # A word all of whose runs are seen is indexed by the rarest; any other is in no text.
    index = cut_lineage(
        runs.join(small_or_shuffled(seen), "gram", "left")
        .groupBy(word)
        .agg(F.min(F.struct("n", "gram")).alias("rare"), F.count_if(F.isnull("n")).alias("unseen"))
        .filter("unseen = 0")
        .select(word, F.col("rare.gram").alias("gram"))
    )
    pairs = probes.join(small_or_shuffled(index), "gram").select("_id", word).distinct()
    return texts.join(pairs, "_id").filter(F.contains(F.col(text), F.col(word))).select(*kept, word)
