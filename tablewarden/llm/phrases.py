"""Collocations from a prefix-free parse.

The words of a text are cut into chunks wherever a window of OVERLAP words hashes to a
trigger, and each chunk runs to the end of the next trigger window, so that neighbours
overlap by that window. Equal passages get equal chunks whatever stands around them. The
distinct chunks of a language and how often each was parsed form the dictionary; phrases
are counted once in each distinct chunk, weighted by that number. A phrase that begins
in the overlap belongs to the next chunk alone.

A phrase can only be frequent if its parts are. Counts of hashed phrases are therefore
added up first, in sorted runs, and leave a bit filter of a fixed size. The filter has no
false negatives, and what passes is counted again by its spelling, so counts are exact
whatever the hashes do.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tablewarden.context import cut_lineage, ship_package, small_or_shuffled
from tablewarden.llm.tables import map_batches, pa_schema, texts_of
from tablewarden.llm.words import groups, mix, scan

LONGEST = 4
OVERLAP = LONGEST - 1
MIN_COUNT = 30
TOP = 2_000
#: One window in TRIGGER begins a chunk, if the last chunk began at least SHORTEST words ago.
TRIGGER, SHORTEST = 48, 16
#: Bytes of chunks counted at a time, hashed phrases merged by one task, bits of a filter.
RUN_BYTES = 8 << 20
MERGED = 4 << 20
FILTER_LOG = 27

_PIECES = bytes.maketrans(
    b".,;:!?\x0b\x0c\r\tABCDEFGHIJKLMNOPQRSTUVWXYZ", b"\n\n\n\n\n\n\n\n\n abcdefghijklmnopqrstuvwxyz"
)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def chunks_of(text_words, data: bytes, begin: int, end: int, triggers: list[int]) -> list[bytes]:
    """The chunks of the words `begin` to `end`; the last one of a text ends in a line break."""
    starts, ends = text_words.starts, text_words.ends
    out, first = [], begin
    for t in triggers:
        if t - first >= SHORTEST:
            out.append(data[starts[first] : ends[t + OVERLAP - 1]])
            first = t
    out.append(data[starts[first] : ends[end - 1]] + b"\n")
    return out


def parse(docs: DataFrame) -> DataFrame:
    """The dictionary: lang, chunk and parsed, the number of times the chunk was parsed.

    Texts are lower-cased (A-Z); marks and line breaks are line breaks in a chunk. Null
    lang is `und`, null texts and texts without words have no chunk.
    """

    def make():
        def step(batch):
            langs = batch.column(batch.schema.get_field_index("lang")).to_pylist()
            texts = [t.translate(_PIECES) for t in texts_of(batch)]
            for low, high in groups(texts):
                found = scan(texts[low:high], fold=False)
                h = found.hashes
                window = h[:-2] * _STEP + h[1:-1] if len(h) > 2 else h[:0]
                hit = np.flatnonzero(mix(window * _STEP + h[2:]) % np.uint64(TRIGGER) == 0)
                of_text = np.searchsorted(hit, found.bounds)
                lang, chunk = [], []
                for k, (begin, end) in enumerate(found.slices()):
                    if begin == end:
                        continue
                    own = hit[of_text[k] : of_text[k + 1]]
                    own = own[own <= end - OVERLAP].tolist()
                    cut = chunks_of(found, found.data, begin, end, own)
                    chunk += cut
                    lang += [langs[low + k]] * len(cut)
                yield {"lang": lang, "chunk": chunk}
        return step

    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    parsed = map_batches(rows, "lang string, chunk string", make)
    return parsed.groupBy("lang", "chunk").agg(F.count("*").alias("parsed"))


class Run:
    """The words of some distinct chunks: ids, breaks, weights, and the bigrams they form."""

    def __init__(self, table: pa.Table):
        chunk = table.column("chunk").combine_chunks().cast(pa.large_binary())
        chunk = chunk.chunk(0) if isinstance(chunk, pa.ChunkedArray) else chunk
        offsets = np.frombuffer(chunk.buffers()[1], dtype=np.int64)[
            chunk.offset : chunk.offset + len(chunk) + 1]
        raw = np.frombuffer(chunk.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]]
        offsets = offsets - offsets[0]
        line = raw == 10
        letter = (raw != 32) & ~line
        before = np.concatenate([[False], letter[:-1]])
        before[offsets[:-1]] = False
        after = np.concatenate([letter[1:], [False]])
        after[offsets[1:] - 1] = False
        starts, ends = np.flatnonzero(letter & ~before), np.flatnonzero(letter & ~after) + 1
        bounds = np.searchsorted(starts, offsets)
        # A break lies between a word and the next if a line ends there, or the chunk.
        self.broken = np.ones(len(starts), dtype=bool)
        if len(ends) > 1:
            self.broken[:-1] = np.logical_or.reduceat(line[: ends[-1]], ends[:-1])
        self.broken[bounds[1:] - 1] = True
        self.own = np.ones(len(starts), dtype=bool)
        inner = bounds[1:][~line[offsets[1:] - 1]]
        self.own[(inner[:, None] - np.arange(1, OVERLAP + 1)).ravel()] = False
        self.weight = np.repeat(table.column("parsed").to_numpy(), np.diff(bounds))
        langs = table.column("lang").combine_chunks().dictionary_encode()
        langs = langs.chunk(0) if isinstance(langs, pa.ChunkedArray) else langs
        self.langs = langs.dictionary
        self.lang = np.repeat(langs.indices.to_numpy(), np.diff(bounds)).astype(np.int64)
        sizes = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
        spelt = pa.Array.from_buffers(
            pa.large_binary(), len(starts),
            [None, pa.py_buffer(sizes), pa.py_buffer(np.ascontiguousarray(raw[letter]))],
        ).dictionary_encode()
        self.spelling = spelt.dictionary
        self.word = spelt.indices.to_numpy().astype(np.int64)
        self.size = max(1, len(self.spelling))
        hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, self.spelling.to_pylist()),
                             dtype=np.uint64, count=len(self.spelling))
        seeds = np.fromiter((xxhash.xxh3_64_intdigest((x or "").encode()) for x in self.langs.to_pylist()),
                            dtype=np.uint64, count=len(self.langs))
        # Distinct words and pairs of a language, by exact ids; their hashes serve the filter.
        self.one, self.one_at = np.unique(self.lang * self.size + self.word, return_inverse=True)
        self.one_hash = mix(hashed[self.one % self.size] + seeds[self.one // self.size])
        at = np.flatnonzero(~self.broken)
        self.two_at = np.full(len(starts) + 2, -1, dtype=np.int64)
        self.two, self.two_at[at] = np.unique(
            self.one_at[at] * len(self.one) + self.one_at[at + 1], return_inverse=True)
        a, b = divmod(self.two, len(self.one)) if len(self.one) else (self.two, self.two)
        self.two_hash = mix(self.one_hash[a] * _STEP + mix(self.one_hash[b]))

    def weighed(self, at: np.ndarray, where: np.ndarray, kinds: int) -> np.ndarray:
        """How often each kind begins in a place of its own chunk; exact below 2**53."""
        weights = np.where(self.own[where], self.weight[where], 0)
        return np.bincount(at, weights=weights, minlength=kinds).astype(np.int64)

    def short(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(hashes, counts) of words and of pairs."""
        yield self.one_hash, self.weighed(self.one_at, np.arange(len(self.one_at)), len(self.one))
        at = np.flatnonzero(self.two_at >= 0)
        yield self.two_hash, self.weighed(self.two_at[at], at, len(self.two))

    def long(self, frequent: Callable[[np.ndarray], np.ndarray]):
        """(length, codes, hashes, counts) of phrases of three and four words, all of whose pairs pass."""
        passing = np.concatenate([frequent(self.two_hash), [False]])[self.two_at]
        n, two = len(self.own), max(1, len(self.two))
        three = np.flatnonzero(self.own & passing[:n] & passing[1 : n + 1])
        codes, at = np.unique(self.two_at[three] * self.size + self.word[three + 2],
                              return_inverse=True)
        last = self.one_hash[self.one_at[three + 2]]
        sample = np.zeros(len(codes), dtype=np.int64)
        sample[at] = np.arange(len(three))
        hashes = mix(self.two_hash[codes // self.size] * _STEP + mix(last[sample] + np.uint64(3)))
        yield 3, codes, hashes, self.weighed(at, three, len(codes))
        four = three[passing[three + 2]]
        codes, at = np.unique(self.two_at[four] * two + self.two_at[four + 2], return_inverse=True)
        a, b = divmod(codes, two)
        hashes = mix(self.two_hash[a] * _STEP + mix(self.two_hash[b] + np.uint64(4)))
        yield 4, codes, hashes, self.weighed(at, four, len(codes))

    def spell(self, length: int, codes: np.ndarray) -> tuple[pa.Array, pa.Array]:
        """Languages and phrases of codes."""
        one, two = max(1, len(self.one)), max(1, len(self.two))
        if length == 1:
            ones = [codes]
        elif length == 2:
            ones = list(divmod(self.two[codes], one))
        elif length == 3:
            ones = [*divmod(self.two[codes // self.size], one)]
        else:
            ones = [x for half in divmod(codes, two) for x in divmod(self.two[half], one)]
        words = [self.one[x] % self.size for x in ones]
        if length == 3:
            words.append(codes % self.size)
        langs = self.langs.take(pa.array(self.one[ones[0]] // self.size))
        spelt = [self.spelling.take(pa.array(w)).cast(pa.large_string()) for w in words]
        return langs, pc.binary_join_element_wise(*spelt, pa.scalar(" ", pa.large_string()))


def _over_runs(df: DataFrame, ddl: str, count: Callable[[Run], Iterator[dict]]) -> DataFrame:
    """`count` over the chunks of each task, some megabytes at a time."""
    ship_package(df.sparkSession)
    schema = T.StructType.fromDDL(ddl)
    arrow = pa_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush():
            for columns in count(Run(pa.Table.from_batches(held))):
                arrays = (columns[f.name] for f in arrow)
                yield pa.RecordBatch.from_arrays(
                    [a.cast(f.type) if isinstance(a, pa.Array) else pa.array(a, type=f.type)
                     for a, f in zip(arrays, arrow)], schema=arrow)

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                size += batch.nbytes
            if size >= RUN_BYTES:
                yield from flush()
                held, size = [], 0
        if held:
            yield from flush()

    return df.mapInArrow(run, schema)


def _dealt(hashes: np.ndarray, counts: np.ndarray, log: int, least: int) -> dict:
    """Hashes in ascending order, cut by their first `log` bits, 32 bits kept of the rest."""
    keep = counts > 0
    order = np.argsort(hashes[keep])
    hashes, counts = hashes[keep][order], counts[keep][order]
    edges = np.searchsorted(hashes, np.arange(1, 1 << log, dtype=np.uint64) << np.uint64(64 - log))
    low = ((hashes << np.uint64(log)) >> np.uint64(32)).astype("<u4")
    # A count beyond the least that matters says no more than the least.
    few = np.minimum(counts, least).astype("<u1" if least < 256 else "<u4")
    parts = [(t, x.tobytes(), y.tobytes())
             for t, (x, y) in enumerate(zip(np.split(low, edges), np.split(few, edges))) if len(x)]
    return {name: [p[i] for p in parts] for i, name in enumerate(("target", "low", "few"))}


def _filter(runs: DataFrame, log: int, least: int, filter_log: int) -> np.ndarray:
    """One bit for each hash range in which the counts of some hash reach `least`.

    Each target is a range of hashes, merged in one task, which returns its part of the
    filter. All parts together have 2**filter_log bits, whatever the input.
    """
    bits = 1 << (filter_log - log)
    kind = "<u1" if least < 256 else "<u4"

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[list, list]] = {}
        for batch in batches:
            for t, low, few in zip(*(batch.column(i).to_pylist() for i in range(3))):
                lows, fews = held.setdefault(t, ([], []))
                lows.append(np.frombuffer(low, dtype="<u4"))
                fews.append(np.frombuffer(few, dtype=kind))
        for t, (lows, fews) in held.items():
            low, few = np.concatenate(lows), np.concatenate(fews)
            order = np.argsort(low)
            low, few = low[order], few[order].astype(np.int64)
            first = np.flatnonzero(np.concatenate([[True], low[1:] != low[:-1]]))
            found = low[first][np.add.reduceat(few, first) >= least]
            mask = np.zeros(bits, dtype=np.uint8)
            mask[found >> np.uint32(32 - filter_log + log)] = 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([t], pa.int32()), pa.array([np.packbits(mask).tobytes()], pa.binary())],
                names=["target", "bits"])

    merged = runs.repartitionById(1 << log, "target").mapInArrow(merge, "target int, bits binary")
    whole = np.zeros((1 << filter_log) // 8, dtype=np.uint8)
    for target, part in merged.collect():
        at = target * (bits // 8)
        whole[at : at + bits // 8] = np.frombuffer(part, dtype=np.uint8)
    return whole


def _tester(whole: np.ndarray) -> Callable[[np.ndarray], np.ndarray]:
    shift = np.uint64(64 - (len(whole) * 8).bit_length() + 1)

    def test(hashes: np.ndarray) -> np.ndarray:
        at = hashes >> shift
        return (whole[at >> np.uint64(3)] >> (np.uint8(7) - (at & np.uint64(7)).astype(np.uint8))) & 1 > 0

    return test


def phrase_counts(
    dictionary: DataFrame, min_count: int = MIN_COUNT, filter_log: int = FILTER_LOG
) -> DataFrame:
    """lang, phrase, words and f of all phrases of one to four words with f >= min_count.

    `dictionary` is a materialised parse. A row of each language with an empty phrase of
    0 words has the number of all its words.
    """
    spark = dictionary.sparkSession
    # 64 is more words than chunks have on average.
    log = min(16, max(3, (dictionary.count() * 64 // MERGED).bit_length()))
    ddl = "target int, low binary, few binary"

    def count_short(run: Run):
        for hashes, counts in run.short():
            yield _dealt(hashes, counts, log, min_count)

    short = spark.sparkContext.broadcast(
        _filter(_over_runs(dictionary, ddl, count_short), log, min_count, filter_log))

    def count_long(run: Run):
        for _, _, hashes, counts in run.long(_tester(short.value)):
            yield _dealt(hashes, counts, log, min_count)

    long = spark.sparkContext.broadcast(
        _filter(_over_runs(dictionary, ddl, count_long), log, min_count, filter_log))

    def count_all(run: Run):
        def rows(length, codes, counts):
            langs, phrases = run.spell(length, codes)
            return {"lang": langs, "phrase": phrases, "words": [length] * len(codes), "f": counts}

        frequent = _tester(short.value)
        totals = run.weighed(run.lang, np.arange(len(run.lang)), len(run.langs))
        yield {"lang": run.langs, "phrase": [""] * len(totals), "words": [0] * len(totals), "f": totals}
        for length, (hashes, counts) in enumerate(run.short(), 1):
            keep = np.flatnonzero(frequent(hashes) & (counts > 0))
            yield rows(length, keep, counts[keep])
        for length, codes, hashes, counts in run.long(frequent):
            keep = _tester(long.value)(hashes) & (counts > 0)
            yield rows(length, codes[keep], counts[keep])

    counted = _over_runs(dictionary, "lang string, phrase string, words int, f long", count_all)
    return counted.groupBy("lang", "phrase", "words").agg(F.sum("f").alias("f")).where(
        (F.col("f") >= min_count) | (F.col("words") == 0)
    )


def _exact(count: Column) -> Column:
    return count.cast("decimal(20,0)")


def _parts(words: Column, begin: Column | int, length: Column | int) -> Column:
    return F.array_join(F.slice(words, begin, length), " ")


def collocations(counts: DataFrame, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of the best `top` phrases of each language.

    `counts` is a materialised `phrase_counts`. A phrase counts by its weakest cut; one
    that occurs mostly inside a longer phrase is left out.
    """
    split = counts.where("words > 0").withColumn("w", F.split("phrase", " "))
    cuts = split.where("words > 1").select(
        "lang", "phrase", "words", F.col("f").alias("a"), "w",
        F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"),
    ).select(
        "lang", "phrase", "a", "k", _parts(F.col("w"), F.lit(1), F.col("k")).alias("left"),
        _parts(F.col("w"), F.col("k") + 1, F.col("words") - F.col("k")).alias("right"),
    )
    # Common first words are hot; a plain shuffle of two tables lets Spark split them.
    known = counts.where("words between 1 and 3")
    for part, as_name in (("left", "l"), ("right", "r")):
        lookup = known.select("lang", F.col("phrase").alias(part), F.col("f").alias(as_name))
        cuts = cuts.join(small_or_shuffled(lookup), ["lang", part])
    score = F.expr(
        "cast(2000000 * cast(a as decimal(20,0)) div "
        "(cast(l as decimal(20,0)) + cast(r as decimal(20,0))) as bigint)"
    )
    scored = cuts.withColumn("score", score).groupBy("lang", "phrase", "a").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut")
    )
    inside = split.where("words > 2").select(
        "lang", "f",
        F.explode(F.flatten(F.transform(
            F.sequence(F.lit(2), F.col("words") - 1),
            lambda m: F.transform(
                F.sequence(F.lit(1), F.col("words") - m + 1),
                lambda i: F.array_join(F.slice(F.col("w"), i, m), " "),
            ),
        ))).alias("phrase"),
    ).groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    kept = scored.join(inside, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (100 * _exact(F.col("longer")) < 80 * _exact(F.col("a")))
    ).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    order = [F.desc("score"), F.desc("a"), "phrase"]
    # The best of each slice of a language first, so that no task sorts a whole language.
    part = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(64))).orderBy(*order)
    best = kept.withColumn("place", F.row_number().over(part)).where(F.col("place") <= top)
    ranked = best.withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")
    ).where(F.col("rank") <= top)
    totals = counts.where("words = 0").select("lang", F.col("f").alias("n"))
    return ranked.join(small_or_shuffled(totals), "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score"
    )


def mine_phrases(docs: DataFrame, top: int = TOP, min_count: int = MIN_COUNT) -> DataFrame:
    """The best phrases of two to four words of each language (null: `und`) of `docs`.

    Repeated rows count each time. Without rows, or without a frequent phrase, there is
    no result. Other columns are not read.
    """
    counts = cut_lineage(phrase_counts(cut_lineage(parse(docs)), min_count))
    return collocations(counts, top)
