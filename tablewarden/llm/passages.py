"""Passages that several documents share, found by seeds and followed word by word.

Passages may begin and end anywhere in a line, so paragraphs are not lines. Texts
are cut where the words themselves say so, at two levels. Fragments of about eleven
words end at a word whose hash is the least within a few words to both sides; a
fragment that an earlier document holds too is a seed. From the ends of each run of
seeds the words are compared with those around the first holder's fragment, up to
the true ends of the passage and across a differing word or two. Paragraphs of some
fifty words meet in bands of MinHash values; those that collide are tested by exact
Jaccard, and linked paragraphs form components, of which the first document keeps
its paragraphs. This also finds copies that differ in more than the words show.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tablewarden.context import cut_lineage, is_small, settled
from tablewarden.llm.overlap import link_lists
from tablewarden.llm.tables import map_batches, texts_of
from tablewarden.llm.words import groups, mix, powers, scan, shingle_hashes

WIDTH = 5
PERCENT = 75
RADIUS = 5
MAX_WORDS = 64
#: Bands of three rows: recall 0.9958 at a Jaccard of 0.75, 0.9992 at 0.8, 1 for equal paragraphs;
#: paragraphs that share a tenth by chance collide once in a hundred times.
BANDS = 10
ROWS = 3
#: A paragraph begins at three words whose hash is the least within so many words to both sides.
PARAGRAPH_RADIUS = 25
PARAGRAPH_WIDTH = 3
MAX_PARAGRAPH_WORDS = 128
#: A repeated run of words is cut if it has so many.
MIN_RUN_WORDS = 16
MIN_PARAGRAPH_WORDS = RADIUS
#: Words around a holder's fragment that are compared. No fragment is longer, so what lies
#: farther off belongs to another seed.
CONTEXT = MAX_WORDS
#: Up to so many words differ, are missing or are added at once between words that agree.
MAX_GAP = 2
#: So many words must agree after a difference.
AGREE = 4
#: Lists of more members than this are left to the second pass.
SHORT_LIST = 8
#: Numbers that are broadcast together at most (16 MB).
MAX_BROADCAST_VALUES = 2_000_000
#: Odd factors: products of mixed hashes give each row its own order.
_FACTORS = mix(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64)) | np.uint64(1)
_TOP = np.uint64(0xFFFFFFFFFFFFFFFF)
_BACK, _ON = 0, 1
_GAPS = sorted(((i, j) for i in range(MAX_GAP + 1) for j in range(MAX_GAP + 1) if i or j),
               key=lambda x: (max(x), x != (1, 1)))


def _starts(values: np.ndarray, radius: int, longest: int) -> np.ndarray:
    """Where a value is the least within `radius` to both sides; no run is longer than `longest`."""
    n = len(values)
    if n == 0:
        return np.zeros(0, dtype=np.int64)
    around = np.concatenate([np.full(radius, _TOP), values, np.full(radius + 1, _TOP)])
    width = 1
    while width < radius:  # the least of `radius` values, by doubling
        step = min(width, radius - width)
        around = np.minimum(around[:-step], around[step:])
        width += step
    starts = np.flatnonzero(
        (values < around[:n]) & (values <= around[radius + 1 : radius + 1 + n])
    )
    if not len(starts) or starts[0]:
        starts = np.concatenate([[0], starts])
    sizes = np.diff(starts, append=n)
    if sizes.max() > longest:  # words that repeat give no cut
        starts = np.concatenate([np.arange(s, s + size, longest) for s, size in zip(starts, sizes)])
    return starts


def paragraph_starts(hashes: np.ndarray) -> np.ndarray:
    """The first word of each fragment. A cut depends on the words within RADIUS alone."""
    return _starts(hashes, RADIUS, MAX_WORDS)


def _keys(hashes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = len(hashes)
    sizes = np.diff(starts, append=n)
    if n == 0:
        return starts, sizes, np.zeros(0, np.uint64)
    position = np.arange(n) - np.repeat(starts, sizes)
    keys = mix(
        np.add.reduceat(mix(hashes) * powers(int(sizes.max()) + 1)[position], starts)
        + sizes.astype(np.uint64)
    )
    return starts, sizes, keys


def paragraph_keys(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, numbers of words and identities of the fragments."""
    return _keys(hashes, paragraph_starts(hashes))


def long_paragraph_keys(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, numbers of words and identities of the paragraphs."""
    values = np.full(len(hashes), _TOP)
    if len(hashes) >= PARAGRAPH_WIDTH:
        whole = shingle_hashes(hashes, PARAGRAPH_WIDTH)
        values[: len(whole)] = whole
    return _keys(hashes, _starts(values, PARAGRAPH_RADIUS, MAX_PARAGRAPH_WORDS))


def band_values(hashes: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """For each paragraph (of WIDTH words or more, in order) the values of its bands, a row of BANDS.

    The words may be those of many texts.
    """
    if not len(starts):
        return np.zeros((0, BANDS), np.uint64)
    counts = sizes - WIDTH + 1
    first = np.cumsum(counts) - counts
    places = np.arange(int(counts.sum())) + np.repeat(starts - first, counts)
    shingles = mix(shingle_hashes(hashes, WIDTH)[places])
    least = np.stack([np.minimum.reduceat(shingles * f, first) for f in _FACTORS], axis=1)
    return shingle_hashes(least.ravel(), ROWS)[::ROWS].reshape(len(starts), BANDS)


def shingles_of(hashes: np.ndarray, start: int, size: int) -> np.ndarray:
    return np.unique(shingle_hashes(hashes[start : start + size], WIDTH))


def follow(ours: np.ndarray, theirs: np.ndarray) -> int:
    """How many of our words from the first on agree with theirs, but for gaps of a word or two."""
    i = j = 0
    while True:
        m = min(len(ours) - i, len(theirs) - j)
        differ = np.flatnonzero(ours[i : i + m] != theirs[j : j + m])
        run = int(differ[0]) if len(differ) else m
        i, j = i + run, j + run
        if run == m:
            return i
        for a, b in _GAPS:
            x, y = ours[i + a : i + a + AGREE], theirs[j + b : j + b + AGREE]
            if len(x) == AGREE and np.array_equal(x, y):
                i, j = i + a, j + b
                break
        else:
            return i


def _pieces(docs: DataFrame) -> DataFrame:
    """The fragments (doc_id, place, key) and, with n (shingles) and bands, the paragraphs of
    enough words, from one pass over the texts."""

    def of_group(hashes, slices, ids):
        rows: dict[str, list] = {"doc_id": [], "place": [], "key": []}
        owners, keys, starts, sizes = [], [], [], []
        for doc_id, (i, j) in zip(ids, slices):
            own = hashes[i:j]
            _, lengths, found = paragraph_keys(own)
            use = np.flatnonzero(lengths >= MIN_PARAGRAPH_WORDS)
            rows["doc_id"].append(np.full(len(use), doc_id))
            rows["place"].append(use)
            rows["key"].append(found[use])
            first, lengths, found = long_paragraph_keys(own)
            use = lengths >= MIN_RUN_WORDS
            keys.append(found[use])
            starts.append(first[use] + i)
            sizes.append(lengths[use])
            owners.append(np.full(len(keys[-1]), doc_id))
        none = [np.zeros(0, np.int64)]
        starts, sizes = np.concatenate(none + starts), np.concatenate(none + sizes)
        bands = band_values(hashes, starts, sizes).view(np.int64)
        n = sum(map(len, rows["key"]))
        return {
            "doc_id": np.concatenate(none + rows["doc_id"] + owners),
            "place": pa.array(np.concatenate(none + rows["place"] + [np.zeros(len(bands), np.int64)]),
                              pa.int32()),
            "key": np.concatenate([np.zeros(0, np.uint64)] + rows["key"] + keys).view(np.int64),
            "n": pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(sizes - WIDTH + 1)]),
            "bands": pa.ListArray.from_arrays(
                pa.concat_arrays([
                    pa.nulls(n, pa.int32()),
                    pa.array(np.arange(len(bands) + 1) * BANDS, pa.int32()),
                ]), pa.array(bands.ravel()),
            ),
        }

    def make():
        def step(batch):
            ids = batch.column(batch.schema.get_field_index("doc_id")).to_pylist()
            texts = texts_of(batch)
            for begin, end in groups(texts):
                words = scan(texts[begin:end], fold=True)
                yield of_group(words.hashes, words.slices(), ids[begin:end])
        return step

    source = docs.where("doc_id is not null and text is not null").select("doc_id", "text")
    return cut_lineage(
        map_batches(source, "doc_id long, place int, key long, n long, bands array<long>", make)
    )


def _items_of(docs: DataFrame, holders: DataFrame):
    """For `link_lists`: the shingles of the asked paragraphs, from one document that has each."""

    def items_of(nodes: DataFrame) -> DataFrame:
        asked = cut_lineage(
            nodes.join(holders, nodes.node == holders.key).select("node", "holder")
        )
        by_holder = asked.groupBy("holder").agg(F.collect_list("node").alias("nodes"))
        if is_small(asked, MAX_BROADCAST_VALUES):
            by_holder = F.broadcast(by_holder)
        texts = docs.join(by_holder, docs.doc_id == by_holder.holder).select("text", "nodes")

        def make():
            def step(batch):
                out: dict[str, list] = {"node": [], "items": []}
                texts = texts_of(batch)
                wanted = batch.column(batch.schema.get_field_index("nodes"))
                for begin, end in groups(texts):
                    words = scan(texts[begin:end], fold=True)
                    for k, (i, j) in enumerate(words.slices(), begin):
                        hashes = words.hashes[i:j]
                        starts, sizes, keys = long_paragraph_keys(hashes)
                        keys, first = np.unique(keys.view(np.int64), return_index=True)
                        ours = np.isin(keys, wanted[k].values.to_numpy(zero_copy_only=False))
                        out["node"] += keys[ours].tolist()
                        for p in first[ours].tolist():
                            items = shingles_of(hashes, starts[p], sizes[p])
                            out["items"].append(items.astype("<u8").tobytes())
                return out
            return step

        return map_batches(texts, "node long, items binary", make)

    return items_of


def repeated_fragments(pieces: DataFrame) -> DataFrame:
    """doc_id, place, key, holder of the fragments that an earlier document, the holder, has too."""
    found = pieces.where("n is null")
    shared = cut_lineage(
        found.groupBy("key").agg(F.min("doc_id").alias("holder"), F.max("doc_id").alias("high"))
        .where("holder < high").select("key", "holder")
    )
    return found.join(shared, "key").where("doc_id > holder") \
        .select("doc_id", "place", "key", "holder").distinct()


def repeated_paragraphs(docs: DataFrame, pieces: DataFrame) -> DataFrame:
    """doc_id, key of the paragraphs of which an earlier document holds another form.

    Equal paragraphs need no link: their fragments are seeds.
    """
    found = pieces.where("n is not null")
    nodes = cut_lineage(
        found.groupBy("key").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
    )
    members = found.select("key", "n", F.posexplode("bands").alias("k", "value")) \
        .select(F.xxhash64("k", "value").alias("g"), F.col("key").alias("node"), "n")
    holders = nodes.select("key", F.col("low").alias("holder"))
    linked = link_lists(members, _items_of(docs, holders), PERCENT, short_list=SHORT_LIST)
    joined = linked.join(nodes, linked.node == nodes.key).select("key", "component", "low", "high")
    spread = joined.groupBy("component").agg(F.min("low").alias("first"), F.max("high").alias("last")) \
        .where("first < last").select("component", "first")
    many = cut_lineage(joined.join(spread, "component").select("key", "first"))
    return found.join(many, "key").where("doc_id > first").select("doc_id", "key").distinct()


def _run_ends(seeds: DataFrame) -> DataFrame:
    """doc_id, key, holder, side where a run of seeds begins (_BACK) or ends (_ON).

    The fragment next to the outermost counts too if its holder is another one: the
    outermost may be a phrase that its first holder has in other company.
    """
    own = Window.partitionBy("doc_id").orderBy("place", "key")
    before = {f"{name}{k}": F.lag(name, k).over(own) for k in (1, 2) for name in ("place", "holder")}
    after = {f"next_{name}{k}": F.lead(name, k).over(own) for k in (1, 2) for name in ("place", "holder")}
    rows = seeds.withColumns(before | after)

    def outer(prefix: str, sign: int) -> Column:
        def beside(k: int):
            return F.coalesce(F.col(f"{prefix}place{k}") == F.col("place") + sign * k, F.lit(False))
        return ~beside(1) | (~beside(2) & (F.col(f"{prefix}holder1") != F.col("holder")))

    sides = F.array(F.when(outer("", -1), F.lit(_BACK)), F.when(outer("next_", 1), F.lit(_ON)))
    return rows.select("doc_id", "key", "holder", F.explode(F.array_compact(sides)).alias("side")) \
        .distinct()


def _contexts(docs: DataFrame, ends: DataFrame) -> DataFrame:
    """key, side, words: 32 bits of each word beside the first holder's fragment, outwards."""
    asked = cut_lineage(ends.select("holder", "key", "side").distinct())
    by_holder = asked.groupBy("holder").agg(
        F.collect_list(F.when(F.col("side") == _BACK, F.col("key"))).alias("back"),
        F.collect_list(F.when(F.col("side") == _ON, F.col("key"))).alias("on"),
    )
    if is_small(asked, MAX_BROADCAST_VALUES):
        by_holder = F.broadcast(by_holder)
    texts = docs.join(by_holder, docs.doc_id == by_holder.holder).select("text", "back", "on")

    def make():
        def step(batch):
            out: dict[str, list] = {"key": [], "side": [], "words": []}
            texts = texts_of(batch)
            wanted = [batch.column(batch.schema.get_field_index(c)) for c in ("back", "on")]
            for begin, end in groups(texts):
                words = scan(texts[begin:end], fold=True)
                for k, (i, j) in enumerate(words.slices(), begin):
                    hashes = words.hashes[i:j]
                    starts, sizes, keys = paragraph_keys(hashes)
                    use = np.flatnonzero(sizes >= MIN_PARAGRAPH_WORDS)
                    keys, first = np.unique(keys[use].view(np.int64), return_index=True)
                    for side, lists in enumerate(wanted):
                        ours = np.isin(keys, lists[k].values.to_numpy(zero_copy_only=False))
                        for key, p in zip(keys[ours].tolist(), use[first[ours]].tolist()):
                            out["key"].append(key)
                            out["side"].append(side)
                            out["words"].append(_beside(hashes, starts[p], sizes[p], side, CONTEXT)
                                                .astype("<u4").tobytes())
            return out
        return step

    # Rows that share the holder's id may give several.
    return map_batches(texts, "key long, side int, words binary", make) \
        .groupBy("key", "side").agg(F.max("words").alias("words"))


def _beside(hashes: np.ndarray, start: int, size: int, side: int, most: int) -> np.ndarray:
    """The words after a fragment, or those before it from the last to the first."""
    if side == _ON:
        return hashes[start + size : start + size + most].astype(np.uint32)
    return hashes[max(0, start - most) : start][::-1].astype(np.uint32)


def _covered(hashes: np.ndarray, seeds: np.ndarray, near: np.ndarray,
             ends: list[tuple[int, int, bytes]]) -> np.ndarray:
    """Which words an earlier document holds, by seeds, paragraphs and what stands beside seeds."""
    starts, sizes, keys = paragraph_keys(hashes)
    keys = keys.view(np.int64)
    fragments = np.isin(keys, seeds) & (sizes >= MIN_PARAGRAPH_WORDS)
    covered = np.repeat(fragments, sizes)
    if len(near):
        # The outermost words of a paragraph are decided by what stands beside seeds.
        first, lengths, ours = long_paragraph_keys(hashes)
        for p in np.flatnonzero(np.isin(ours.view(np.int64), near)).tolist():
            inside = np.flatnonzero(covered[first[p] : first[p] + lengths[p]])
            if len(inside):
                covered[first[p] + inside[0] : first[p] + inside[-1] + 1] = True
            else:
                covered[first[p] : first[p] + lengths[p]] = True
    places: dict[int, list[int]] = {}
    for p in np.flatnonzero(fragments).tolist():
        places.setdefault(int(keys[p]), []).append(p)
    for key, side, words in ends:
        theirs = np.frombuffer(words, "<u4")
        for p in places.get(key, ()):
            a, size = int(starts[p]), int(sizes[p])
            more = follow(_beside(hashes, a, size, side, len(theirs) + CONTEXT), theirs)
            if side == _ON:
                covered[a + size : a + size + more] = True
            else:
                covered[a - more : a] = True
    return covered


def _cut(text: bytes, starts: np.ndarray, ends: np.ndarray,
         covered: np.ndarray) -> tuple[bytes, list[tuple[int, int]]]:
    """The text without its long enough runs of covered words, and the byte ranges cut out."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], covered.astype(np.int8), [0]])))
    spans = [(int(starts[a]), int(ends[b - 1])) for a, b in zip(edges[::2], edges[1::2])
             if b - a >= MIN_RUN_WORDS]
    kept, last = [], 0
    for a, b in spans:
        kept.append(text[last:a].rstrip(b" ") if text[b : b + 1] in (b" ", b"") else text[last:a])
        last = b
    kept.append(text[last:])
    return b"".join(kept), spans


def _marks(docs: DataFrame) -> DataFrame:
    """doc_id and a seed, a paragraph or the end of a run of seeds that an earlier document holds."""
    pieces = _pieces(docs)
    seeds = cut_lineage(repeated_fragments(pieces))
    ends = cut_lineage(_run_ends(seeds))
    beside = ends.join(cut_lineage(_contexts(docs, ends)), ["key", "side"]) \
        .select("doc_id", F.struct("key", "side", "words").alias("end"))
    near = repeated_paragraphs(docs, pieces)
    nothing = {"seed": F.lit(None).cast("long"), "near": F.lit(None).cast("long"),
               "end": F.lit(None).cast("struct<key:long,side:int,words:binary>")}

    def only(rows: DataFrame, name: str, value: str) -> DataFrame:
        return rows.select("doc_id", *(F.col(value).alias(n) if n == name else v.alias(n)
                                       for n, v in nothing.items()))

    return only(seeds, "seed", "key").unionByName(only(near, "near", "key")) \
        .unionByName(only(beside, "end", "end"))


def _with_repeats(docs: DataFrame) -> DataFrame:
    """`docs` as a struct, with what an earlier document holds too; seeds are null if nothing."""
    marks = settled(docs.sparkSession, lambda: _marks(docs))
    found = marks.groupBy(F.col("doc_id").alias("i")).agg(
        F.collect_set("seed").alias("seeds"), F.collect_set("near").alias("near"),
        F.collect_list("end").alias("ends"),
    )
    # A run's end weighs as much as the words beside it.
    if is_small(marks, MAX_BROADCAST_VALUES // CONTEXT):
        found = F.broadcast(found)
    whole = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"),
                        "doc_id", "text")
    return whole.join(found, whole.doc_id == found.i, "left") \
        .select("doc", "doc_id", "text", "seeds", "near", "ends")


def _cutter():
    def step(batch):
        texts = texts_of(batch)
        seeds, near, further = (batch.column(batch.schema.get_field_index(c))
                                for c in ("seeds", "near", "ends"))
        out = {"cut": [None] * len(texts), "starts": [None] * len(texts), "lengths": [None] * len(texts)}
        use = np.flatnonzero(seeds.is_valid().to_numpy(zero_copy_only=False)).tolist()
        some = [texts[i] for i in use]
        for begin, end in groups(some):
            words = scan(some[begin:end], fold=True)
            for k, (i, j) in enumerate(words.slices(), begin):
                at, row = words.offsets[k - begin], use[k]
                covered = _covered(
                    words.hashes[i:j], seeds[row].values.to_numpy(zero_copy_only=False),
                    near[row].values.to_numpy(zero_copy_only=False),
                    [(e["key"], e["side"], e["words"]) for e in further[row].as_py()],
                )
                text, spans = _cut(some[k], words.starts[i:j] - at, words.ends[i:j] - at, covered)
                if spans:
                    out["cut"][row] = text.decode()
                    out["starts"][row] = [len(some[k][:a].decode()) for a, _ in spans]
                    out["lengths"][row] = [len(some[k][a:b].decode()) for a, b in spans]
        return out
    return step


def find_repeats(docs: DataFrame) -> DataFrame:
    """A row for each document that loses something: doc_id, the code points where removed
    passages begin, their lengths, and the text that is left.

    Rows without an id or text lose nothing. Rows that share an id are one document
    and are not compared with each other; the document with the least id keeps a passage.
    """

    def make():
        cut = _cutter()

        def step(batch):
            return {"doc_id": batch.column(batch.schema.get_field_index("doc_id"))} | cut(batch)
        return step

    rows = _with_repeats(docs).where("seeds is not null").select("doc_id", "text", "seeds", "near", "ends")
    found = map_batches(
        rows, "doc_id long, cut string, starts array<long>, lengths array<long>", make
    )
    return found.where("cut is not null").select(
        "doc_id", F.size("starts").cast("long").alias("n_removed"), "starts", "lengths",
        F.col("cut").alias("text"),
    )


def remove_repeats(docs: DataFrame) -> DataFrame:
    """All documents, with their columns as they were, but for texts cut and n_chars to match."""

    def make():
        cut = _cutter()

        def step(batch):
            return {"doc": batch.column(batch.schema.get_field_index("doc")), "cut": cut(batch)["cut"]}
        return step

    rows = _with_repeats(docs).select("doc", "text", "seeds", "near", "ends")
    found = map_batches(rows, f"doc {rows.schema['doc'].dataType.simpleString()}, cut string", make)
    changed = {"text": F.coalesce("cut", "doc.text"),
               "n_chars": F.when(F.col("cut").isNull(), F.col("doc.n_chars"))
               .otherwise(F.length("cut").cast("long"))}
    return found.select(*(changed.get(c, F.col(f"doc.`{c}`")).alias(c) for c in docs.columns))
