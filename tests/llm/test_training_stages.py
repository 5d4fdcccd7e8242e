from __future__ import annotations

import random
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tablewarden.context import cut_lineage, settled
from tablewarden.llm import langid, ngram_join, overlap, passages, toxicity


def shingles(text):
    words = (text or "").encode().lower().split()
    k = min(5, len(words))
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1)) if words else frozenset()


def brute_components(rows):
    sets = [(d, shingles(t)) for d, t in rows]
    parent = list(range(len(sets)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (_, x) in enumerate(sets):
        for j, (_, y) in enumerate(sets[:i]):
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(sets):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, len(s), least.get(find(i))) for i, (d, s) in enumerate(sets)), key=str)


def near_copies(n, seed=3):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(500)}" for _ in range(120)]
    rows = []
    for i in range(n):
        words = list(base)
        for _ in range(rng.randrange(9)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    return rows


@pytest.mark.parametrize("block,short", [(256, 64), (16, 4)])
def test_join_equals_brute_force(spark, awkward, monkeypatch, block, short):
    monkeypatch.setattr(overlap, "BLOCK_SETS", block)
    monkeypatch.setattr(overlap.link_lists, "__defaults__", (75, False, short))
    rows = near_copies(90) + [(r.doc_id and r.doc_id + 1000, r.text) for r in awkward.collect()]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(map(tuple, ngram_join.join_documents(docs).collect()), key=str)
    assert got == brute_components(rows)


@pytest.mark.parametrize("per_task", [7, 10**6])
def test_components_of_any_split(spark, monkeypatch, per_task):
    from tablewarden.llm import components

    monkeypatch.setattr(components, "LINKS_PER_TASK", per_task)
    chain = [(i, i + 1) for i in range(40, 79)] + [(5, 5), (3, 9), (9, -4), (100, 101), (101, 100)]
    found = components.connected_components(
        spark.createDataFrame(chain, "a long, b long").repartition(5)
    ).collect()
    want = {i: 40 for i in range(40, 80)} | {3: -4, 9: -4, -4: -4, 100: 100, 101: 100}
    assert len(found) == len(want) and {r.node: r.component for r in found} == want
    none = spark.createDataFrame([], "a long, b long")
    assert components.connected_components(none).count() == 0


def test_long_lists_meet_by_their_rarest_items(spark, monkeypatch):
    """Sets of frequent items alone, of which some are similar: all links are found."""
    rng = random.Random(8)
    common = rng.sample(range(10**9), 60)
    sets = {}
    for i in range(60):
        sets[i] = sorted(rng.sample(common, 40) + rng.sample(range(10**9), rng.randrange(12)))
    for i in range(60, 90):
        sets[i] = sorted(set(sets[i - 60][rng.randrange(1, 4):]) | {rng.randrange(10**9)})
    sets = {i: sorted(set(s)) for i, s in sets.items()}
    rows = [(i, np.array(s, "<i8").tobytes(), len(s)) for i, s in sets.items()]
    items = spark.createDataFrame(rows + rows[:5], "node long, items binary, n long")
    members = spark.createDataFrame([(7, i, len(s)) for i, s in sets.items()], "g long, node long, n long")
    monkeypatch.setattr(overlap, "SHORT_LIST", 4)
    monkeypatch.setattr(overlap, "BLOCK_SETS", 16)
    found = overlap.link_lists(
        members, lambda nodes: items.select("node", "items").join(nodes, "node", "left_semi"), 75, False, 4
    )
    label = {i: i for i in sets}
    for i in sets:
        for j in range(i):
            x, y = set(sets[i]), set(sets[j])
            if 100 * len(x & y) >= 75 * len(x | y):
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = {k: new if v == old else v for k, v in label.items()}
    got = {r.node: r.component for r in found.collect()}
    assert {i: got.get(i, i) for i in sets} == label and len(set(label.values())) < 70


def test_members_of_lists_are_moved_once(spark, tmp_path):
    """Lists of one node go, repeated memberships do no harm, and no join moves the members again."""
    rows = [(1, 5, 9), (1, 3, 8), (1, 5, 9), (2, 4, 7), (2, 4, 7), (3, 6, 1), (4, -2, 6), (4, 7, 5)]
    spark.createDataFrame(rows, "g long, node long, n long").write.parquet(f"{tmp_path}/members")
    met = overlap._met(spark.read.parquet(f"{tmp_path}/members"))
    want = [(1, 3, 8, 3, 8), (1, 5, 9, 3, 8), (4, -2, 6, -2, 6), (4, 7, 5, -2, 6)]
    assert sorted(map(tuple, met.collect())) == want
    plan = met._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    assert plan.count("Exchange") == 1 and "Join" not in plan


def test_join_on_given_tables(small):
    rows = [tuple(r) for r in small.select("doc_id", "text").collect()]
    got = sorted(map(tuple, ngram_join.join_documents(small).collect()), key=str)
    assert got == brute_components(rows)


def test_divide_skip_finds_what_connects():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.choice(300, 120)).astype(np.uint64) for _ in range(5)]
    sets += [np.unique(np.concatenate([s[6:], rng.choice(10**6, 4).astype(np.uint64)])) for s in sets]
    links = overlap.divide_skip(sets, np.arange(10), 75)
    assert sorted(links) == [(i, i + 5) for i in range(5)]
    assert overlap.divide_skip(sets, np.zeros(10), 75) == []
    assert sorted(overlap.divide_skip(sets, np.arange(10), 75, 5)) == [(i, i + 5) for i in range(5)]


def test_drop_near_copies_keeps_one(awkward, no_rows):
    left = ngram_join.drop_near_copies(awkward)
    assert left.columns == awkward.columns
    ids = sorted(r.doc_id or -1 for r in left.collect())
    assert ids == [-1, 1, 2, 3, 4, 5, 7, 8, 9, 20]
    assert ngram_join.drop_near_copies(no_rows).count() == 0


def test_passages_are_cut_wherever_they_stand(spark, no_rows):
    rng = random.Random(5)
    words = lambda n: " ".join(f"w{rng.randrange(9000)}" for _ in range(n))
    passage = words(70)
    rows = [(i, f"{words(80 + i)} {passage} {words(60)}") for i in range(40)]
    rows += [(100 + i, words(150)) for i in range(40)] + [(None, passage), (200, None), (201, "")]
    docs = spark.createDataFrame(
        [(d, t, len(t or "")) for d, t in rows], "doc_id long, text string, n_chars long"
    ).repartition(4)
    found = {r.doc_id: r for r in passages.find_repeats(docs).collect()}
    assert set(found) == set(range(1, 40))
    middle = " ".join(passage.split()[20:50])
    texts = dict(rows)
    for d, r in found.items():
        assert middle not in r.text and r.text.startswith(texts[d][:200])
        assert sum(r.lengths) >= 0.4 * len(passage)
        whole = texts[d]
        for start, length in reversed(list(zip(r.starts, r.lengths))):
            whole = whole[:start] + whole[start + length :]
        assert whole.split() == r.text.split()
    left = {r.doc_id: r for r in passages.remove_repeats(docs).collect()}
    assert len(left) == len(rows) and left[0].text == texts[0] and left[None].text == passage
    assert all(left[d].text == r.text and left[d].n_chars == len(r.text) for d, r in found.items())
    assert passages.find_repeats(no_rows).count() == passages.remove_repeats(no_rows).count() == 0


def test_bands_find_near_paragraphs(spark):
    """Of paragraphs of 60 words with one to three changed, those whose sets are similar collide,
    against a brute-force count of all pairs."""
    rng = np.random.default_rng(9)
    hashes, starts, sizes = [], [], []
    for k in range(150):
        own = rng.integers(0, 2**63, 60, dtype=np.uint64)
        near = own.copy()
        near[rng.choice(60, 1 + k % 3, replace=False)] = rng.integers(0, 2**63, 1 + k % 3, dtype=np.uint64)
        hashes += [own, near]
    starts, sizes = np.arange(300) * 60, np.full(300, 60)
    whole = np.concatenate(hashes)
    bands = passages.band_values(whole, starts, sizes)
    alone = [passages.band_values(h, np.zeros(1, int), np.full(1, 60))[0] for h in hashes]
    assert np.array_equal(bands, np.array(alone))
    sets = [set(passages.shingles_of(whole, s, 60).tolist()) for s in starts]
    similar = met = strangers = 0
    for i in range(300):
        for j in range(i):
            meet = bool((bands[i] == bands[j]).any())
            if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                similar += 1
                met += meet
            elif not sets[i] & sets[j]:
                strangers += meet
    assert similar >= 50 and met >= 0.97 * similar and strangers == 0


def test_near_paragraphs_collide(spark):
    rng = np.random.default_rng(2)
    hashes = rng.integers(0, 2**63, 400, dtype=np.uint64)
    starts, sizes, keys = passages.paragraph_keys(hashes)
    shifted = np.concatenate([rng.integers(0, 2**63, 17, dtype=np.uint64), hashes])
    assert len(set(keys.tolist()) & set(passages.paragraph_keys(shifted)[2].tolist())) >= len(keys) - 3
    assert starts[0] == 0 and sizes.sum() == 400 and len(keys) == len(starts)


@pytest.mark.parametrize("changes", [0, 1])
def test_passages_go_to_their_ends(spark, changes):
    rng = random.Random(11)
    words = lambda n: [f"w{rng.randrange(9000)}" for _ in range(n)]
    rows, shares, strangers = [], {}, {}
    for k in range(51, 81):
        passage = words(k)
        rows.append((k, " ".join(words(70) + passage + words(40))))
        other = list(passage)
        for _ in range(changes):
            other[rng.randrange(8, k - 8)] = "changed"
        before, after = words(60), words(50)
        rows.append((1000 + k, " ".join(before + other + after)))
        strangers[1000 + k] = (before, other, after)
    docs = spark.createDataFrame(
        [(d, t, len(t)) for d, t in rows], "doc_id long, text string, n_chars long"
    ).repartition(3)
    found = {r.doc_id: r.text.split() for r in passages.find_repeats(docs).collect()}
    assert set(found) <= set(strangers)
    for d, (before, passage, after) in strangers.items():
        left = found.get(d, before + passage + after)
        assert left[:55] == before[:55] and left[-45:] == after[-45:]
        shares[d] = (len(before) + len(passage) + len(after) - len(left)) / len(passage)
    assert np.mean([s > 0.98 for s in shares.values()]) >= 0.96
    assert np.mean(list(shares.values())) >= 0.97


def test_toxicity(spark, awkward, no_rows):
    rng = random.Random(7)
    plain = lambda: " ".join(f"word{chr(97 + rng.randrange(26))}{chr(97 + rng.randrange(26))}" for _ in range(40))
    rows, labels = [], []
    for i in range(900):
        bad = i % 6 == 0
        rows.append((i, plain() + (" blarg " if bad else " ") + plain()))
        labels.append((i, int(bad)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    lexicon = toxicity.learn(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert " blarg " in lexicon.entries
    truth = dict(labels)
    got = toxicity.score_toxicity(docs, lexicon).where("held_out").collect()
    assert all(r.predicted == truth[r.doc_id] and 0 <= r.score <= 1 for r in got) and len(got) > 100
    tricks = ["you b1arg", "you bl4rg", "you blаrg", "you blärg", "blargest", "you barg", "b l a r g"]
    scores = toxicity.score_toxicity(
        spark.createDataFrame(list(enumerate(tricks)), "doc_id long, text string"), lexicon
    ).collect()
    assert [r.n_matches > 0 for r in sorted(scores)] == [False, True, True, True, False, False, False]
    assert toxicity.score_toxicity(awkward, lexicon).count() == awkward.count()
    empty = toxicity.learn(no_rows, no_rows.select("doc_id", F.lit(1).alias("toxic")))
    assert {r.score for r in toxicity.score_toxicity(awkward, empty).collect()} == {0.5}


def test_exception_phrases_excuse():
    lexicon = toxicity.Lexicon({" dumb ": 3.0}, frozenset({" dumb bell "}), (-1.0, 1.0, 0.0, 0.0))
    found = lexicon.automaton()
    assert toxicity.matches(found, toxicity.fold("a dumb bell")) == []
    assert toxicity.matches(found, toxicity.fold("a DUMB, dumb bell")) == [(" dumb ", 3.0)]


def test_language(spark, small, awkward, no_rows):
    model = langid.learn(small)
    got = langid.identify(small, model).join(small.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert np.mean([r.lang_pred == r.lang for r in held]) > 0.9
    found = {r.doc_id: r for r in langid.identify(awkward, model).collect()}
    assert all(found[i].lang_pred == "und" and found[i].rejected for i in (1, 2, 3, 20))
    assert found[4].lang_pred in model.languages and 0 <= found[4].score <= 1
    assert langid.filter_languages(awkward, model).columns == awkward.columns
    none = langid.learn(no_rows)
    assert {r.lang_pred for r in langid.identify(awkward, none).collect()} == {"und"}
    assert langid.filter_languages(no_rows, none).count() == 0


@pytest.mark.parametrize("count", [1, 4, 8])
def test_rare_language_is_not_rejected(spark, small, count):
    docs = small.where("size(split(text, ' ')) >= 50").cache()
    rare = "fr"
    known = docs.where(~langid.held_out() & (F.col("lang") == rare)).orderBy("doc_id").limit(count)
    model = langid.learn(docs.where(F.col("lang") != rare).unionByName(known))
    got = langid.identify(docs.where(F.col("lang") == rare).join(known, "doc_id", "left_anti"), model)
    got = [r.rejected for r in got.collect()]
    assert len(got) > 10 and np.mean(got) <= 0.1
    far = spark.createDataFrame([(1, "жшщ ыъэ юяф цчх " * 30)], "doc_id long, text string")
    assert langid.identify(far, model).first().rejected


def test_pipeline(spark, awkward, small):
    docs = small
    for _, stage in corpus_pipeline.STAGES[:-1]:
        before = docs.count()
        docs = cut_lineage(stage(spark, docs, "/root/testdata/sf0.001"))
        assert docs.columns == small.columns and 0 < docs.count() <= before
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    assert {r.doc_id for r in rows} == {r.doc_id for r in docs.collect()}


def frames_left(spark):
    folder = Path(spark.conf.get("spark.checkpoint.dir"))
    return set(folder.iterdir()) if folder.exists() else set()


def test_stages_leave_little_behind(spark):
    """What a stage has cut on the way is removed; what it returns can be read after that."""
    rows = near_copies(60) + [(1000 + i, " ".join(f"v{i}x{k}" for k in range(200))) for i in range(60)]
    docs = spark.createDataFrame([(i, t, len(t)) for i, t in rows], "doc_id long, text string, n_chars long")
    for stage, most in ((ngram_join.drop_near_copies, 3), (passages.remove_repeats, 1)):
        before = frames_left(spark)
        left = stage(docs)
        assert left.count() == left.select("doc_id").distinct().count() > 60
        assert len(frames_left(spark) - before) <= most


def test_settled_keeps_only_its_result(spark):
    before = frames_left(spark)
    inner = settled(spark, lambda: cut_lineage(spark.range(5)).where("id > 1"))
    outer = settled(spark, lambda: settled(spark, lambda: cut_lineage(inner).where("id > 2")))
    with pytest.raises(ZeroDivisionError):
        settled(spark, lambda: cut_lineage(inner).limit(1 // 0))
    assert inner.count() == 3 and outer.count() == 2
    assert len(frames_left(spark) - before) == 2


def test_sets_are_made_for_few_texts_at_a_time(monkeypatch):
    """However many texts a batch holds, and however the counting is cut."""
    import pyarrow as pa

    texts = [None, "", "a b c d e f", "A b c d e g", "x " * 400, None, "a b c d e f"]
    batch = pa.record_batch({"doc_id": range(len(texts)), "text": pa.array(texts, pa.string())})
    whole = [s.tolist() for _, sets in ngram_join._sets(batch) for s in sets]
    monkeypatch.setattr(ngram_join, "SET_BYTES", 10)
    parts = list(ngram_join._sets(batch))
    assert [s.tolist() for _, sets in parts for s in sets] == whole and len(parts) > 2
    assert [i for part, _ in parts for i in part.column(0).to_pylist()] == list(range(len(texts)))
    again, number = ngram_join._repeated([s for _, sets in parts for s in sets])
    assert sorted(number.tolist()) == [2, 3] and len(again) == 2
