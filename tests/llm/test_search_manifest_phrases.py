"""Nearest neighbours, the Merkle manifest and collocations against plain Python."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lotledger.llm import kmeans_tree, merkle, merkle_tasks, neighbours, phrase_tasks, phrases
from lotledger.llm.queries import remainder

from .conftest import LOWER


# --- search ---------------------------------------------------------------

def exact(rows, k=5):
    """{query row: ids of the k nearest} by brute force over (id, vector)."""
    ids, vectors = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)
    units = kmeans_tree.unit(vectors)
    out = {}
    for q in np.flatnonzero(ids % 50 == 0):
        near = np.round(units @ units[q], 13)
        near[q] = -9
        out[ids[q]] = ids[np.lexsort((ids, -near))[:min(k, len(ids) - 1)]].tolist()
    return out


def test_search_reaches_its_recall_and_scores_exactly(spark):
    rng = np.random.default_rng(4)
    centers = rng.normal(size=(30, 16))
    rows = [(i, (centers[i % 30] + 0.3 * rng.normal(size=16)).tolist()) for i in range(6000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(7)
    got = defaultdict(dict)
    for r in neighbours.search(df, F.col("vec_id") % 50 == 0).collect():
        got[r["query_id"]][r["rank"]] = r
    want, by_id = exact(rows), dict(rows)
    assert set(got) == set(want) and all(sorted(v) == [1, 2, 3, 4, 5] for v in got.values())
    assert np.mean([r["vec_id"] in want[q] for q, found in got.items() for r in found.values()]) >= 0.95
    some = next(iter(got.values()))[1]
    assert some["calibrated_recall"] >= 0.97 and some["leaf_visits"] < 60
    for q, found in got.items():
        scores = [found[i]["score"] for i in range(1, 6)]
        assert scores == sorted(scores, reverse=True)
        for r in found.values():
            a, b = np.array(by_id[q]), np.array(by_id[r["vec_id"]])
            assert r["score"] == pytest.approx(a @ b / np.sqrt(a @ a) / np.sqrt(b @ b), abs=1e-12)


def test_search_of_ties_copies_and_odd_rows(spark):
    same, other = [1.0, 2.0, 0.0], [0.0, 0.0, 1.0]
    rows = [(i, same, "x") for i in range(0, 400)] + [(1000, other, "y"), (1001, [2.0, 4.0, 0.0], None), (1002, [2.0 ** -600, 2.0 ** -599, 0.0], None)]
    rows += [(1050, None, None), (1051, [0.0, 0.0, 0.0], None), (1052, [float("nan"), 1.0, 2.0], None), (1053, [1.0, None, 2.0], None), (1054, [], None),
             (None, same, None), (1100, [1.0, 2.0], None), (2000, other, "twice"), (2000, other, "twice")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, extra string").repartition(3)
    got = defaultdict(list)
    for r in neighbours.search(df, F.col("vec_id") % 50 == 0, keep=["extra"]).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], round(r["score"], 12), r["extra"]))
    assert got[0] == [(i, 1.0, "x") for i in (1, 2, 3, 4, 5)] and got[50] == [(i, 1.0, "x") for i in (0, 1, 2, 3, 4)]
    assert [x[0] for x in got[1000]] == [2000, 2000, 0, 1, 2]
    assert sorted(x[0] for x in got[2000]) == sorted([1000, 2000, 0, 1, 2] * 2) and 1100 not in got and 1050 not in got
    assert set(got) == {*range(0, 400, 50), 1000, 2000}
    few = spark.createDataFrame([(0, same), (1, other), (2, same)], "vec_id long, embedding array<double>")
    assert [(r["rank"], r["vec_id"]) for r in neighbours.search(few, F.col("vec_id") % 50 == 0).orderBy("rank").collect()] == [(1, 2), (2, 1)]
    assert neighbours.search(few.limit(0), F.col("vec_id") % 50 == 0).count() == 0
    assert neighbours.search(few, F.col("vec_id") == 77).columns == list(neighbours.RESULTS)
    with pytest.raises(ValueError, match="clash"):
        neighbours.search(few.withColumn("score", F.lit(1)), F.lit(True), keep=["score"])


def test_blocks_of_a_leaf_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 16)
    monkeypatch.setattr(neighbours, "BLOCK_QUERIES", 2)
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(900)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = defaultdict(list)
    for r in neighbours.search(df, F.col("vec_id") % 50 == 0, leaf_rows=10_000).orderBy("rank").collect():
        got[r["query_id"]].append(r["vec_id"])
    assert got == exact(rows)


def test_walk_visits_every_leaf_once_and_calibration_counts():
    rng = np.random.default_rng(6)
    points = kmeans_tree.unit(rng.normal(size=(3000, 8)))
    tree = kmeans_tree.Tree(points, 40)
    leaves = tree.leaf_of(points)
    held = np.bincount(leaves, minlength=tree.leaves)
    assert sorted(tree.walk(points[0])) == list(range(tree.leaves)) and held.sum() == 3000
    order = [x for x in tree.walk(points[0]) if held[x]]
    assert kmeans_tree.visits(tree, points[0], held, 3, 1) == order[:3]
    assert sum(held[x] for x in kmeans_tree.visits(tree, points[0], held, 1, 2000)) >= 2000
    truth = [[order[0], order[0], order[4], order[9]]]
    assert kmeans_tree.needed_visits(tree, points[:1], truth, held, 0.5)[0] == 1
    assert kmeans_tree.needed_visits(tree, points[:1], truth, held, 0.75) == (5, 0.75)
    assert kmeans_tree.needed_visits(tree, points[:1], truth, held, 0.99) == (10, 1.0)
    alike = kmeans_tree.Tree(np.repeat(points[:1], 500, 0), 4)
    assert alike.leaves == 1 and list(alike.walk(points[0])) == [0]


# --- manifest -------------------------------------------------------------

def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def levels_of(leaves):
    out = [leaves]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i:i + 16])) for i in range(0, len(out[-1]), 16)])
    return out


def path_of(levels, i):
    out = []
    for nodes in levels[:-1]:
        first = i // 16 * 16
        out.append(("".join(nodes[first:i]), "".join(nodes[i + 1:first + 16])))
        i //= 16
    return out


def leaf_text(row, text):
    fields = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    return "".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields)


def plain_manifest(rows):
    by = defaultdict(list)
    for r in rows:
        by[r["source"]].append((r["doc_id"] is not None, r["doc_id"] or 0, sha(leaf_text(r, r["text"])), r))
    trees, order = {}, sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    for source, held in by.items():
        held.sort(key=lambda x: x[:3])
        trees[source] = levels_of([x[2] for x in held])
    top = levels_of([trees[s][-1][0] for s in order])
    out = []
    for at, source in enumerate(order):
        for i, (_, _, leaf, r) in enumerate(by[source]):
            path = path_of(trees[source], i) + path_of(top, at)
            told, text = leaf, r["text"]
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0:
                told = sha(leaf_text(r, None if text is None else text.translate(LOWER)))
            for before, after in path:
                told = sha(before + told + after)
            out.append((r["doc_id"], leaf, trees[source][-1][0], top[-1][0], sha("".join(a + b for a, b in path)), told, told == top[-1][0]))
    return out


def test_positions_follow_the_log():
    for leaves in [1, 2, 15, 16, 17, 31, 255, 256, 257, 272, 273, 300, 4095, 4096]:
        names = [sha(str(i)) for i in range(leaves)]
        for height in {merkle_tasks.height_of(leaves), 3}:
            log, nodes = merkle_tasks.build_log(names, height), names
            assert len(log) == sum(merkle_tasks.ceiling(leaves, 16 ** m) for m in range(height + 1))
            for level in range(height + 1):
                assert [log[merkle_tasks.postorder_position(level, i, leaves, height)] for i in range(len(nodes))] == nodes
                nodes = [sha("".join(nodes[i:i + 16])) for i in range(0, len(nodes), 16)]
            some = random.Random(leaves).randrange(leaves)
            found = merkle_tasks.siblings(log, some, leaves, height)
            assert found == merkle_tasks.run_siblings(log, leaves, height)[some]
            assert merkle_tasks.folded(names[some], found) == log[-1]


@pytest.mark.parametrize("height", [3, 1])
def test_manifest_equals_plain_trees(spark, monkeypatch, height):
    # builders of one run only let rounds nest several deep
    monkeypatch.setattr(merkle, "RANGE_ROWS", 100)
    rng = random.Random(3)
    rows = [(i * 7 % 5000, f"Text {i} É" * rng.randint(0, 5) if i % 11 else None, rng.choice(["en", None]),
             rng.choice(["hot", "hot", "hot", "é", "z", None, "", *[f"s{j}" for j in range(40)]]), rng.choice([None, i]), "kept") for i in range(1, 1200)]
    rows += [(None, "NULL id", "en", "z", 3, "kept")] * 2 + [(9000, "Again", "de", "hot", 1, "kept")] * 3 + [(9001, "L" * 200_000, "de", "one", 1, "kept")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score string").repartition(6)
    tampered = (remainder(5) == 0, {"text": merkle.lowered(F.col("text"))})
    got = merkle.manifest(df, ["doc_id", "score"], tampered=tampered, height=height)
    assert Counter(tuple(r) for r in got.drop("score").collect()) == Counter(plain_manifest(df.collect()))
    if height == 3:
        assert merkle.manifest(df.limit(0)).count() == 0
        with pytest.raises(ValueError, match="clash"):
            merkle.manifest(df.withColumn("root", F.lit(1)), ["doc_id", "root"])
        one = df.where("doc_id = 9001")
        assert [tuple(r) for r in merkle.manifest(one, tampered=tampered).collect()] == plain_manifest(one.collect())
        log = merkle.postorder_log(one)
        assert [(r["builder"], r["position"]) for r in log.collect()] == [(0, 0)]


# --- phrases --------------------------------------------------------------

def plain_phrases(rows, support=10, top=2000):
    counts, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for size in (1, 2, 3):
                counts[lang].update(tuple(words[i:i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, f in counts.items():
        ranked = []
        for phrase, a in f.items():
            if len(phrase) == 1 or a < support:
                continue
            score, _, left, right = min((1_000_000 * a * a // (f[phrase[:k]] * f[phrase[k:]]), k, f[phrase[:k]], f[phrase[k:]]) for k in range(1, len(phrase)))
            if len(phrase) == 2 and any(len(p) == 3 and b >= support and phrase in (p[:2], p[1:]) and 100 * b >= 50 * a for p, b in f.items()):
                continue
            ranked.append((-score, -a, " ".join(phrase).encode(), left, right))
        for i, (score, a, phrase, left, right) in enumerate(sorted(ranked)[:top], 1):
            out.append((lang, i, phrase.decode(), -a, left, right, total[lang], -score))
    return sorted(out)


def test_phrases_equal_plain_counts(spark, docs, no_docs, monkeypatch):
    rng = random.Random(9)
    words = ["New", "york", "city", "the", "é", "a b", "x-1", "und", "\x00", "of"]
    rows = [(rng.choice(["en", "de", None, "und"]), "".join(rng.choice(words) + rng.choice([" ", "  ", "\t", ", ", ". ", "\n", "\x0b", " "]) for _ in range(rng.randint(0, 60))))
            for _ in range(400)]
    rows += [("en", "new york city hall " * 30)] * 5 + [("en", None), ("en", ""), ("en", " ,. "), ("de", "solo " * 25)]
    df = spark.createDataFrame(rows, "lang string, text string").withColumn("score", F.lit(1)).repartition(9)
    want = plain_phrases(rows)
    assert len(want) > 50
    assert sorted(tuple(r) for r in phrases.collocations(df).collect()) == want
    # counting goes on across stretches and blocks; a filter too small only lets more through
    monkeypatch.setattr(phrases, "MOST_BITS", 1)
    one = df.coalesce(1)
    assert sorted(tuple(r) for r in phrases.collocations(one, shards=3).collect()) == want
    assert sorted(tuple(r) for r in phrases.collocations(df, top=7).collect()) == plain_phrases(rows, top=7)
    assert phrases.collocations(no_docs.withColumn("lang", F.lit("en"))).count() == 0
    odd = docs.withColumn("lang", F.lit("en"))
    assert sorted(tuple(r) for r in phrases.collocations(odd).collect()) == plain_phrases([("en", r["text"]) for r in odd.collect()])


def test_stretches_and_blocks_count_alike(monkeypatch):
    rng = random.Random(1)
    texts = [" ".join(rng.choices("abcdefgh", k=300)).replace(" h", ". h").encode() for _ in range(30)]

    def total():
        out, counter = Counter(), phrase_tasks.Counter((1, 2, 3))
        for found in [f for t in texts for f in counter.add("en", t)] + list(counter.flush()):
            _, size, grams = found
            out.update({"words": grams} if not size else dict(zip(grams.phrases(), grams.counts.tolist(), strict=True)))
        return out
    want = total()
    monkeypatch.setattr(phrase_tasks, "TOKENS", 50)
    monkeypatch.setattr(phrase_tasks, "BLOCK", 64)
    assert total() == want
    assert b"".join(phrase_tasks.blocks(texts[0])) == texts[0]


@pytest.mark.parametrize("least", [1, 3])
def test_packed_hashes_reach_their_support_in_a_part(least):
    # a task's phrases leave it as a row per bucket at most, however many they are
    rng = np.random.default_rng(7)
    parts, want, rows = {}, set(), 0
    for part in range(2):
        total = Counter()
        for _ in range(3):
            hashes = np.unique(rng.integers(0, 1 << 63, 30_000).astype(np.uint64)[:20_000] // np.uint64(1 << 49) * np.uint64((1 << 50) + 1))
            counts = rng.integers(1, 4, len(hashes))
            total.update(dict(zip(hashes.tolist(), counts.tolist(), strict=True)))
            sent = [(b, packed) for some in phrase_tasks.bucketed(hashes, counts, least) for b, packed in zip(some[0].tolist(), some[1], strict=True)]
            assert len(sent) == len({b for b, _ in sent}) <= 1 << phrase_tasks.BUCKET_BITS < len(hashes)
            for b, packed in sent:
                parts.setdefault(b, {}).setdefault(part, []).append(packed)
        want |= {h for h, n in total.items() if n >= least}
    got = [h for b in parts for h in phrase_tasks.reaching(parts[b].values(), least).tolist()]
    assert len(got) == len(set(got)) and set(got) == want and 0 < len(want)


@pytest.mark.parametrize("support,shards", [(10, 4), (10, 1), (10, 9), (10, 30), (1, 4), (7, 3)])
def test_no_spread_of_occurrences_escapes_the_local_support(support, shards):
    local = phrases.local_support(support, shards)
    assert shards * (local - 1) < support and (local == 1 or shards * local >= support)


def test_filters_hold_what_was_put_in(spark):
    rng = np.random.default_rng(2)
    hashes = rng.integers(-(1 << 63), (1 << 63) - 1, 200_000)
    df = spark.createDataFrame([(int(h),) for h in hashes], "h long")
    held = phrases._filter(df).value
    assert held.count > 1 and held.holds(hashes.view(np.uint64)).all()
    others = rng.integers(0, 1 << 63, 100_000).astype(np.uint64)
    assert held.holds(others).mean() < 0.05
