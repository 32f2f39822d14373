"""Language, quality, tokens, near duplicates and vectors against brute force and held-out labels."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import tiktoken
import public_tokenizers
from pyspark.sql import functions as F

from lotledger.llm import bpe, embeddings, hnsw, language, ngram_join, pii, quality
from lotledger.llm.bpe_tasks import Coder, merge, parse_ranks
from lotledger.llm.components import components
from lotledger.llm.language_tasks import Network, gradients, train
from lotledger.llm.ngram_tasks import Plan, distance, long_sketch, shingle_sets
from lotledger.llm.queries import QUERIES, remainder

from .conftest import LOWER, SF

RAW = open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb").read()


@pytest.fixture(scope="module")
def known():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=parse_ranks(RAW), special_tokens={})


def test_tokens_equal_the_public_library(known):
    rng = random.Random(2)
    parts = list("ab e'stx 1.\n\t é漢 \u00a0\u3000") + ["'ll", "  ", " the", "<|endoftext|>"]
    said = ["".join(rng.choices(parts, k=rng.randint(0, 40))) for _ in range(5000)] + ["x" * 3000, "ab " * 500_000, " ", "\n \n", "a  b"]
    coder = Coder(RAW, public_tokenizers.PATTERN)
    for text, blocks in zip(said, coder.each(said), strict=True):
        ids = np.frombuffer(b"".join(blocks), "<u4").tolist()
        assert ids == known.encode_ordinary(text), text[:60]


def test_tree_of_one_piece_equals_trees_together(known):
    ranks, rng = parse_ranks(RAW), random.Random(3)
    pieces = ["".join(rng.choices("thernoé", k=rng.randint(1, 70))).encode()[:65] for _ in range(500)]
    together = Coder(RAW, public_tokenizers.PATTERN).merger.merge_all(pieces)
    assert [np.frombuffer(t, "<u4").tolist() for t in together] == [merge(p, ranks) for p in pieces]


def test_tables_of_the_coder_stay_small():
    coder, rng = Coder(RAW, public_tokenizers.PATTERN), random.Random(5)
    texts = [" ".join("".join(rng.choices("thernoaisdlu", k=9)) for _ in range(10_000)) for _ in range(40)]
    held = 0
    for blocks in coder.each(texts):
        assert sum(map(len, blocks))
        held = max(held, len(coder.chunks) + len(coder.pieces))
    assert held < 300_000


def test_passes_of_a_worker_stay_small():
    import tracemalloc

    from lotledger.llm import ngram_tasks

    rng = random.Random(6)
    texts = [" ".join("".join(rng.choices("thernoaisdlu", k=5)) for _ in range(1000)) for _ in range(300)]
    net = Network(["de", "en", "fr", "es", "it"])
    ngram_tasks._powers.cache_clear()
    for run in (lambda: net.predict(texts, "und"), lambda: sum(map(len, shingle_sets(texts, 5)))):
        tracemalloc.start()
        run()
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert most < 36 << 20


def test_small_tables_start_no_python_workers(spark, monkeypatch):
    rows = spark.createDataFrame([(f"sehr gut {i}", "de") for i in range(60)] + [("bien", None), ("1", "fr")], "text string, lang string")
    rows, none = rows.localCheckpoint(), rows.where("false").localCheckpoint()

    def refuse(*_, **__):
        raise AssertionError("Python workers for rows of the driver")

    monkeypatch.setattr(type(spark.sparkContext), "parallelize", refuse)
    assert len(language.training_rows(rows, "text", "lang", 10, F.xxhash64("text"))) == 10
    assert language.training_rows(none, "text", "lang", 10, F.xxhash64("text")) == []
    assert len(pii.Selector(spark).trees)


def test_token_digests_and_round_trip(docs, no_docs, known):
    kept = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    for r in bpe.digest(docs).collect():
        ids = known.encode_ordinary(kept[r["doc_id"]])
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(kept[r["doc_id"]].encode()).hexdigest()
    back = bpe.decode(bpe.encode(docs, ["doc_id", "size"]), ["doc_id", "size"])
    assert all(r["bytes"].decode() == kept[r["doc_id"]] for r in back.collect())
    assert bpe.digest(no_docs).count() == 0
    with pytest.raises(ValueError):
        bpe.digest(docs.withColumn("n_tokens", F.lit(1)), ["n_tokens"])


def test_gradients_follow_the_loss():
    net, rng = Network(["a", "b"], 3), np.random.default_rng(1)
    for p in net.parameters():
        p[...] = p.astype(np.float32)
    codes, labels = rng.integers(97, 120, (6, 4)), np.array([0, 1, 0, 1])
    _, grads = gradients(net, codes, labels)
    for p, g in zip(net.parameters(), grads, strict=True):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        old, step = p[at], np.float32(1e-2)
        p[at] = old + step
        up = gradients(net, codes, labels)[0]
        p[at] = old - step
        down = gradients(net, codes, labels)[0]
        p[at] = old
        assert abs((up - down) / (2 * step) - g[at]) < 0.05 * abs(g[at]) + 1e-4


def test_language_of_odd_texts_and_tables(spark, docs, no_docs):
    pairs = [("the cat sat on the mat and then", "en"), ("der Hund läuft über die Straße", "de")] * 30
    net = train(pairs, steps=60)
    out = {r["doc_id"]: r for r in language.identify(docs, net).collect()}
    assert language.identify(docs, net).count() == 14
    assert {i for i in out if out[i]["lang_pred"] == "und"} == {4, 5, 8} and out[9]["lang_pred"] == "de"
    assert all(0 <= r["score"] <= 1 for r in out.values())
    assert language.identify(no_docs, net).count() == 0
    assert language.fit(docs.withColumn("lang", F.lit(None).cast("string"))) is None
    assert {r["lang_pred"] for r in language.identify(docs, None).collect()} == {"und"}
    kept = language.keep_identified(docs.withColumn("lang", F.lit("x")), net, 0.0)
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(i) for i in (1, 2, 2, 3, None, 6, 7, 9, 10, 11, 12))


def test_copies_do_not_empty_a_label_s_sample(spark):
    said = ["der Hund läuft", "die Katze schläft", "ein Vogel singt", "das Pferd frisst", "wir gehen heim"]
    rows = spark.range(5000).select(F.element_at(F.array(*map(F.lit, said)), (F.col("id") % 5 + 1).cast("int")).alias("text"), F.lit("de").alias("lang"))
    # the last key: the largest hashes, none of which a share of all values lets through
    for key in (F.xxhash64("text"), F.xxhash64("text") % 1000 + (1 << 62), F.lit(1 << 62) + F.crc32("text")):
        assert sorted(language.training_rows(rows, "text", "lang", 10, key)) == sorted((t, "de") for t in said)
    many = spark.range(3000).select(F.concat(F.lit("wort "), F.col("id").cast("string")).alias("text"), F.lit("de").alias("lang"))
    for key in (F.xxhash64("text"), F.lit(1 << 62) + F.crc32("text")):
        want = [r["text"] for r in many.orderBy(key).limit(10).collect()]
        assert language.training_rows(many.union(many), "text", "lang", 10, key) == [(t, "de") for t in want]


def test_every_label_is_learned(spark):
    rows = spark.range(70 * 12 + 1).select(F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"),
                                           F.when(F.col("id") < 70 * 12, F.format_string("l%02d", F.col("id") % 70)).alias("lang"))
    lone = spark.createDataFrame([("seldom", "rare"), ("1 2", "none"), (None, "none")], "text string, lang string")
    got = Counter(name for _, name in language.training_rows(rows.union(lone), "text", "lang", 10, F.xxhash64("text")))
    assert got == {f"l{i:02d}": 10 for i in range(70)} | {"rare": 1}
    assert len(language.fit(rows.union(lone), per_label=2).labels) == 71


def test_long_texts_pool_all_windows(spark):
    net = train([("the cat sat on the mat", "en"), ("der Hund über die Straße", "de")] * 30, steps=60)
    short, long_ = "der Hund läuft über die Straße " * 4, "the cat sat " + "der Hund läuft über die Straße " * 60_000
    names, scores = net.predict([short, long_, None], "und")
    assert names[:2] == ["de", "de"] and scores[2] == 0.0


def test_predictions_equal_a_plain_run_by_byte():
    from lotledger.llm.language_tasks import HIDDEN, WINDOW

    net = train([("the cat sat on the mat", "en"), ("der Hund über die Straße", "de"), ("le chat est là", "fr")] * 20, steps=30)
    rng = random.Random(2)
    texts = ["a", "Straße 12!", "x" * WINDOW, "the cat " * 40, "".join(rng.choices("abc éß.,1", k=5 * WINDOW + 3))]
    names, scores = net.predict(texts, "und")
    for text, name, score in zip(texts, names, scores, strict=True):
        raw, pooled, letters = text.encode(), np.zeros(len(net.labels)), 0
        for at in range(0, len(raw), WINDOW):
            window = raw[at:at + WINDOW].ljust(WINDOW, b"\0")
            states = np.zeros((2, WINDOW, HIDDEN))
            for d in range(2):
                h = np.zeros(HIDDEN)
                for t in range(WINDOW - 1, -1, -1) if d else range(WINDOW):
                    both = net.inputs[d][window[t]].astype(float) + h @ net.recurrent[d].astype(float)
                    gate = (1 + np.tanh(both[:HIDDEN])) / 2
                    h = states[d, t] = (1 - gate) * h + gate * np.tanh(both[HIDDEN:])
            for t, byte in enumerate(window):
                if byte >= 128 or chr(byte).isalpha():
                    logits = np.concatenate(states[:, t]) @ net.out.astype(float) + net.bias
                    p = np.exp(logits - logits.max())
                    pooled, letters = pooled + p / p.sum(), letters + 1
        assert net.labels[int(np.argmax(pooled))] == name and abs(pooled.max() / letters - score) < 1e-4


def test_votes_equal_plain_products(spark, docs):
    rng = random.Random(3)
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()
    said = [(100 + i, " ".join(rng.choices(words[:7] if i % 2 else words[4:], k=40))) for i in range(80)]
    table = docs.select("doc_id", "text").where("doc_id <= 9").unionByName(spark.createDataFrame(said, "doc_id long, text string"))
    marks = spark.createDataFrame([(i, i % 2) for i, _ in said[:60]] + [(1, 1), (5, 0)], "doc_id long, quality int")
    voters = quality.fit(table, marks, F.lit(True))
    out = {r["doc_id"]: r["score"] for r in quality.score(table, voters).collect()}
    for r in table.collect():
        vector = (quality.term_weights(quality.term_counts(r["text"])[None]) - voters.center)[0].astype(float) @ voters.projection.astype(float)
        vector /= max(np.sqrt(vector @ vector), 1e-12)
        cosines = sorted(((float(vector @ v), float(y)) for v, y in zip(voters.vectors.astype(float), voters.labels, strict=True)), reverse=True)
        near = cosines[:quality.NEIGHBOURS]
        weights = [max(c, 1e-3) ** quality.SHARPNESS for c, _ in near]
        if cosines[quality.NEIGHBOURS - 1][0] - cosines[quality.NEIGHBOURS][0] > 1e-5:  # no tie at the edge
            assert abs(out[r["doc_id"]] - sum(w * y for w, (_, y) in zip(weights, near, strict=True)) / sum(weights)) < 1e-3


def test_language_and_quality_on_held_out_rows(spark):
    data = "/root/testdata/sf0.01"
    told = QUERIES["op7_bidirectional_gru"](spark, data).join(spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "lang"), "doc_id")
    r = told.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert r > 0.97
    scored = QUERIES["op1_latent_neighbours"](spark, data)
    assert scored.count() == 1000 and scored.where("score < 0 or score > 1").count() == 0
    right = scored.where("held_out").join(spark.read.parquet(f"{data}/labels.parquet"), "doc_id").agg(
        F.avg((F.col("quality") == F.col("predicted")).cast("int"))).first()[0]
    assert right > 0.9


def test_remainder_is_the_contract_s(spark):
    rows = spark.range(200).withColumnRenamed("id", "doc_id").select("doc_id", remainder(5).alias("r")).collect()
    assert all(r["r"] == zlib.crc32(str(r["doc_id"]).encode()) % 5 for r in rows)


def test_quality_of_odd_tables(docs, no_docs, spark):
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (3, None, 0), (9, 0, 0), (None, 1, 1), (77, 0, 0), (6, 0, 0), (6, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    voters = quality.fit(docs, labels, F.lit(True))
    assert sorted(voters.labels) == [0.0, 0.5, 1.0]
    out = quality.score(docs, voters, ["doc_id", "size"])
    assert out.count() == 14 and out.where("score is null or score < 0 or score > 1").count() == 0
    assert quality.score(no_docs, voters).count() == 0
    assert quality.fit(docs, labels.limit(0), F.lit(True)) is None
    assert {(r["score"], r["predicted"]) for r in quality.score(docs, None).collect()} == {(0.5, 1)}


def sets_of(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not words:
        return set()
    return {tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1))}


def linked(sets, percent):
    label = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = [new if x == old else x for x in label]
    return label


@pytest.mark.parametrize("percent", [60, 80, 85, 95])
def test_linked_sets_share_a_key(percent):
    plan, rng = Plan(percent), np.random.default_rng(percent)
    tried = 0
    for size in [*range(1, 60), 100, 300, 1000]:
        for _ in range(30):
            a = np.unique(rng.integers(0, 1 << 63, size, np.uint64) * np.uint64(2))
            gone, more = rng.integers(0, plan.differ(size) + 1, 2)
            b = np.unique(np.r_[rng.permutation(a)[int(gone):], rng.integers(0, 1 << 63, int(more), np.uint64)])
            both = len(np.intersect1d(a, b))
            if both and 100 * both >= percent * (len(a) + len(b) - both) and len(b) and gone + more:
                tried += 1
                assert len(np.intersect1d(plan.keys(a), plan.keys(b)))
    assert tried > 50


def test_long_sketches_bound_the_difference_from_below():
    rng = np.random.default_rng(5)
    assert long_sketch(np.arange(128, dtype=np.uint64)) is None
    for size, dropped, added in [(140, 3, 0), (600, 30, 500), (1000, 0, 1), (5000, 700, 40)]:
        tokens = np.sort(rng.integers(0, 1 << 63, size + added, np.uint64))
        one, two = tokens[:size], tokens[dropped:]
        x, y = long_sketch(one), long_sketch(two)
        differ = dropped + added
        assert len(x) * 8 >= 4 * size and distance(x, x) == 0
        assert differ * 0.6 <= distance(x, y) <= differ
        assert distance(x, y) == distance(y, x)


def test_spare_segments_of_long_texts_stay_few():
    plan = Plan(80)
    plan._extend(1_000_000)
    for low, high, _, segments, spare in plan.bands:
        least = segments - spare
        assert least == plan.differ(high) + 1
        assert low < 5000 or spare < least / 5
    assert Plan._tail(157_000, 60_000, 60_000) < 1e-6 and Plan._tail(157_000, 60_000, 0) > 0.999


def test_shingle_sets_of_long_and_odd_texts():
    long_ = " ".join(f"w{i % 5003}" for i in range(400_000))
    said = [None, "", " \t", "a", "A", "a b", "a b c d", "A\tb  c\nd e", "é É", "x" * 3_000_000, long_, "tail of it all ok"]
    found = [set(s.tolist()) for s in shingle_sets(said, 4)]
    assert [len(s) for s in found] == [len(sets_of(t, 4)) for t in said]
    for i, a in enumerate(said):
        for j, b in enumerate(said):
            assert len(found[i] & found[j]) == len(sets_of(a, 4) & sets_of(b, 4))


def test_long_words_stand_alone_among_words():
    head, tail = " ".join(f"w{i}" for i in range(240_000)), "tail of it all"
    runs = ["x" * 2_000_000, "ab" * 1_300_000, "ab" * 1_300_000 + "c", "y" * (1 << 20), "z" * ((1 << 20) + 1)]
    said = [f"{head} {r} {tail}" for r in runs] + [f"{r}  {head}\t{tail}" for r in runs]
    said += [f"{' ' * 300_000}one more {said[0]}", f"{head} {runs[0]}\n", f"{runs[0]} {runs[1]}", f"{' ' * 2_500_000}{tail}"]
    found = [set(s.tolist()) for s in shingle_sets(said, 4)]
    want = [sets_of(t, 4) for t in said]
    assert [len(s) for s in found] == [len(s) for s in want]
    for i, a in enumerate(found):
        for j in range(i):
            assert len(a & found[j]) == len(want[i] & want[j])


def test_near_duplicates_against_all_pairs(spark, docs, no_docs):
    rng = random.Random(4)
    vocabulary = [f"t{i}" for i in range(300)]
    rows = []
    for g in range(25):
        own = rng.choices(vocabulary, k=rng.choice([4, 6, 9, 14, 30, 80, 200]))
        for _ in range(rng.choice([1, 2, 5, 12])):
            said = list(own)
            for _ in range(rng.randint(0, max(1, len(own) // 25))):
                said[rng.randrange(len(said))] = rng.choice(vocabulary)
            rows.append((100 + len(rows), " ".join(said)))
    df = docs.select("doc_id", "text").where("doc_id is not null").dropDuplicates(["doc_id"]).unionByName(spark.createDataFrame(rows, "doc_id long, text string"))
    ordered = sorted((r["doc_id"], r["text"]) for r in df.where("text is not null").collect()) + [(4, None)]
    ordered.sort(key=lambda r: r[0])
    sets = [sets_of(t, 4) for _, t in ordered]
    want = {ordered[i][0]: (len(sets[i]), ordered[k][0]) for i, k in enumerate(linked(sets, 85))}
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.near_duplicates(df, size=4, percent=85).collect()}
    assert got == want and len({c for _, c in got.values()}) < len(got) - 20
    assert ngram_join.near_duplicates(no_docs).count() == 0
    left = ngram_join.deduplicate(docs)
    assert left.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in left.collect()) == sorted(str(i) for i in (1, 4, 5, 6, 8, 9, 10, 11, 12))


def test_crowded_keys_take_turns_and_lose_no_link(spark):
    """Copies of one text, each with its own edits: most pairs are no links, chains join some."""
    rng = random.Random(11)
    texts = []
    for _ in range(120):
        words = [f"b{i}" for i in range(200)]
        for place in rng.sample(range(200), rng.randint(1, 5)):
            words[place] = f"e{rng.randrange(40)}"
        texts.append(" ".join(words))
    want = dict(enumerate(linked([sets_of(t, 4) for t in texts], 85)))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.near_duplicates(df, size=4, percent=85).collect()}
    assert got == want and 3 < len(set(want.values())) < 110


@pytest.mark.parametrize("few", [-1, 20_000])
def test_turns_try_several_centers(spark, monkeypatch, few):
    """Chains in one key: turns compare few pairs with whole sets at once, and every turn tries several centers."""
    labels, plain = [], ngram_join.materialize
    monkeypatch.setattr(ngram_join, "materialize", lambda df, label: labels.append(label) or plain(df, label))
    monkeypatch.setattr(ngram_join, "FEW_PAIRS", few)
    texts = [" ".join([f"e{k}_{i}" if i % 40 < min(k, 4) else f"b{i}" for i in range(120)]) for k in range(8)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = dict(enumerate(linked([sets_of(t, 4) for t in texts], 85)))
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.near_duplicates(df, size=4, percent=85).collect()}
    assert got == want
    assert ("long-sketches" in labels) == (few < 0) and labels.count("pairs") <= 3


def test_components_of_chains_and_loops(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 102), (102, 100), (200, 200)]
    out = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {out[i] for i in range(61)} == {0} and {out[i] for i in (100, 101, 102)} == {100}


def test_vectors_against_all_pairs(spark):
    rng = np.random.default_rng(9)
    rows = []
    for g in range(30):
        center = rng.normal(size=12)
        for _ in range(rng.choice([1, 2, 6, 90])):
            rows.append((len(rows), (center + 0.06 * rng.normal(size=12)).tolist(), int(g % 3)))
    odd = [([0.0] * 12, 1), (None, 1), ([1.0, None] * 6, 1), ([float("nan")] * 12, 1), ([float("inf")] + [0.0] * 11, 1), (rows[0][1], None), ([], 0)]
    rows += [(900 + i, v, label) for i, (v, label) in enumerate(odd)]
    rows += [(len(rows) + 1000 + i, rows[0][1], rows[0][2]) for i in range(5)] + [(None, rows[0][1], rows[0][2])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("n", F.lit(1))
    good = [i for i, (k, v, label) in enumerate(rows) if k is not None and label is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    unit = np.array([np.array(rows[i][1]) / np.linalg.norm(rows[i][1]) for i in good])
    same = np.array([[rows[i][2] == rows[j][2] for j in good] for i in good])
    near = (unit @ unit.T >= 0.98) & same
    np.fill_diagonal(near, False)
    label = np.array([rows[i][0] for i in good])
    while True:
        new = np.minimum(label, np.where(near, label[None, :], 1 << 40).min(1))
        if (new == label).all():
            break
        label = new
    want = {rows[i][0]: (int(near[n].sum()), int(label[n])) for n, i in enumerate(good)}
    for shard_rows in (64, 16_384):
        out = embeddings.link_vectors(df, keep=["n"], shard_rows=shard_rows).collect()
        assert len(out) == len(rows)
        for r in out:
            links, component = want.get(r["vec_id"], (0, r["vec_id"]))
            assert (r["n_links"], r["component_id"]) == (links, component)
            assert r["kept"] == (None if r["vec_id"] is None else r["vec_id"] == component)
    assert embeddings.link_vectors(df.limit(0)).count() == 0


class Blind:
    """A graph whose search meets only the query's own node, or a node far away."""

    def __init__(self, vectors, own):
        self.vectors, self.own = vectors, own

    def search(self, queries, width):
        ids, sims = np.full((len(queries), width), -1), np.full((len(queries), width), -2, np.float32)
        nearest = queries @ self.vectors.T
        ids[:, 0] = nearest.argmax(1) if self.own else nearest.argmin(1)
        sims[:, 0] = nearest.max(1) if self.own else nearest.min(1)
        return ids, sims


@pytest.mark.parametrize("links", [1, 5, 700])
def test_audit_sees_links_that_a_graph_misses(links):
    rng = np.random.default_rng(links)
    one = hnsw.normalized(rng.normal(size=(1500, 16)))
    near = hnsw.normalized(one[7:7 + links] + 0.01 * rng.normal(size=(links, 16)))
    inside = np.concatenate([one, near])
    other = np.concatenate([hnsw.normalized(rng.normal(size=(800, 16))), near])
    for vectors, queries, same in ((inside, inside, True), (other, one, False)):
        hits, exact = hnsw.range_search(Blind(vectors, same), vectors, queries, 0.98, same)
        true = queries @ vectors.T >= 0.98
        if same:
            np.fill_diagonal(true, False)
        assert true.sum() >= links
        assert all(exact[q] or set(hits[q]) == set(np.flatnonzero(true[q])) for q in range(len(queries)))


def test_pipeline_stages_and_brute_force(spark):
    import corpus_pipeline

    from .test_native import base_spans, words_of

    assert [n for n, _ in corpus_pipeline.STAGES] == ["language ID", "n-gram Jaccard join", "benchmark decontamination", "PII", "byte-level BPE"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    bench = [words_of(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    windows = {tuple(w[i:i + 10]) for w in bench if w for i in range(max(1, len(w) - 9))}
    assert {len(w) for w in windows} == {10}
    (_, lang), (_, near), (_, clean), (_, hide), (_, encode) = corpus_pipeline.STAGES
    one = lang(spark, docs, SF).cache()
    kept = {r["doc_id"] for r in one.collect()}
    assert one.columns == columns and kept == {i for i, t in texts.items() if re.search(r"[^\W\d_]", t or "")}
    two = near(spark, one, SF).cache()
    order = sorted(kept)
    sets = [sets_of(texts[i], 5) for i in order]
    want = {order[k] for k in linked(sets, 80)}
    assert two.columns == columns and {r["doc_id"] for r in two.collect()} == want and len(want) < len(kept)
    three = clean(spark, two, SF).cache()
    left = {i for i in want if not any(tuple(w[p:p + 10]) in windows for w in [words_of(texts[i])] for p in range(len(w) - 9))}
    assert three.columns == columns and {r["doc_id"] for r in three.collect()} == left
    four = hide(spark, three, SF).cache()
    assert four.columns == columns and {r["doc_id"] for r in four.collect()} == left
    assert all(not base_spans(r["text"]) and r["n_chars"] == len(r["text"]) for r in four.collect())
    assert any(r["text"] != texts[r["doc_id"]] for r in four.collect())
    assert {r["doc_id"] for r in encode(spark, four, SF).collect()} == left
    assert Counter(corpus_pipeline.run(spark, SF).columns) == Counter(["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
