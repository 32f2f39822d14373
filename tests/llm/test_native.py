"""Sharding, licenses, URLs, decontamination and personal data against plain Python."""

import hashlib
import math
import random
import re
import time
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lotledger.llm import decontaminate, embeddings, licenses, ngram_join, pii, sharding, urls

from .conftest import SF, digest_of, words_of


def texts(docs):
    return [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]


def test_shards_hold_every_row_once_with_near_equal_bytes(spark):
    rows = [(i, "same" * 50 if i % 3 == 0 else "t" * (i % 97)) for i in range(4000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    out = sharding.shard(df, slice_rows=100).collect()
    assert Counter(r["doc_id"] for r in out) == Counter(i for i, _ in rows)
    total = sum(r["size"] for r in out)
    for shard in range(8):
        own = [r for r in out if r["shard"] == shard]
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
        assert abs(sum(r["size"] for r in own) - total / 8) <= 2 * 201
    kept = dict(rows)
    assert all(r["size"] == len(kept[r["doc_id"]]) + 1 and r["text_crc32"] == zlib.crc32(kept[r["doc_id"]].encode()) for r in out)


def test_splitters_equal_a_plain_search(spark):
    rng = random.Random(4)
    rows = [(rng.randint(-(1 << 63), (1 << 63) - 1), rng.randint(1, 50)) for _ in range(3000)] + [(7, 9)] * 400 + [(-(1 << 63), 3), ((1 << 63) - 1, 3)]
    total, held = sum(s for _, s in rows), sorted(rows)
    targets = [total * i // 40 for i in range(1, 40)]
    table = spark.createDataFrame(rows, "_key long, size long")
    found = sharding.find_splitters(table, targets, slack=0, probes=64)
    below = lambda cut: sum(s for k, s in held if k < cut)
    edges = sorted({below(k) for k, _ in held} | {total})
    for target, cut in zip(targets, found, strict=True):
        assert abs(below(cut) - target) == min(abs(e - target) for e in edges)
    looked = table.select("_key", sharding._lookup(F.col("_key"), sorted(found)).alias("n")).collect()
    assert all(r["n"] == sum(c <= r["_key"] for c in found) for r in looked)


def test_thousands_of_cuts(spark):
    rows = spark.range(20_000).selectExpr("id doc_id", "repeat(cast(id as string), cast(id % 7 as int)) text")
    out = sharding.shard(rows, shards=3000, slice_rows=2000)
    per = out.groupBy("shard").agg(F.count("*").alias("n"), F.min("slot").alias("a"), F.max("slot").alias("b"), F.countDistinct("slot").alias("d"), F.sum("size").alias("s"))
    found = per.collect()
    assert sum(r["n"] for r in found) == 20_000 and all(r["a"] == 0 and r["b"] + 1 == r["d"] == r["n"] for r in found)
    mean = sum(r["s"] for r in found) / 3000
    assert len(found) > 2900 and max(r["s"] for r in found) <= mean + 2 * 36


def test_shards_of_odd_and_empty_tables(docs, no_docs):
    out = sharding.shard(docs).collect()
    assert len(out) == 14 and {r["size"] for r in out if r["doc_id"] in (4, 5)} == {1}
    assert sharding.shard(no_docs).count() == 0
    with pytest.raises(ValueError):
        sharding.shard(docs, carry=["doc_id", "size"])


def test_license_places(docs, no_docs, spark):
    said = [(20, "Released under the MIT License. mit-license, MIT\nlicense"), (21, "GNU General Public License gnu general license"),
            (22, "CC BY-NC 4.0"), (23, "Permission is hereby granted, free of any charge, to any person obtaining a copy of the software")]
    df = docs.select("doc_id", "text").unionByName(spark.createDataFrame(said, "doc_id long, text string"))
    found = {}
    for r in licenses.scan_licenses(df).collect():
        found[r["doc_id"]] = r
    assert licenses.scan_licenses(df).count() == 18
    for i, text in texts(df):
        words, places, labels = words_of(text), [], set()
        for phrase, label in licenses.PHRASES.items():
            for at in range(len(words)):
                if words[at:at + len(phrase.split())] == phrase.split():
                    places.append(at)
                    labels.add(label)
        r = found[i]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == (
            len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)))
    assert found[22]["labels"] == "cc-by,cc-by-nc" and found[23]["labels"] == "mit" and found[23]["n_base"] == 0
    assert licenses.scan_licenses(no_docs).count() == 0


def test_url_rules_and_model(spark):
    pages = [(1, "http://a.Example.org/es/1?x"), (2, "https://example.org/en/17"), (3, "https://example.org"), (4, "http://x.com/fr/#a"),
             (5, "http://x.com/de/2"), (6, None), (7, "no scheme"), (8, "http://cheap-pills.example.net/en/4"), (8, "http://cheap-pills.example.net/en/4"),
             (9, "http://thnews.example.net/en/4"), (10, "x://É.org?q=/es/"), (11, "http://badexample.org/es/")]
    out = {r["page_id"]: r for r in urls.judge(spark.createDataFrame(pages, "page_id long, url string")).collect()}
    assert [(out[i]["host"], out[i]["path"], out[i]["rule"], out[i]["verdict"]) for i in (1, 2, 4, 5)] == [
        ("a.example.org", "/es/1", "example.org/es/", "block"), ("example.org", "/en/17", "example.org/en/1", "block"),
        ("x.com", "/fr/", "com/fr/", "allow"), ("x.com", "/de/2", "com/de/", "block")]
    assert out[3]["rule"] is None and out[3]["path"] == "" and (out[6]["host"], out[7]["path"]) == ("", "")
    assert out[8]["verdict"] == "block" and out[9]["verdict"] == "allow" and out[11]["rule"] == "org/"
    assert out[10]["host"] == "É.org"
    assert urls.judge(spark.createDataFrame([], "page_id long, url string")).count() == 0


def test_url_scores_equal_a_plain_model(spark):
    import xxhash

    held = [*urls.labelled_urls(40, seed=5), ("http://adult-x.example.net/en/4", 1), ("https://free-bets.example.com/", 1), ("http://thonth.example.org/en/1", 0)]
    rows = [(i, u, y) for i, (u, y) in enumerate(held)]
    out = urls.judge(spark.createDataFrame(rows, "page_id long, url string, y int"), keep=("page_id", "y"), rules=()).collect()
    assert sum((r["verdict"] == "block") == bool(r["y"]) for r in out) >= 0.93 * len(out) and all((r["verdict"] == "block") == bool(r["y"]) for r in out if r["page_id"] >= len(held) - 3)
    weights, bias = urls.train(spark, urls.labelled_urls())
    for r in out:
        found = set()
        for field, value in (("h", f"^{r['host']}$"), ("p", r["path"])):
            for n in (3, 4):
                for i in range(len(value) - n + 1):
                    h = xxhash.xxh64_intdigest(value[i:i + n].encode(), xxhash.xxh64_intdigest(field.encode(), 42))
                    found.add((h - (1 << 64) if h >> 63 else h) % urls.BUCKETS)
        margin = bias + sum(weights[b] for b in found) / max(1, len(found)) ** 0.5
        assert abs(r["score"] - 1 / (1 + math.exp(-margin))) < 1e-6


def test_no_test_page_is_labelled():
    from urllib.parse import urlsplit

    import pyarrow.parquet as pq

    hosts = {urlsplit(u).netloc for u in pq.read_table(f"{SF}/pages.parquet")["url"].to_pylist()}
    assert not hosts & {urlsplit(u).netloc for u, _ in urls.labelled_urls()}


def test_clashing_names_are_refused(docs, spark):
    bench = spark.createDataFrame([(1, "one")], "item_id long, text string")
    vectors = spark.createDataFrame([(1, "a", [1.0])], "vec_id long, label string, embedding array<double>")
    pages = spark.createDataFrame([(1, "http://a.example/")], "page_id long, url string")
    both = lambda df, name: df.withColumn(name, F.lit(1))
    for name, run in (
            ("n_email", lambda k: pii.detect(both(docs, k), ["doc_id", k])), ("N_Shingles", lambda k: ngram_join.near_duplicates(both(docs, k), keep=[k])),
            ("n_hit", lambda k: decontaminate.scan(both(docs, k), bench, ["doc_id", k])), ("n_base", lambda k: licenses.scan_licenses(both(docs, k), ["doc_id", k])),
            ("host", lambda k: urls.judge(both(pages, k), keep=["page_id", k])), ("kept", lambda k: embeddings.link_vectors(both(vectors, k), keep=[k]))):
        for bad in (name, "_rid"):
            with pytest.raises(ValueError, match="clash"):
                run(bad)
    with pytest.raises(ValueError, match="clash"):
        licenses.scan_licenses(docs, ["doc_id", "doc_id"])


@pytest.mark.parametrize("words", [decontaminate.FILTER_WORDS, 8])
def test_many_windows_travel_without_texts(docs, spark, monkeypatch, words):
    monkeypatch.setattr(decontaminate, "FILTER_WORDS", words)
    rng = random.Random(words)
    said = [(i, " ".join(f"w{rng.randint(0, 996)}" for _ in range(rng.choice((2, 4, 9, 30))))) for i in range(400)]
    said += [(1000 + i, " ".join(f"w{(start + j) % 997}" for j in range(n))) for i, (start, n) in enumerate([(5, 12), (990, 40), (7, 3), (400, 10), (400, 10)])]
    bench = spark.createDataFrame(said, "item_id long, text string")
    want = Counter(map(tuple, decontaminate.scan(docs, bench).collect()))
    got = decontaminate.scan(docs, bench, small=0)
    assert Counter(map(tuple, got.collect())) == want and {r["doc_id"]: r["n_items"] for r in got.collect()}[10] >= 5


def test_decontamination_of_150_000_windows(spark):
    said = spark.range(3000).select("id", F.concat_ws(" ", F.transform(F.sequence(F.lit(0), F.lit(59)), lambda j: F.hex(F.xxhash64("id", j)))).alias("text"))
    middle = F.slice(F.split("text", " "), 21, 12)
    texts = said.select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.lit("before"), F.when(F.col("id") % 3 == 0, F.concat_ws(" ", middle)).otherwise("nothing"), F.lit("after")).alias("text"))
    found = decontaminate.scan(texts, said.withColumnRenamed("id", "item_id"))
    sums = found.agg(F.count("*"), F.sum("n_hit"), F.sum("n_items"), F.count_if((F.col("doc_id") % 3 == 0) == F.col("contaminated"))).first()
    assert tuple(sums) == (3000, 12 * 1000, 1000, 3000)


def test_decontamination_against_plain_search(docs, no_docs, spark):
    base = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
    items = [(1, "Beta-gamma delta epsilon zeta eta theta iota kappa lambda mu"), (2, "one"), (2, "one"), (None, "über alles"), (3, None), (4, "..."),
             (10, base), (5, "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w12")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.scan(docs, bench).collect()
    assert len(got) == 14
    want = Counter()
    for i, text in texts(docs):
        words, hit, named = words_of(text), set(), set()
        for item, said in items:
            own = words_of(said)
            for at in range(max(1, len(own) - 9) if own else 0):
                window = own[at:at + 10]
                for p in range(len(words) - len(window) + 1):
                    if words[p:p + len(window)] == window:
                        hit.update(range(p, p + len(window)))
                        named.add(str(item))
        named.discard("None")
        want[(i, len(words), len(hit), len(named), digest_of(",".join(sorted(named))), bool(hit))] += 1
    assert Counter(tuple(r) for r in got) == want
    assert decontaminate.scan(no_docs, bench).count() == 0
    assert not decontaminate.scan(docs, bench.limit(0)).where("contaminated").count()
    kept = decontaminate.remove_contaminated(docs, bench)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [4, 5, 8, 11, 12]


def luhn(digits):
    return sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(digits))) % 10 == 0


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def base_spans(text):
    out = []
    for kind, pattern in PATTERNS.items():
        # plain backtracking is quadratic on a long run that holds no address
        for m in re.finditer(pattern, text or "") if kind != "email" or "@" in (text or "") else ():
            n = len(re.sub("[^0-9]", "", m[0]))
            if (kind == "email" or kind == "ip" and all(int(p) <= 255 for p in m[0].split("."))
                    or kind == "card" and 13 <= n <= 19 and luhn(re.sub("[^0-9]", "", m[0])) or kind == "phone" and 9 <= n <= 15):
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


@pytest.fixture(scope="module")
def selector(spark):
    return pii.Selector(spark)


def test_base_spans_of_random_texts(spark, docs, selector):
    rng = random.Random(5)
    parts = [*"a1.@ +-()5%é漢_9 :=", "a@b.c", "1.2.3.4", "4111 1111 1111 1111", "+1 (803) 555-5351", "999"]
    rows = [(100 + i, "".join(rng.choices(parts, k=rng.randint(0, 30)))) for i in range(1500)]
    df = docs.select("doc_id", "text").where("doc_id is not null").unionByName(spark.createDataFrame(rows, "doc_id long, text string"))
    out = pii.detect(df, selector=selector).collect()
    kept = dict(texts(df))
    assert len(out) == 13 + len(rows)
    for r in out:
        spans = base_spans(kept[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(",".join(spans).encode()).hexdigest(), kept[r["doc_id"]]
        assert [r[f"n_{k}"] for k in PATTERNS] == [sum(s.startswith(k) for s in spans) for k in PATTERNS]
        assert set(spans) <= set(r["spans"].split(",")) | {""}


def test_added_spans_and_redaction(spark, docs, no_docs, selector):
    said = "ssn 078-05-1120, token = \"24be64439e3e49cf46b2d7c90f3602a3d0b907ff\" call (555) 123-4567 in 2024-05-12"
    df = spark.createDataFrame([(1, said, 7), (2, None, 7), (3, "nothing é", 7), (4, "a@b.c" * 3, 7)], "doc_id long, text string, spans int")
    found = {r["doc_id"]: r["spans"] for r in pii.detect(df, selector=selector).collect()}
    assert found == {1: "phone:73:87,id:4:15,secret:26:66", 2: "", 3: "", 4: found[4]}
    out = {r["doc_id"]: r for r in pii.redact(df, selector=selector).collect()}
    assert out[1]["text"] == 'ssn [ID], token = "[SECRET]" call [PHONE] in 2024-05-12' and out[1]["spans"] == 7
    assert out[2]["text"] is None and out[3]["text"] == "nothing é" and out[4]["text"] == "[EMAIL]@[EMAIL]"
    whole = pii.redact(docs, selector=selector)
    assert whole.columns == docs.columns and whole.count() == 14
    assert pii.detect(no_docs, selector=selector).count() == pii.redact(no_docs, selector=selector).count() == 0


def test_texts_of_many_numbers_take_linear_time(spark, selector):
    def seconds(n):
        said = " ".join(f"w{i}" for i in range(100, 100 + n)) + " +1 (803) 555-5351"
        df = spark.createDataFrame([(1, said)], "doc_id long, text string")
        start = time.perf_counter()
        row, text = pii.detect(df, selector=selector).first(), pii.redact(df, selector=selector).first()["text"]
        assert row["n_phone"] == 1 and text == said[:-17] + "[PHONE]"
        return time.perf_counter() - start
    seconds(2000)
    few, many = seconds(20_000), seconds(80_000)
    assert many < 2.5 * 4 * few and many < 60


def test_redaction_joins_all_blocks(spark, selector):
    rng = random.Random(8)
    rows = []
    for i in range(60):
        marks = [(" " + "x" * rng.randint(0, 2500) + " é漢\U0001f600 ", "a@b.c") for _ in range(rng.randint(1, 6))]
        tail = " " + "y" * rng.choice([0, 1, 1023, 1024, 1025, 3000])
        rows.append((i, "".join(a + b for a, b in marks) + tail, "".join(a + "[EMAIL]" for a, _ in marks) + tail))
    df = spark.createDataFrame(rows, "doc_id long, text string, want string")
    out = pii.redact(df, selector=selector).collect()
    assert len(out) == 60 and all(r["text"] == r["want"] for r in out)


def test_native_plans_run_no_python(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    for out in (licenses.scan_licenses(df), decontaminate.scan(df, spark.read.parquet(f"{SF}/benchmark.parquet")), pii.detect(df)):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan)


def test_hashes_do_not_depend_on_kept_names(docs):
    renamed = docs.withColumnRenamed("size", "n_words_before")
    assert licenses.scan_licenses(renamed, keep=["doc_id", "n_words_before"]).where(F.col("n_words_before").isNull()).count() == 1
