"""URL filter: rules by host and path, then logistic regression on hashed n-grams."""

from __future__ import annotations

import math
import random
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .native import UPPER, refuse_clashes

# Fixed values: (verdict, host, path prefix). A rule fits its host and all subdomains.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
# Words that the labelled URLs are made of: those of hosts and paths to be blocked, harmless ones, and paths of any host.
BLOCKED_WORDS = (
    "adult", "bets", "betting", "bitcoin-doubler", "bonus", "cams", "cash", "casino", "cheap", "clickbait", "coupon", "crack", "dating",
    "escort", "fake", "free", "gambling", "hacked", "hot", "jackpot", "keygen", "link-farm", "loan", "lottery", "malware", "meds",
    "nude", "payday", "phishing", "pills", "poker", "porn", "prize", "replica", "seo", "sexy", "singles", "slots", "spam",
    "torrent", "viagra", "warez", "win", "xxx",
)
HARMLESS_WORDS = (
    "archive", "art", "bakery", "biology", "book", "bridge", "chess", "city", "climate", "code", "council", "cycling", "data", "docs",
    "energy", "farm", "forum", "garden", "history", "hospital", "house", "journal", "kitchen", "language", "law", "library", "local",
    "maps", "math", "museum", "music", "news", "ocean", "open", "orchestra", "physics", "poetry", "press", "radio", "recipes", "river",
    "school", "science", "sport", "studio", "theatre", "travel", "university", "weather", "wiki",
)
ONSETS = ("", "b", "br", "c", "ch", "d", "f", "g", "h", "j", "k", "l", "m", "n", "p", "pr", "r", "s", "sh", "st", "t", "th", "tr", "v", "w")
VOWELS, CODAS = ("a", "e", "i", "o", "u", "io"), ("", "", "d", "l", "m", "n", "ng", "nd", "nt", "r", "s", "st", "t", "th")
PREFIXES, ENDINGS = ("", "www.", "m.", "blog."), (".example", ".example.net", ".example.com", ".example.org")
ANY_PATHS = ("", "/", "/en/{}", "/de/{}.html", "/fr/{}/", "/es/{}", "/about", "/2024/{}/report", "/item?id={}", "/page/{}#top")
BLOCKED_PATHS = ("/win/{}", "/claim-prize", "/porn/{}", "/free-casino/{}", "/keygen.exe", "/xxx/{}")
HOSTS_PER_KIND = 1200


def labelled_urls(hosts: int = HOSTS_PER_KIND, seed: int = 9) -> list[tuple[str, int]]:
    """(url, label) rows drawn by rule from the words above; 1 is to be blocked.

    Blocked: hosts with a blocked word, beside another, a harmless word or a
    syllable, and harmless hosts with a blocked path. Harmless: hosts of
    harmless words, and of syllables that mean nothing.
    """
    rng = random.Random(seed)

    def url(host: str, paths: Sequence[str]) -> str:
        return f"{rng.choice(('http', 'https'))}://{rng.choice(PREFIXES)}{host}{rng.choice(ENDINGS)}{rng.choice(paths).format(rng.randint(1, 999))}"

    def syllable() -> str:
        return rng.choice(ONSETS) + rng.choice(VOWELS) + rng.choice(CODAS)

    def nonsense() -> str:
        return "".join(syllable() for _ in range(rng.randint(2, 4)))

    def harmless() -> str:
        return rng.choice(("", "-")).join(rng.sample(HARMLESS_WORDS, rng.randint(1, 2))) if rng.random() < 0.6 else nonsense()

    rows = []
    for i in range(hosts):
        # every word in turn
        word = BLOCKED_WORDS[i % len(BLOCKED_WORDS)]
        other = rng.choice((rng.choice(BLOCKED_WORDS), rng.choice(HARMLESS_WORDS), syllable(), rng.choice("abcxyz")))
        pair = [word, other] if rng.random() < 0.6 else [other, word]
        rows.append((url("-".join(pair) if rng.random() < 0.7 else "".join(pair), ANY_PATHS), 1))
        rows.append((url(harmless(), ANY_PATHS), 0))
        rows.append((url(HARMLESS_WORDS[i % len(HARMLESS_WORDS)] if i % 2 else nonsense(), ANY_PATHS), 0))
        if i % 4 == 0:
            rows.append((url(harmless(), BLOCKED_PATHS), 1))
    return rows


BUCKETS = 4096
ROUNDS, RATE, DECAY = 400, 8.0, 1e-4
GRAM_SIZES = (3, 4)
THRESHOLD = 0.5


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.translate(F.regexp_extract(_after(url), r"^[^/?#]*", 0), UPPER, UPPER.lower())


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after(url), r"^[^/?#]*([^?#]*)", 1)


def _after(url: Column) -> Column:
    start = F.instr(url, "://")
    return F.when(start > 0, F.substring(url, start + 3, F.length(url))).otherwise("")


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule as ``host/path``, its verdict) of the longest fitting rule, else NULLs."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    # the longest is tested last and so stands outermost
    for said, rule_host, prefix in sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), r)):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(prefix)
        rule, verdict = F.when(fits, rule_host + prefix).otherwise(rule), F.when(fits, said).otherwise(verdict)
    return rule, verdict


def gram_buckets(host: Column, path: Column, sizes: Sequence[int] = GRAM_SIZES, buckets: int = BUCKETS) -> Column:
    """Distinct buckets of the hashed character n-grams of host and path."""
    parts = []
    for field, value in (("h", F.concat(F.lit("^"), host, F.lit("$"))), ("p", path)):
        for n in sizes:
            count = F.length(value) - (n - 1)
            starts = F.when(count > 0, F.sequence(F.lit(1), count)).otherwise(F.array().cast("array<int>"))
            parts.append(F.transform(starts, _bucket(field, value, n, buckets)))
    return F.array_distinct(F.concat(*parts))


def _bucket(field: str, value: Column, size: int, buckets: int):
    return lambda start: F.pmod(F.xxhash64(F.lit(field), F.substring(value, start, F.lit(size))), F.lit(buckets)).cast("int")


def train(spark: SparkSession, labelled: Sequence[tuple[str, int]], buckets: int = BUCKETS,
          rounds: int = ROUNDS, rate: float = RATE, decay: float = DECAY) -> tuple[list[float], float]:
    """Weights per bucket and intercept, by gradient descent over the labelled table.

    The table is small by definition; its buckets come from the same
    expressions that score pages. Both labels weigh the same.
    """
    url = F.col("url")
    rows = spark.createDataFrame(list(labelled), "url string, label int").select(
        gram_buckets(host_of(url), path_of(url), buckets=buckets).alias("b"), "label").collect()
    grams = np.zeros((len(rows), buckets))
    for i, (found, _) in enumerate(rows):
        grams[i, found] = 1 / math.sqrt(max(1, len(found)))
    label = np.array([y for _, y in rows], np.float64)
    share = np.where(label == 1, 0.5 / max(1.0, label.sum()), 0.5 / max(1.0, (1 - label).sum()))
    weights, bias = np.zeros(buckets), 0.0
    for _ in range(rounds):
        miss = (label - 1 / (1 + np.exp(-(grams @ weights + bias)))) * share
        weights += rate * (grams.T @ miss - decay * weights)
        bias += rate * miss.sum()
    return weights.tolist(), float(bias)


def judge(pages: DataFrame, url: str = "url", keep: Sequence[str] = ("page_id",), rules=RULES,
          labelled: Sequence[tuple[str, int]] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """Host, path, fitting rule and verdict of every page.

    The longest rule that fits decides; without one, the model blocks at a
    probability of ``threshold``. A NULL url, or one without ``://``, has empty
    host and path and gets the model's verdict on those. Returns ``keep`` plus
    ``host``, ``path``, ``rule``, ``verdict`` and ``score`` (the model's). Of rules
    of one length that of the later host decides. Repeated rows give repeated results,
    an empty table none; names that start with ``_`` or are a result's are refused.
    """
    refuse_clashes(keep, ("host", "path", "rule", "verdict", "score"))
    weights, bias = train(pages.sparkSession, labelled_urls() if labelled is None else labelled)
    table = F.lit(weights)
    rows = pages.select(*keep, host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    rows = rows.withColumns({c: F.coalesce(c, F.lit("")) for c in ("host", "path")})
    rows = rows.withColumn("_b", gram_buckets(F.col("host"), F.col("path")))
    margin = F.aggregate("_b", F.lit(0.0), lambda s, b: s + F.get(table, b)) / F.sqrt(F.greatest(F.size("_b"), F.lit(1)))
    score = F.round(1 / (1 + F.exp(-(margin + F.lit(bias)))), 9)
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    return rows.select(*keep, "host", "path", rule.alias("rule"), score.alias("score"), verdict.alias("_verdict")).select(
        *keep, "host", "path", "rule",
        F.coalesce("_verdict", F.when(F.col("score") >= threshold, "block").otherwise("allow")).alias("verdict"), "score")
