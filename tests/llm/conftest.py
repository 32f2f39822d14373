import hashlib
import re

import pytest

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SF = "/root/testdata/sf0.001"


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def digest_of(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="session")
def docs(spark):
    """Documents with NULLs, empty and long texts, ties, repeated rows and further columns."""
    base = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau"
    rows = [
        (1, base, "x", 1), (2, base, "y", 2), (2, base, "y", 2), (3, base + " upsilon", None, None), (4, None, "z", 0),
        (5, "", "", 0), (None, base, "q", 5), (6, "one", "a", 1), (7, "One", "a", 1), (8, "!!! ???", "a", 1),
        (9, "Wörter Ärger über alles und noch viel mehr deutsche Sätze", "b", 2),
        (10, " ".join(f"w{i % 997}" for i in range(60_000)), "long", 3), (11, "a" * 300_000, "long", 4),
        (12, "Mail jane@x.example.com or 4111 1111 1111 1111, +1 (803) 555-5351, 10.0.0.255. MIT License", "p", 1),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, score string, size long").repartition(3)


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.limit(0)
