"""Personal data: generators propose spans, boosted trees select; built-in functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from ..session import local_table, materialize
from .boosting import boost, calibrated_threshold, margin
from .native import refuse_clashes

# Base kinds in their fixed order, then those that only the trees add.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "id", "secret")
_LOCAL, _DOMAIN = "A-Za-z0-9._%+-", "A-Za-z0-9-"
# Generators: kind, pattern, and a cheap necessary condition on the text. A start that
# follows a character of its own run can only match after an earlier match (\G), so every
# pattern is linear in the text; possessive loops never give back.
BASE_PATTERNS = {
    "email": (rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[{_DOMAIN}]++(?:\.[{_DOMAIN}]++)++", "@"),
    "ip": (r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}", "[0-9]"),
    "card": (r"(?:\G|(?<![0-9]))[0-9](?:[\x20-]?+[0-9])++", "[0-9]"),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", r"\+"),
}
CANDIDATE_PATTERNS = {
    "email": (rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++\x20?(?:\(at\)|\[at\]|\x20at\x20)\x20?[{_DOMAIN}]++"
              rf"(?:\x20?(?:\(dot\)|\[dot\]|\x20dot\x20|\.)\x20?[{_DOMAIN}]++)++", r"[(\[\x20]at[)\]\x20]"),
    "phone": (r"(?<![0-9A-Za-z.+-])\(?[0-9]{2,4}+\)?[\x20./-]{1,2}[0-9]{2,4}+(?:[\x20./-][0-9]{2,5}+){1,3}(?![0-9A-Za-z-])", "[0-9]"),
    "id": (r"(?<![0-9A-Za-z-])(?:[0-9]{3}-[0-9]{2}-[0-9]{4}|[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?)(?![0-9A-Za-z-])", "[0-9]"),
    "secret": (r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*+[0-9])[A-Za-z0-9+/_=-]{16,}+", "[0-9]"),
}
BEFORE, AFTER = 32, 8
# Code points of a block of text, from which spans are cut.
BLOCK = 1024
# Context words that features look for just before a span.
CONTEXT = {
    "phone": r"(?i)(?:phone|tel|call|fax|mobile|cell|dial|whatsapp)[^\n]{0,12}$",
    "id": r"(?i)(?:ssn|social security|iban|account|passport|tax id|id number)[^\n]{0,12}$",
    "secret": r"(?i)(?:token|secret|api.?key|password|passwd|bearer|access.?key|auth)[^\n]{0,8}$",
    "email": r"(?i)(?:mail|contact|write to|reach)[^\n]{0,12}$",
}
# Labelled spans: kind, text before, span, text after, 1 if personal.
LABELLED_SPANS = (
    ("email", "mail me: ", "jane.doe (at) example (dot) org", " thanks", 1), ("email", "contact ", "bob [at] mail.example.com", ".", 1),
    ("email", "write to ", "ann at example dot net", " or", 1), ("email", "reach ", "k.lee (at) corp.example", "\n", 1),
    ("email", "my e-mail is ", "tom.b [at] site [dot] org", "", 1), ("email", "", "info (at) shop.example", " ", 1),
    ("email", "we met ", "people at noon. Then", " we", 0), ("email", "look ", "up at it.We", " go", 0),
    ("email", "the sun ", "rose at dawn. It", " was", 0), ("email", "he stood ", "there at home. She", " left", 0),
    ("email", "she is ", "good at chess. He", "", 0), ("email", "arrive ", "early at work. Never", " ", 0),
    ("phone", "call ", "(555) 123-4567", " now", 1), ("phone", "Tel. ", "030 901 82 11", ",", 1),
    ("phone", "phone: ", "555-123-4567", "", 1), ("phone", "fax ", "020 7946 0958", ".", 1),
    ("phone", "mobile ", "06 12 34 56 78", " ", 1), ("phone", "whatsapp ", "555.867.5309", "\n", 1),
    ("phone", "dial ", "(212) 555-0187", "", 1), ("phone", "my number is ", "(303) 555-0100", "", 1),
    ("phone", "on ", "12/05/2024/18", " it", 0), ("phone", "dated ", "2024-05-12", " and", 0),
    ("phone", "version ", "10.12.14", " of", 0), ("phone", "from ", "1998-11-03", "", 0),
    ("phone", "scores ", "12 14 16 18", " were", 0), ("phone", "in ", "1990/91/92", " and", 0),
    ("phone", "rows ", "100 200 300", " of", 0), ("phone", "pages ", "12-14-16", "", 0),
    ("phone", "series ", "11 22 33 44", " ", 0), ("phone", "lot ", "2020 2021 2022", "", 0),
    ("id", "SSN ", "123-45-6789", ".", 1), ("id", "social security ", "078-05-1120", " is", 1),
    ("id", "IBAN ", "DE89 3704 0044 0532 0130 00", "", 1), ("id", "account ", "GB29NWBK60161331926819", ",", 1),
    ("id", "iban: ", "FR1420041010050500013M02606", "", 1), ("id", "my ", "219-09-9999", " number", 1),
    ("id", "pay to ", "ES91 2100 0418 4502 0005 1332", "", 1), ("id", "", "NL91ABNA0417164300", " ", 1),
    ("id", "model ", "XR20 AAAA BBBB CCCC", " unit", 0), ("id", "part ", "AB12CDEFGHIJKLMN", "", 0),
    ("id", "code ", "QQ11WWWWEEEERRRR", " x", 0), ("id", "PLATE ", "ZZ99 TEST TEST TEST", "", 0),
    ("secret", 'token = "', "24be64439e3e49cf46b2d7c90f3602a3d0b907ff", '"', 1),
    ("secret", "api_key=", "AKz91LmPq8sT2vXy7Bn4", "\n", 1), ("secret", "password: ", "hunter2Hunter2hunter2", "", 1),
    ("secret", "Bearer ", "eyJhbGciOiJIUzI1NiIsInR5cCI6IkpXVCJ9", ".", 1), ("secret", "secret ", "9f86d081884c7d659a2feaa0c55ad015", " ", 1),
    ("secret", "commit ", "ghp1aB2cD3eF4gH5iJ6kL7mN8oP9qR0", " ", 1), ("secret", "", "a4a14da4dc9b206c0209041b0961df015c66b4f9", " | the", 1),
    ("secret", "access key ", "wJalrXUtnFEMI7K7MDENG", "", 1), ("secret", "token ", "0123456789abcdef0123456789abcdef", "", 1),
    ("secret", "the ", "internationalization2", " of", 0), ("secret", "see ", "chapter-12-introduction", ".", 0),
    ("secret", "in ", "2024-05-12-release-notes", "", 0), ("secret", "file ", "report_final_version_3", " is", 0),
    ("secret", "number ", "4785380592391135", " and", 0), ("secret", "at ", "section-4-paragraph-2", "", 0),
    ("secret", "about ", "covid-19-vaccinations", " and", 0), ("secret", "/", "articles/2024/physics/news", "", 0),
    ("secret", "", "aaaaaaaaaaaaaaaaaaaa1", "", 0), ("secret", "----", "================1", "", 0),
    ("secret", "sum ", "12345678901234567890", " of", 0), ("secret", "the ", "thinblerethationing7", " x", 0),
)
LABELLED_SCHEMA = T.StructType([*[T.StructField(c, T.StringType()) for c in ("kind", "before", "m", "after")], T.StructField("label", T.IntegerType())])
PRECISION = 0.95


def proposals(text: Column) -> Column:
    """All spans that the generators find, as an array of structs.

    Fields: ``g`` (generator number), ``i`` (its match number), ``kind``,
    ``base``, ``gap`` (code points since the generator's last match), ``m``
    (the span), ``before`` and ``after`` (short context).
    """
    lists = []
    generators = [(k, p, c, True) for k, (p, c) in BASE_PATTERNS.items()] + [(k, p, c, False) for k, (p, c) in CANDIDATE_PATTERNS.items()]
    for g, (kind, pattern, needed, base) in enumerate(generators):
        # bound as one element of an array, matches and pieces are made once per text
        cut = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"), F.split(text, pattern, -1).alias("pieces"))
        made = F.element_at(F.transform(F.array(cut), _proposals(g, kind, base)), 1)
        lists.append(F.when(text.rlike(needed), made))
    empty = F.array().cast("array<struct<g:int,i:int,kind:string,base:boolean,gap:int,m:string,before:string,after:string>>")
    return F.concat(*[F.coalesce(x, empty) for x in lists])


def _proposals(g: int, kind: str, base: bool):
    def make(match, i):
        size = F.length(match["last"])
        return F.struct(
            F.lit(g).alias("g"), i.alias("i"), F.lit(kind).alias("kind"), F.lit(base).alias("base"), size.alias("gap"), match["m"].alias("m"),
            F.substring(match["last"], F.greatest(size - (BEFORE - 1), F.lit(1)), F.lit(BEFORE)).alias("before"),
            F.substring(match["next"], F.lit(1), F.lit(AFTER)).alias("after"))

    def each(cut):
        # matches beside the pieces before and after them
        pieces = cut["pieces"]
        beside = F.arrays_zip(cut["found"].alias("m"), pieces.alias("last"), F.slice(pieces, 2, F.size(pieces)).alias("next"))
        return F.transform(F.filter(beside, lambda z: z["m"].isNotNull()), make)
    return each


def _digits(span: Column) -> Column:
    return F.regexp_replace(span, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    size = F.length(digits)

    def add(total, i):
        d = F.substring(digits, size - i, F.lit(1)).cast("int")
        return total + F.when(i % 2 == 1, F.when(d > 4, 2 * d - 9).otherwise(2 * d)).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), size - 1), F.lit(0), add) % 10 == 0


def base_valid(kind: Column, span: Column) -> Column:
    """The checks of the base kinds on a whole match."""
    digits = F.length(_digits(span))
    parts = F.transform(F.split(span, r"\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", ""))
    small = F.forall(parts, lambda p: (F.length(p) <= 3) & (F.substring(p, 1, 3).cast("int") <= 255))
    return (F.when(kind == "email", True).when(kind == "ip", small)
            .when(kind == "card", digits.between(13, 19) & luhn(F.substring(_digits(span), 1, 19)))
            .otherwise(digits.between(9, 15)))


def features(kind: Column, span: Column, before: Column, after: Column) -> list[Column]:
    """Format and context of a span as numbers."""
    def count(pattern):
        return F.length(F.regexp_replace(span, pattern, "")).cast("double")

    flag = lambda c: c.cast("double")
    letters, digits, upper = count("[^A-Za-z]"), count("[^0-9]"), count("[^A-Z]")
    changes = F.length(F.regexp_replace(F.regexp_replace(F.regexp_replace(span, "[A-Za-z]+", "a"), "[0-9]+", "0"), "[^a0]", "")).cast("double")
    distinct = F.size(F.array_distinct(F.split(F.substring(span, 1, 200), ""))).cast("double")
    return [
        *[flag(kind == k) for k in ("email", "phone", "id", "secret")],
        F.length(span).cast("double"), letters, digits, upper, count(r"[^\x20().\[\]/_=+-]"), changes, distinct,
        flag(span.rlike("^[0-9a-f]{32,}$")), flag(span.rlike(r"^\(?[0-9]{3}\)?[\x20.-]{1,2}[0-9]{3}[\x20.-][0-9]{4}$")),
        flag(span.rlike(r"^(?:19|20)[0-9]{2}[./-]")), flag(span.rlike(r"[(\[](?:at|dot)[)\]]|\x20dot\x20")),
        *[flag(before.rlike(p)) for p in CONTEXT.values()], flag(after.rlike("^[\"']")),
    ]


class Selector:
    """Boosted trees over span features with a calibrated threshold."""

    def __init__(self, spark: SparkSession, labelled: Sequence[tuple] = LABELLED_SPANS, precision: float = PRECISION):
        table = local_table(spark, list(labelled), LABELLED_SCHEMA)
        named = [F.col(c) for c in ("kind", "m", "before", "after")]
        rows = table.select(F.array(*features(*named)).alias("x"), "label").collect()  # the labelled table is small
        x, y = [list(r["x"]) for r in rows], [r["label"] for r in rows]
        self.trees, self.threshold = boost(x, y), calibrated_threshold(x, y, precision)

    def score(self, kind: Column, span: Column, before: Column, after: Column) -> Column:
        made = features(kind, span, before, after)
        # one pass over a one-element array names the features, so trees refer to them by position
        totals = F.transform(F.array(F.array(*made)), lambda x: margin(self.trees, [F.get(x, F.lit(i)) for i in range(len(made))]))
        total = F.element_at(totals, 1)
        return 1 / (1 + F.exp(-total))


def _spans(rows: DataFrame, selector: Selector) -> DataFrame:
    """(_rid, kind, base, start, end) of accepted spans from rows of (_rid, _c: one proposal or NULL)."""
    flat = rows.select("_rid", "_c.*").where("g is not null").repartition("_rid")
    so_far = Window.partitionBy("_rid", "g").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.length("m")).over(so_far)
    placed = flat.withColumn("end", end).withColumn("start", F.col("end") - F.length("m"))
    base = F.coalesce(F.when(F.col("base"), base_valid(F.col("kind"), F.col("m"))), F.lit(False))
    added = F.when(~F.col("base"), selector.score(*[F.col(c) for c in ("kind", "m", "before", "after")]) >= selector.threshold)
    accepted = placed.withColumn("_base", base).withColumn("_added", F.coalesce(added, F.lit(False))).where("_base or _added")
    # an added span that overlaps a base one adds nothing
    order = Window.partitionBy("_rid").orderBy("start", "end")
    last_base = F.max(F.when(F.col("_base"), F.col("end"))).over(order.rowsBetween(Window.unboundedPreceding, -1))
    next_base = F.min(F.when(F.col("_base"), F.col("start"))).over(order.rowsBetween(1, Window.unboundedFollowing))
    apart = F.coalesce(last_base <= F.col("start"), F.lit(True)) & F.coalesce(next_base >= F.col("end"), F.lit(True))
    return accepted.withColumn("_apart", apart).where("_base or _apart").select("_rid", "kind", F.col("_base").alias("base"), "start", "end").distinct()


def detect(docs: DataFrame, keep: Sequence[str] = ("doc_id",), text: str = "text", selector: Selector | None = None) -> DataFrame:
    """Counts, digest and list of personal spans of every whole text.

    Base spans follow the fixed patterns and checks and always stay. Further
    candidates (spelled-out addresses, numbers without a plus, account and
    security numbers, secrets) are scored by boosted trees on format and
    context and kept from a calibrated threshold on, unless they overlap a base
    span. Returns ``keep`` plus ``n_email``, ``n_ip``, ``n_card``, ``n_phone``
    (base spans), ``base_sha256`` and ``spans`` (``kind:start:end`` in code
    points, by kind, then start). NULL and empty texts have none; repeated rows
    give repeated results. Names that start with ``_`` or are a result's are
    refused in ``keep``.
    """
    refuse_clashes(keep, (*[f"n_{k}" for k in BASE_KINDS], "base_sha256", "spans"))
    selector = selector or Selector(docs.sparkSession)
    found = docs.select(*keep, F.monotonically_increasing_id().alias("_rid"), proposals(F.coalesce(F.col(text), F.lit(""))).alias("_p"))
    rows = materialize(found.select(*keep, "_rid", F.posexplode_outer("_p").alias("_at", "_c")), "proposals")
    rank = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    item = F.struct(rank.alias("r"), "start", "end", F.concat_ws(":", "kind", "start", "end").alias("s"))
    per_doc = _spans(rows, selector).groupBy("_rid").agg(
        *[F.count(F.when(F.col("base") & (F.col("kind") == k), 1)).alias(f"n_{k}") for k in BASE_KINDS],
        F.array_sort(F.collect_list(F.when(F.col("base"), item))).alias("_base"), F.array_sort(F.collect_list(item)).alias("_all"))
    owners = rows.where("_at = 0 or _at is null").select(*keep, "_rid")
    joined = owners.join(per_doc, "_rid", "left")
    text_of = lambda c: F.coalesce(F.concat_ws(",", F.transform(c, lambda x: x["s"])), F.lit(""))
    return joined.select(
        *keep, *[F.coalesce(f"n_{k}", F.lit(0).cast("long")).alias(f"n_{k}") for k in BASE_KINDS],
        F.sha2(text_of("_base"), 256).alias("base_sha256"), text_of("_all").alias("spans"))


def _blocks(text: Column) -> Column:
    """The text in blocks of ``BLOCK`` code points, in one pass."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))


def _between(blocks: Column, start: Column, end: Column) -> Column:
    """Code points ``start`` to ``end`` of a text in blocks, touching only the blocks that hold them."""
    first, last = F.floor(start / BLOCK).cast("int"), F.floor(F.greatest(end - 1, start) / BLOCK).cast("int")
    return F.substring(F.array_join(F.slice(blocks, first + 1, last - first + 1), ""), (start - first * BLOCK + 1).cast("int"), (end - start).cast("int"))


def _rebuild(bound: Column) -> Column:
    """The text with every span replaced by its mark; work is linear in text and spans."""
    spans, blocks = bound["spans"], bound["blocks"]
    size = F.when(F.size(blocks) > 0, (F.size(blocks) - 1) * BLOCK + F.length(F.element_at(blocks, -1))).otherwise(0)
    none = F.struct(*[F.lit(None).cast("long").alias(n) for n in ("start", "end")], F.lit(None).cast("string").alias("kind"))
    beside = F.arrays_zip(spans.alias("span"), F.concat(F.array(none), spans).alias("last"))
    parts = F.transform(F.filter(beside, lambda z: z["span"].isNotNull()), lambda z: F.concat(
        _between(blocks, F.coalesce(z["last"]["end"], F.lit(0).cast("long")), z["span"]["start"]), F.lit("["), z["span"]["kind"], F.lit("]")))
    return F.concat(F.array_join(parts, ""), _between(blocks, F.element_at(spans, -1)["end"], size))


def redact(docs: DataFrame, text: str = "text", selector: Selector | None = None) -> DataFrame:
    """The same rows and columns, every span in ``text`` replaced by ``[KIND]``.

    Overlapping spans become one mark, of the kind that starts first. Texts
    without proposals pass untouched and unshuffled; NULL stays NULL. A name
    starting with ``_`` must not be among the columns.
    """
    selector = selector or Selector(docs.sparkSession)
    found = docs.withColumn("_p", proposals(F.coalesce(F.col(text), F.lit(""))))
    plain = found.where(F.size("_p") == 0).drop("_p")
    held = materialize(found.where(F.size("_p") > 0).withColumn("_rid", F.monotonically_increasing_id()), "held")
    spans = _spans(held.select("_rid", F.explode("_p").alias("_c")), selector)
    order = Window.partitionBy("_rid").orderBy("start", "end", "kind")
    before = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    run = F.sum(F.when(F.col("start") >= before, 1).otherwise(0)).over(order.rowsBetween(Window.unboundedPreceding, 0))
    merged = spans.withColumn("_before", before).withColumn("_run", run).groupBy("_rid", "_run").agg(
        F.min(F.struct("start", "end", "kind")).alias("_s"), F.max("end").alias("_e"))
    lists = merged.groupBy("_rid").agg(F.array_sort(F.collect_list(F.struct(
        F.col("_s.start").alias("start"), F.col("_e").alias("end"), F.upper("_s.kind").alias("kind")))).alias("_list"))
    value = F.col(text)
    # bound as one element of an array, the blocks of a text are cut once and not per span
    rebuilt = F.element_at(F.transform(F.array(F.struct(F.col("_list").alias("spans"), _blocks(value).alias("blocks"))), _rebuild), 1)
    changed = held.drop("_p").join(lists, "_rid", "left").withColumn(text, F.when(F.col("_list").isNotNull(), rebuilt).otherwise(value))
    return plain.unionByName(changed.select(*docs.columns))
