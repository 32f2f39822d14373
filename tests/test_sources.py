import os

import pytest
from pyspark.sql import functions as F

from lotledger.sources import fingerprint, links, raw, records, registry, sinks


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")


def test_monthly_parts(spark, tmp_path):
    cells = [str(i) for i in range(28)]
    write(tmp_path / "itbi_2024.xlsx" / "JAN-2024.csv", ";".join(cells) + "\n" + ";" * 27 + "\n")
    write(tmp_path / "itbi_2024.xlsx" / "Resumo.csv", "a;b\n")
    write(tmp_path / "itbi_2025.xlsx" / "fev-2025.csv", ";".join(cells + ["x"]) + "\n")
    rows = {r.aba: r for r in raw.read_monthly_parts(spark, str(tmp_path)).collect()}
    assert set(rows) == {"JAN-2024", "fev-2025"}
    assert rows["JAN-2024"].arquivo == "itbi_2024.xlsx" and rows["JAN-2024"].n_do_cadastro == "0"
    assert rows["fev-2025"].coluna_extra_28 == "x" and rows["JAN-2024"].coluna_extra_28 is None
    write(tmp_path / "itbi_2025.xlsx" / "MAR-2025.csv", "a;b;c\n")
    with pytest.raises(ValueError, match="unexpected number"):
        raw.read_monthly_parts(spark, str(tmp_path))


def test_name_part_rejects_narrow(spark):
    with pytest.raises(ValueError):
        raw.name_part(spark.range(1), F.lit("f"), F.lit("s"))


def test_empty_scan_fails(spark, tmp_path):
    write(tmp_path / "a.csv", "x;y\n")
    with pytest.raises(ValueError):
        raw.read_delimited(spark, str(tmp_path), ["x", "y"])


def test_text_documents_and_signature(spark, tmp_path):
    write(tmp_path / "a.md", "um\ndois")
    write(tmp_path / "sub" / "b.txt", "tres")
    write(tmp_path / "c.pdf", "nao")
    docs = {os.path.basename(r.source): r.content for r in raw.read_text_documents(spark, str(tmp_path)).collect()}
    assert docs == {"a.md": "um\ndois", "b.txt": "tres"}
    before = fingerprint.corpus_signature(spark, str(tmp_path)).first()
    assert before["files"] == 2 and before == fingerprint.corpus_signature(spark, str(tmp_path)).first()
    write(tmp_path / "sub" / "b.txt", "tres mudou")
    assert fingerprint.corpus_signature(spark, str(tmp_path)).first()["signature"] != before["signature"]
    assert fingerprint.corpus_signature(spark, str(tmp_path), "*.zip").first()["signature"] == "missing"


def test_fingerprint_ignores_order_not_nulls(spark):
    a = spark.createDataFrame([("a", None), ("b", "c")], "x string, y string")
    b = spark.createDataFrame([("b", "c"), ("a", None)], "x string, y string")
    c = spark.createDataFrame([("b", "c"), (None, "a")], "x string, y string")
    digest = [fingerprint.table_fingerprint(d, stem="t").first() for d in (a, b, c)]
    assert digest[0] == digest[1] != digest[2] and digest[0]["version"].startswith("t_")


def test_year_links(spark):
    html = ('<div><p><strong>Dados de 2024</strong></p><ul><li><a href="/x/itbi_a.xlsx">baixar</a></li>'
            '<li><a href="b/ITBI-2023.XLSX">2023</a></li><li><a href="/x/itbi_c.xlsx">novo 2024</a></li><li><a href="/doc.pdf">2024</a></li></ul></div>')
    pages = spark.createDataFrame([(1, "https://site.test/a/b?x=1", html)], "page_id int, url string, html string")
    # the last strong says 2024, so it decides for every link that follows
    assert {(r.year, r.link) for r in links.year_links(pages).collect()} == {(2024, "https://site.test/x/itbi_c.xlsx")}
    plain = pages.withColumn("html", F.regexp_replace("html", "<strong>.*</strong>", ""))
    assert {(r.year, r.link) for r in links.year_links(plain).collect()} == {
        (2024, "https://site.test/x/itbi_c.xlsx"), (2023, "https://site.test/a/b/ITBI-2023.XLSX")}


def test_golden_set(spark, tmp_path):
    write(tmp_path / "g.jsonl", '{"id":"q02","question":"b"}\n\n{"id":"q01","question":"a"}\n')
    assert [r.id for r in raw.read_golden_set(spark, str(tmp_path), 1).collect()] == ["q01"]
    assert raw.read_golden_set(spark, str(tmp_path), 0).count() == 2


def test_run_export(spark, tmp_path):
    runs = spark.createDataFrame([("a", ["x", "y"], True)], "config_name string, tools_used array<string>, success boolean")
    sinks.write_runs(runs, str(tmp_path / "j"), str(tmp_path / "c"), ["config_name", "tools_used", "success"])
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).first()["tools_used"] == "x|y"
    assert spark.read.json(str(tmp_path / "j")).first()["tools_used"] == ["x", "y"]


def test_resolve_model(spark):
    rows = [("dev", "m/dev/model_2026.05.03.1334"), ("dev", "m/dev/model_2026.05.02.1934"), ("test", "m/test/model_2027.01.01.0000")]
    reg = spark.createDataFrame(rows, "env string, path string")
    assert registry.resolve_model(reg).first()["version"] == "2026.05.03.1334"
    assert registry.resolve_model(reg, version="2026.05.02.1934").first()["path"].endswith("1934")


def test_sample_is_exact_and_repeatable(spark):
    df = spark.range(1000).withColumn("x", F.col("id") * 2)
    one = raw.sample_rows(df, ["x"], ["id"], 50).collect()
    assert len(one) == 50 and sorted(one) == sorted(raw.sample_rows(df.repartition(7), ["x"], ["id"], 50).collect())


def test_monthly_parts_of_any_width(spark, tmp_path):
    cells = [str(i) for i in range(40)]
    cells[3] = '"a;b"'
    write(tmp_path / "f.xlsx" / "JAN-2024.csv", ";".join(cells) + "\n")
    row = raw.read_monthly_parts(spark, str(tmp_path)).first()
    assert row["coluna_extra_39"] == "39" and row["complemento"] == "a;b"
    write(tmp_path / "f.xlsx" / "FEV-2024.csv", "")
    with pytest.raises(ValueError, match="empty"):
        raw.read_monthly_parts(spark, str(tmp_path))


def test_line_breaks_and_quotes_survive_a_round_trip(spark, tmp_path):
    rows = [(str(i), s) for i, s in enumerate(["a\nb", 'he said "x"; y', " spaces ", "c"])]
    sinks.write_delimited(spark.createDataFrame(rows, "id string, text string"), str(tmp_path / "t"))
    assert sorted(tuple(r) for r in raw.read_delimited(spark, str(tmp_path / "t"), ["id", "text"]).collect()) == rows


@pytest.mark.parametrize("line", ['{"id":"q03","question"', '{"question":"no id"}'])
def test_malformed_golden_lines_fail(spark, tmp_path, line):
    write(tmp_path / "g.jsonl", '{"id":"q02","question":"b"}\n' + line + "\n")
    with pytest.raises(Exception):
        raw.read_golden_set(spark, str(tmp_path), 0).collect()


def test_links_are_read_as_a_parser_would(spark):
    from html.parser import HTMLParser

    html = """<p><strong>Ano 2024</strong></p><!-- <a href="/gone.xlsx">x</a> --><ul>
      <li><a href="/d?a=1&amp;f=itbi.xlsx">um &eacute; dois</a><li><a class=x href=/d/itbi2.xlsx>bare</a>
      <li><a title="a > b" HREF = '/q/&#39;itbi&#x2F;3.xlsx'>q</a><a data-href="/no" href="/four&copy&unknown;.xlsx">4</a>
      <li><a name="x">none</a><a href="">empty</a><abbr href="/no">no</abbr><a/href="/slash.xlsx">s</a></ul><!-- open <a href=/never>"""

    class Reader(HTMLParser):
        def __init__(self):
            super().__init__()
            self.found = []

        def handle_starttag(self, tag, attrs):
            if tag == "a" and "href" in dict(attrs):
                self.found.append(dict(attrs)["href"])

    reader = Reader()
    reader.feed(html.split("<!-- open")[0].replace("&copy&", "&amp;copy&"))
    df = spark.createDataFrame([(1, html)], "page_id long, html string")
    rows = links.page_links(df).orderBy("pos").collect()
    assert [r["href"] for r in rows] == reader.found
    assert rows[0]["href"] == "/d?a=1&f=itbi.xlsx" and rows[1]["href"] == "/d/itbi2.xlsx" and rows[2]["href"] == "/q/'itbi/3.xlsx"
    assert rows[0]["context"] == "Ano 2024 um é dois"


def test_references_are_decoded_in_linear_time(spark):
    import time

    def seconds(n):
        df = spark.createDataFrame([("&amp;&#233;&#x1F600;&nope;&#0; " * n,)], "t string")
        start = time.perf_counter()
        assert df.select(links.decode_references(F.col("t")).alias("t")).first()["t"] == "&é\U0001f600&nope;&#0; " * n
        return time.perf_counter() - start
    seconds(100)
    assert seconds(40_000) < 8 * seconds(10_000) + 2


def test_cells_of_records(spark):
    said = ["a;b", "", '";"', '"""";x', 'a;""";x";"y"', 'p"q;"r;s";t', '"z"t;u', '"a;b\n;c"";"', '""', '"open;x']
    found = spark.createDataFrame([(r,) for r in said], "r string").select(records.cell_count(F.col("r")).alias("n")).collect()
    assert [r.n for r in found] == [2, 1, 1, 2, 3, 3, 2, 1, 1, 1]


def test_landed_folders(spark, tmp_path):
    cells = [F.lit(f"c{i}").alias(f"c{i}") for i in range(28)]
    rows = spark.range(300).repartition(3).select(F.concat(F.col("id").cast("string"), F.lit('\n"a";\r\n')).alias("id"), *cells[1:])
    sinks.write_part(rows, str(tmp_path), "itbi 2024.xlsx", "JAN-2024")
    sinks.write_part(rows, str(tmp_path), "itbi 2024.xlsx", "Resumo")
    sinks.write_part(rows.limit(2).select("*", F.lit("more").alias("x")), str(tmp_path), "itbi 2025.xlsx", "FEV-2025")
    write(tmp_path / "itbi_2023.xlsx" / "MAR-2023.csv", ";".join(map(str, range(20))) + "\n")
    found = raw.read_monthly_parts(spark, str(tmp_path)).collect()
    assert sorted({(r.arquivo, r.aba) for r in found}) == [("itbi 2024.xlsx", "JAN-2024"), ("itbi 2025.xlsx", "FEV-2025"), ("itbi_2023.xlsx", "MAR-2023")]
    assert sorted(r.n_do_cadastro for r in found if r.aba == "JAN-2024") == sorted(f'{i}\n"a";\r\n' for i in range(300))
    assert [r.coluna_extra_28 for r in found if r.aba == "FEV-2025"] == ["more", "more"] and len(found) == 303


def split_into(spark, size):
    """Small blocks, so that records cross them."""
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    for name, value in zip(("maxPartitionBytes", "openCostInBytes"), (size, 1) if isinstance(size, int) else size, strict=True):
        spark.conf.set(f"spark.sql.files.{name}", value)
    return before


def rows_of(df):
    return sorted(map(repr, map(tuple, df.collect())))


@pytest.mark.parametrize("block", [40, 64, 301, 5000, 1 << 27])
def test_records_of_blocks_equal_the_whole_file(spark, tmp_path, block):
    import random

    rng = random.Random(block)
    bits = ["a", "b c", ";", '""', "\n", "\r\n", "é", "x" * 30, " ", "\n\n"]
    lines = ["k;l;m"]
    for i in range(400):
        cells = [str(i)]
        for _ in range(2):
            kind = rng.random()
            inner = "".join(rng.choices(bits, k=rng.randint(0, 9)))
            cells.append('"' + inner + '"' if kind < 0.4 else 'p"q' if kind < 0.5 else '"z"t' if kind < 0.55 else "" if kind < 0.7 else f"v{i}")
        lines.append(";".join(cells) + (";more" if i % 50 == 0 else ""))
        if i % 37 == 0:
            lines.append("")
    write(tmp_path / "one.csv", "\n".join(lines))
    write(tmp_path / "two.csv", "k;l;m\n" + "\n".join(lines[200:300]) + "\n")
    names, options = ["k", "l", "m"], {"sep": ";", "quote": '"', "escape": '"', "multiLine": "true", "header": "true"}
    want = rows_of(spark.read.options(**options).schema(raw.string_schema(names)).csv(str(tmp_path)))
    before = split_into(spark, block)
    try:
        found = raw.read_delimited(spark, str(tmp_path), names)
        tasks = records._lines(spark, str(tmp_path), {}).rdd.getNumPartitions()
        got = rows_of(found)
    finally:
        split_into(spark, before)
    assert got == want and len(want) > 450 and (block > 5000 or tasks > 3)


def test_blocks_inside_quotes_without_a_broadcast(spark, tmp_path, monkeypatch):
    write(tmp_path / "a.csv", "h;i\n" + "".join(f'{n};"{"line" * 5}\nof {n}\n"\n' for n in range(200)) + '200;"open\nto the\nend')
    monkeypatch.setattr(records, "BROADCAST_BLOCKS", 0)
    before = split_into(spark, 100)
    try:
        got = sorted(map(tuple, raw.read_delimited(spark, str(tmp_path), ["h", "i"]).collect()), key=lambda r: int(r[0]))
    finally:
        split_into(spark, before)
    assert got[:200] == [(str(n), f'{"line" * 5}\nof {n}\n') for n in range(200)] and got[200][0] == "200" and len(got) == 201


@pytest.mark.parametrize(("line", "outside", "inside"), [
    ("a;b", False, True), ('"a;b', True, False), ('a";b', False, False), ('""', False, True), ('x;""";', True, False),
    ('"a"b";"c', True, True), ("", False, True), ('a"b;"c', True, True), ('";"', False, True)])
def test_where_a_line_leads(line, outside, inside):
    assert (records.ends_inside(line, False, ";"), records.ends_inside(line, True, ";")) == (outside, inside)


def test_parts_are_cut_once_and_names_judged_per_file(spark, tmp_path):
    cells = [F.concat(F.lit('a;\n"'), F.col("id").cast("string")).alias("_c0"), *[F.lit("x").alias(f"_c{i}") for i in range(1, 28)]]
    for arquivo, aba in (("itbi um.xlsx", "JAN-2024"), ("itbi_b.xlsx", "fev-2024"), ("itbi_b.xlsx", "Resumo")):
        sinks.write_part(spark.range(50).select(*cells), str(tmp_path), arquivo, aba)
    got = raw.read_monthly_parts(spark, str(tmp_path))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" not in plan and "url_decode" not in plan.lower() and "UrlCodec" not in plan
    rows = got.groupBy("arquivo", "aba").agg(F.count_distinct("n_do_cadastro").alias("n")).collect()
    assert {tuple(r) for r in rows} == {("itbi um.xlsx", "JAN-2024", 50), ("itbi_b.xlsx", "fev-2024", 50)}
    lines = records._lines(spark, str(tmp_path), {"recursiveFileLookup": "true"})
    picked = records._of_files(spark, lines, str(tmp_path), {"recursiveFileLookup": "true"}, F.col("file").contains("Resumo"))
    assert picked.count() == 100 and "Contains" not in picked._jdf.queryExecution().optimizedPlan().toString()
