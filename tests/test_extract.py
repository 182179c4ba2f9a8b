import os
import subprocess
import pytest
import pandas as pd
from pyspark.sql import functions as F
import os
import time

from paperledger.operators.content import page_elements, page_outcomes, text_elements, unescaped
from pyspark.resource import ResourceProfileBuilder, TaskResourceRequests

from paperledger.operators import extract
from paperledger.operators.extract import Backend, extract_by_backend, extract_documents, outcome_elements, paragraphs, run_tool
from paperledger.plans.commands import process_manifest


def rough(pmid, source):
    if source == "raise":
        raise RuntimeError("bad page " + "x" * 500)
    if source == "sleep":
        time.sleep(60)
    if source == "die":
        os._exit(3)
    if source == "empty":
        return []
    return [{"type": "text", "text": source, "page_idx": 0, "bbox": [0.0, 1.5]}]


def test_outcome_contract(spark):
    docs = spark.createDataFrame(
        [(str(i), s) for i, s in enumerate(["ok", "raise", "sleep", "die", "empty", "fine"])], "pmid string, pdf_path string").coalesce(1)
    out = extract_documents(docs, rough, "hybrid-auto-engine", timeout_s=3).persist()
    got = {r.pmid: r for r in out.collect()}
    assert [got[str(i)].status for i in range(6)] == ["completed", "failed", "failed", "failed", "failed", "completed"]
    assert got["1"].error_msg.startswith("RuntimeError: bad page") and len(got["1"].error_msg) == 14 + 200
    assert got["2"].error_msg == "Processing timeout (3 s)" and got["2"].processing_time >= 3
    assert got["3"].error_msg == "Extractor process died" and got["4"].error_msg == "No output files generated"
    assert {r.backend for r in got.values()} == {"hybrid-auto-engine"}
    rows = outcome_elements(out).collect()
    assert sorted((r.pmid, r.seq, r.text, r.bbox) for r in rows) == [("0", 0, "ok", [0.0, 1.5]), ("5", 0, "fine", [0.0, 1.5])]
    out.unpersist()


def shouted(pmid, source):
    return [{"type": "text", "text": source.upper()}]


def test_backends_side_by_side(spark):
    docs = spark.createDataFrame([
        ("1", "a\nb", "plain", None), ("2", "c", "loud", None), ("3", "d", "other", None), ("4", "e", None, None),
        ("5", "f", "loud", "gone"), ("6", "g", "other", "gone"),
    ], "pmid string, pdf_path string, backend string, known string")
    backends = {"plain": Backend(paragraphs), "loud": Backend(shouted)}
    out = {r.pmid: r for r in extract_by_backend(docs, backends, known_error="known").collect()}
    assert {p: (r.backend, r.error_msg, [e.text for e in r.elements]) for p, r in out.items()} == {
        "1": ("plain", None, ["a", "b"]), "2": ("loud", None, ["C"]), "3": ("other", "Unknown backend: other", []),
        "4": (None, "Unknown backend: none", []), "5": ("loud", "gone", []), "6": ("other", "gone", []),
    }
    assert {r.status for p, r in out.items() if p > "2"} == {"failed"}
    assert extract_by_backend(docs.filter("false"), backends).count() == 0
    assert {r.status for r in extract_by_backend(docs, {}).collect()} == {"failed"}


def profiles(df):
    """Ids of the resource profiles in a plan that is not run."""
    out, todo = [], [df._jdf.queryExecution().analyzed()]
    while todo:
        node = todo.pop()
        if node.nodeName() == "MapInPandas":
            out.append(node.profile().get().id() if node.profile().isDefined() else None)
        todo.extend(node.children().apply(i) for i in range(node.children().size()))
    return out


def test_backends_ask_for_their_resources(spark, monkeypatch):
    docs = spark.createDataFrame([("1", "a", "plain"), ("2", "c", "gpu")], "pmid string, pdf_path string, backend string")
    profile = ResourceProfileBuilder().require(TaskResourceRequests().cpus(2)).build
    backends = {"plain": Backend(paragraphs), "gpu": Backend(shouted, profile)}
    assert profiles(extract_by_backend(docs, backends)) == [None, None]  # a local master has no profiles
    assert {r.status for r in extract_by_backend(docs, backends).collect()} == {"completed"}
    monkeypatch.setattr(extract, "_has_profiles", lambda spark: True)
    asked = profiles(extract_by_backend(docs, backends))
    assert sorted(a is None for a in asked) == [False, True]


def test_process_manifest(spark):
    manifest = spark.createDataFrame([("100001", "a"), ("100002", "b"), ("100003", "c")], "pmid string, pdf_path string")
    inputs = spark.createDataFrame([("a", 1), ("b", 1)], "path string, length long")
    outputs = spark.createDataFrame([("out/100/100002/auto/100002_content_list.json", 1)], "path string, length long")
    got = {r.pmid: (r.status, r.error_msg, r.processing_time is None) for r in process_manifest(manifest, inputs, outputs, paragraphs).collect()}
    assert got == {"100001": ("completed", None, False), "100003": ("failed", "PDF file not found: c", True)}


PAGE = """<html><head><style>p{}</style><script>var t="<p>no</p>";</script></head><body>
<nav><ul><li><a href="/x">Home</a></li></ul></nav><!-- <p>no</p> --><div class="ad">Buy <p>x</p></div>
<article><h1>Title &amp; more</h1><p>One <b>bold</b><br>two<p>Open <i>end<ul><LI class="x">Item &lt;1&gt;</LI></ul></article>
<footer>Foot</footer></body></html>"""


def test_page_elements(spark):
    df = spark.createDataFrame([(1, PAGE), (2, "<div> </div><nav><p>menu</p></nav>"), (3, None)], "page_id int, html string")
    got = [(r.seq, r.type, r.text, r.text_level) for r in page_elements(df.filter("page_id = 1")).orderBy("seq").collect()]
    assert got == [
        (0, "discarded", "Home", None), (1, "text", "Title & more", 1), (2, "text", "One bold\ntwo", None),
        (3, "text", "Open end", None), (4, "list", "Item <1>", None), (5, "footer", "Foot", None),
    ]
    outcome = {r.page_id: (r.status, r.n_elements, r.error_msg) for r in page_outcomes(df).collect()}
    nothing = ("failed", 0, "No output files generated")
    assert outcome == {1: ("completed", 5, None), 2: nothing, 3: nothing}


@pytest.mark.parametrize("html,want", [
    ("<p>one <u>two</u> three</p>", [("text", "one two three")]),
    ("<p>p &lt; 0.05 if x < 3 then</p>", [("text", "p < 0.05 if x < 3 then")]),
    ('<p>a <img src="x"> b</p>', [("text", "a  b")]),
    ("<h2>Head</h2><table><tr><td>1<td>2</table>tail", [("text", "Head"), ("text", "1"), ("text", "2"), ("text", "tail")]),
    ("<div>in<p>para</p>out</div>", [("text", "in"), ("text", "para"), ("text", "out")]),
    ("plain", [("text", "plain")]), ("<nav>open <p>x", [("text", "open"), ("text", "x")]), ("", []),
    ("<title>t</title><p></p><p>x", [("text", "t"), ("text", "x")]),
])
def test_no_text_is_lost(spark, html, want):
    rows = page_elements(spark.createDataFrame([(1, html)], "page_id int, html string")).orderBy("seq").collect()
    assert [(r.type, r.text) for r in rows] == want


def test_long_paragraph_with_many_inline_tags(spark):
    html = "<p>" + "<b>x</b> y " * 200_000 + "</p>"
    row = page_elements(spark.createDataFrame([(1, html)], "page_id int, html string")).first()
    assert row.text == ("x y " * 200_000).strip()


def test_text_elements(spark):
    df = spark.createDataFrame([(1, "a\n \n b \n")], "doc_id int, text string")
    assert [(r.seq, r.text) for r in text_elements(df).collect()] == [(0, "a"), (2, "b")]


def test_a_timeout_ends_what_the_extractor_started(spark, tmp_path):
    marker = f"sleep 97.{os.getpid()}"

    def starts(pmid, source):
        subprocess.run(["sh", "-c", f"{marker}; true"])

    df = spark.createDataFrame([("1", "a")], "pmid string, pdf_path string")
    row = extract_documents(df, starts, timeout_s=1).first()
    assert row.error_msg.startswith("Processing timeout")
    assert marker not in subprocess.run(["ps", "-eo", "args"], capture_output=True, text=True).stdout


def test_error_text_of_a_tool(spark):
    def loud(pmid, source):
        run_tool("sh", "-c", "printf 'x%.0s' $(seq 900) >&2; exit 3")

    def mute(pmid, source):
        run_tool("false")

    df = spark.createDataFrame([("1", "a")], "pmid string, pdf_path string")
    assert extract_documents(df, loud).first().error_msg == "x" * 500
    assert extract_documents(df, mute).first().error_msg == "Unknown error"


def test_extractors_may_use_processes(spark):
    def forks(pmid, source):
        import multiprocessing as mp

        with mp.get_context("fork").Pool(2) as pool:
            return [{"type": "text", "text": str(x)} for x in pool.map(abs, [-1, -2])]

    df = spark.createDataFrame([("1", "a")], "pmid string, pdf_path string")
    assert [e.text for e in extract_documents(df, forks, timeout_s=60).first().elements] == ["1", "2"]


def test_documents_are_spread_by_default(spark):
    df = spark.createDataFrame([(str(i), "a") for i in range(2000)], "pmid string, pdf_path string").coalesce(1)
    parts = extract_documents(df, paragraphs).select(F.spark_partition_id().alias("p")).distinct().count()
    assert parts > 8


@pytest.mark.parametrize("written, text", [
    ("caf&eacute; &#8217; &#x2019; &#X1F600;", "caf\u00e9 \u2019 \u2019 \U0001f600"),
    ("&amp;lt; &amp;amp; a&b & c; &nosuch; &", "&lt; &amp; a&b & c; &nosuch; &"),
    ("&#0; &#xD800; &#x110000; &#99999999999999; &#;", "\ufffd \ufffd \ufffd \ufffd &#;"),
    ("&#150;&#x80; &NotEqualTilde; &AMP; &lt;b&gt;", "\u2013\u20ac \u2242\u0338 & <b>"),
    ("&#00000000065;", "A"), ("&#160;&nbsp;&ensp;&#32;", None), ("a&copy b", "a&copy b"),
])
def test_character_references(spark, written, text):
    rows = page_elements(spark.createDataFrame([(1, f"<p>{written}</p>")], "page_id int, html string")).collect()
    assert [r.text for r in rows] == ([] if text is None else [text])


def test_what_is_never_closed_is_no_text(spark):
    pages = [(1, "<p>a<script>var t = '<p>no</p>'; if (1 < 2)"), (2, "<p>a<style>p {}"), (3, "<p>a<!-- <p>no</p>"), (4, "<p>a<script>x</script><p>b")]
    df = spark.createDataFrame(pages, "page_id int, html string")
    assert sorted((r.page_id, r.text) for r in page_elements(df).collect()) == [(1, "a"), (2, "a"), (3, "a"), (4, "a"), (4, "b")]


def test_what_else_is_dropped_is_a_parameter(spark):
    df = spark.createDataFrame([(1, '<p>a</p><div class="ad">x</div><aside>y</aside>')], "page_id int, html string")
    assert [r.text for r in page_elements(df).collect()] == ["a", "y"]
    assert [r.text for r in page_elements(df, dropped=()).collect()] == ["a", "x", "y"]
    assert [r.text for r in page_elements(df, dropped=[r"aside\b.*?</aside>"]).collect()] == ["a", "x"]


def test_every_named_reference(spark):
    from html import unescape
    from html.entities import html5

    names = [f"x &{name} y" for name in html5 if name.endswith(";")] + [f"&#{i}; &#x{i:x};" for i in range(160, 40_000, 37)]
    df = spark.createDataFrame([(n,) for n in names], "x string")
    assert [r[1] for r in df.select("x", unescaped(F.col("x"))).collect()] == [unescape(n) for n in names]


def test_rows_are_handed_on_by_their_text(spark):
    batches = []

    class Given:
        sparkSession = spark

        def select(self, *_):
            return self

        def repartition(self, _):
            return self

        def mapInPandas(self, run, *_, **__):
            batches.append(run)
            return self

    extract_documents(Given(), paragraphs, source="text", partitions=1)
    given = pd.DataFrame([(str(i), "line\n" * 1000, None) for i in range(60)], columns=["pmid", "source", "known_error"])
    sizes = [len(b) for b in batches[0](iter([given]))]
    assert sum(sizes) == 60 and len(sizes) > 10
