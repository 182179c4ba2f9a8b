from paperledger.llm import html, jaccard, packing, toxicity, warc
from tests.llm.test_packing import PATH

LARGE = (1 << 53) + 1


def test_large_ids_survive_beside_nulls(spark):
    docs = spark.createDataFrame([(LARGE, "a b c d e f"), (None, "x"), (LARGE + 2, "y")], "doc_id long, text string").coalesce(1)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    want = {LARGE, LARGE + 2, None}
    assert {r.doc_id for r in packing.best_fit_packing(docs, PATH).collect()} == want
    assert {r.doc_id for r in toxicity.toxicity(docs, labels).collect()} == want
    assert {(r.doc_id, r.component_id) for r in jaccard.jaccard_components(docs).collect()} == {(x, x) for x in want}
    pages = spark.createDataFrame([(LARGE, "u", "a"), (None, "u", "b"), (LARGE + 2, "u", "a")], "page_id long, url string, html string").coalesce(1)
    assert {r.page_id for r in html.main_texts(pages).collect()} == want
    assert {(r.page_id, r.refers_to) for r in warc.round_trip(pages).collect()} == {(LARGE, None), (None, None), (LARGE + 2, LARGE)}
