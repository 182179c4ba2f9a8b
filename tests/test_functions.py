import pytest
from pyspark.sql import functions as F

from paperledger.functions import paths, text


def values(spark, rows, column):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, x string").repartition(3)
    return [r[1] for r in sorted(df.select("i", column.alias("y")).collect())]


def test_strip_and_blank(spark):
    rows = ["  a b ", "\t\n", " x ", "", None, "y"]
    assert values(spark, rows, text.strip("x")) == ["a b", "", "x", "", None, "y"]
    assert values(spark, rows, text.blank_to_null("x")) == ["a b", None, "x", None, None, "y"]


def test_safe_double(spark):
    rows = ["", "12.5", "abc", "0", " 1e3 ", "1.5d", "2f", "0x1p3", None, "inf"]
    assert values(spark, rows, text.safe_double("x")) == [None, 12.5, None, 0.0, 1000.0, None, None, None, None, float("inf")]
    nan = values(spark, ["nan"], text.safe_double("x"))[0]
    assert nan != nan


def test_stem(spark):
    rows = ["a/b/c.pdf", "c.tar.gz", ".bashrc", "a.", "dir/", "x..y", "no"]
    assert values(spark, rows, text.stem("x")) == ["c", "c.tar", ".bashrc", "a.", "dir", "x.", "no"]


def test_id_from_name(spark):
    rows = ["12345678901234.pdf", "PMC1234567.PDF", "12345.pdf", "a_123456_v2.pdf", "00123456.pdf"]
    assert values(spark, rows, text.id_from_name("x")) == ["5678901234", "1234567", None, None, "00123456"]


def test_prefix_keeps_leading_zeros(spark):
    assert values(spark, ["0012345678", " 12", "1"], text.id_prefix("x")) == ["001", "12", "1"]


def test_size_band(spark):
    sizes = ["0", "1048575", "1048576", "5242879", "5242880", "10485759", "10485760", None]
    bands = ["<1MB", "<1MB", "1-5MB", "1-5MB", "5-10MB", "5-10MB", ">10MB", None]
    assert values(spark, sizes, text.size_band(F.col("x").cast("long"))) == bands


def test_mb_to_bytes_truncates():
    assert text.mb_to_bytes(0.3) == 314572


def test_small_labels(spark):
    assert values(spark, ["cn2355", "cn9", "gpu1"], text.node_prefix("x")) == ["cn23", None, None]
    assert values(spark, ["✓", "✗", "?"], text.status_from_glyph("x")) == ["completed", "failed", None]
    assert values(spark, ["7", "100000"], text.chunk_id(F.col("x").cast("int"))) == ["chunk_00007", "chunk_100000"]
    assert values(spark, [" 12 "], text.memory_label("x", F.lit(" 16"))) == ["12/16MB"]
    assert values(spark, ["a_content_list_content_list"], text.strip_suffix("x")) == ["a"]


def test_local_time(spark):
    got = values(spark, ["2025-01-06T12:30:05.250000", " 2025-01-06 ", "soon", ""], text.local_time("x"))
    assert [str(v) for v in got] == ["2025-01-06 12:30:05.250000", "2025-01-06 00:00:00", "None", "None"]


def test_canonical_latex(spark):
    rows = [
        r"Flux of $\mathbf { K } ^ { + }$ and \mathbf x",
        r"Flux of $\mathrm{K}^{+}$ and \mathbf x",
        r"price $ 5 and \mathbf{K}",
        r"$\mathbfx{K}$ $\mathbb\mathtt{H}$",
    ]
    assert values(spark, rows, text.canonical_latex("x")) == [
        r"Flux of $\mathrm{K}^{+}$ and \mathbf x",
        r"Flux of $\mathrm{K}^{+}$ and \mathbf x",
        r"price $ 5 and \mathbf{K}",
        r"$\mathbfx{K}$ $\mathrm\mathrm{H}$",
    ]


@pytest.mark.parametrize("written, folded", [
    (r"$$\mathbf { K }$$ $ a $", r"$$\mathrm{K}$$ $a$"),
    (r"\(\mathtt { x }\) and \[ a + b \] and ( a )", r"\(\mathrm{x}\) and \[a+b\] and ( a )"),
    (r"\$5 or \$6, $ x \$ y $", r"\$5 or \$6, $x\$y$"),
    (r"$\mathbf{\mathbb { K } _ 1}$", r"$\mathrm{\mathrm{K}_1}$"),
    (r"$\mathbf Kx \mathbb 2 \mathtt \alpha$", r"$\mathrm{K}x\mathrm{2}\mathrm\alpha$"),
    (r"$\operatorname * { a } \alpha b \alpha 1 \, c$", r"$\operatorname*{a}\alpha b\alpha1\,c$"),
    (r"$a \text { if  { x y } \} } b \text c$", r"$a\text{ if  { x y } \} }b\text c$"),
    (r"$$a \text{ if $x y$ } b$$", r"$$a\text{ if $x y$ }b$$"),
    (r"\( a \( b \) c", r"\( a \(b\) c"), (r"\\( a \)", r"\\( a \)"), ("$$ a b", "$$ a b"), ("$$$$ a $", "$$$$ a $"),
    ("a $ x\n y $ z", "a $xy$ z"), ("$} { x$", "$}{x$"), ("a\\", "a\\"), ("", ""), (None, None),
])
def test_latex_grammar(spark, written, folded):
    assert values(spark, [written], text.canonical_latex("x")) == [folded]


def test_long_formulas(spark):
    plain, maths = "x y " * 200_000, "$" + "a b " * 5_000 + "$"
    rows = [plain, f"$ {plain}", maths, "\\( " * 50_000]
    assert values(spark, rows, text.canonical_latex("x")) == [plain, f"$ {plain}", "$" + "ab" * 5_000 + "$", "\\( " * 50_000]


@pytest.mark.parametrize("path, root, pmid, layout, subdir, file, dest", [
    ("out/123/123456/auto/f.json", "out", "123456", "canonical", "auto", "f.json", "out/123/123456/auto/f.json"),
    ("/a/out/123/123456/123456/auto/f.json", "/a/out", "123456", "nested", "auto", "f.json", "/a/out/123/123456/auto/f.json"),
    ("out/123456/vlm/f.json", "out", "123456", "flat", "vlm", "f.json", "out/123/123456/vlm/f.json"),
    ("out/123456/123456/auto/f.json", "out", "123456", "flat_nested", "auto", "f.json", "out/123/123456/auto/f.json"),
    ("123456/auto/f.json", "", "123456", "flat", "auto", "f.json", "123/123456/auto/f.json"),
    ("out/12/12/auto/f.json", "out", "12", "canonical", "auto", "f.json", "out/12/12/auto/f.json"),
    ("out/123/123456/auto/images/1.jpg", "out", "123456", "canonical", "auto", "images/1.jpg", "out/123/123456/auto/images/1.jpg"),
])
def test_output_paths(spark, path, root, pmid, layout, subdir, file, dest):
    row = paths.with_output_path(spark.createDataFrame([(path,)], "path string")).first()
    assert (row.root, row.pmid, row.layout, row.subdir, row.file, row.dest) == (root, pmid, layout, subdir, file, dest)


def test_paths_without_a_known_subdirectory(spark):
    cases = ["auto/f.json", "f", "auto/images/f.jpg", "out/123/12345678/paper.md", "/auto/f"]
    rows = paths.with_output_path(spark.createDataFrame([(p,) for p in cases], "path string")).collect()
    assert [r.path for r in rows] == cases
    assert all((r.layout, r.pmid, r.root, r.dest) == ("unknown", None, None, None) for r in rows)


def test_nested_images(spark):
    row = paths.with_output_path(spark.createDataFrame([("out/123/12345678/auto/images/sub/x.jpg",)], "path string")).first()
    assert (row.pmid, row.layout, row.file, row.dest) == ("12345678", "canonical", "images/sub/x.jpg", "out/123/12345678/auto/images/sub/x.jpg")


def test_artifact_class(spark):
    rows = ["1_content_list.json", "1.md", "1_middle.json", "1_model.json", "1_layout.pdf", "x.jpg"]
    assert values(spark, rows, paths.artifact_class("x")) == ["content_list", "markdown", "middle", "model", "layout_pdf", "other"]
