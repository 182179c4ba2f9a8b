"""Split reading of CSV against Spark's one-task reader."""

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from paperledger.operators.attempts import keep_last
from paperledger.operators.chunks import with_file_index
from paperledger.sources import csv_files
from paperledger.sources.attempts import read_attempts


@pytest.fixture
def small_splits(spark):
    """Splits of some hundred bytes."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def rows_of(df):
    return [(r.a, r.b, r.c) for r in df.orderBy("src_file", "src_block", "src_pos").collect()]


def one_task(spark, path):
    reader = spark.read.options(**csv_files.CSV_OPTIONS).option("multiLine", True).option("header", True)
    return [tuple(r) for r in reader.schema("a string, b string, c string").csv(path).collect()]


plain = st.one_of(st.just(""), st.text(alphabet='xyz "\t', max_size=6).map(lambda t: "p" + t))
quoted = st.text(alphabet='xy,"\n \r', max_size=30).map(lambda t: '"' + t.replace('"', '""') + '"')
record = st.lists(st.one_of(plain, quoted), min_size=1, max_size=4).map(",".join)


def compared(spark, folder, files):
    for i, records in enumerate(files):
        (folder / f"f {i}.csv").write_bytes(("a,b,c\n" + "\n".join(records)).encode())
    want = [row for i in range(len(files)) for row in one_task(spark, str(folder / f"f {i}.csv"))]
    found = csv_files.read_csv_text(spark, str(folder))
    assert rows_of(found) == want
    assert [r.n for r in with_file_index(found, "n").orderBy("n").select("n").collect()] == list(range(len(want)))


@settings(deadline=None, max_examples=3, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(record, max_size=25), min_size=1, max_size=3))
def test_random_quoting(spark, tmp_path_factory, small_splits, files):
    compared(spark, tmp_path_factory.mktemp("csv"), files)


@pytest.mark.parametrize("files", [
    [['x,"' + "\n" * 900 + '",y', 'a"b,"c"",\n",d']],
    [['1,"2\n3",4'] * 60 + ["", '5,"6'], ["7,8,9"]],
    [[f'{"y" * i},"{"z" * 150}\n{"w" * i}","""\n"""' for i in range(60)], ['"a"b,c', 'd,"e\nf",g']],
])
def test_records_over_many_splits(spark, tmp_path, small_splits, files):
    compared(spark, tmp_path, files)


def test_line_ends_of_two_characters(spark, tmp_path, small_splits):
    (tmp_path / "f.csv").write_bytes(b'a,b,c\r\n' + b'1,"2\r\n3",4\r\n\r\n \r\n' * 40 + b'5,6,7\r\n')
    assert rows_of(csv_files.read_csv_text(spark, str(tmp_path))) == [("1", "2\r\n3", "4")] * 40 + [("5", "6", "7")]


@pytest.mark.parametrize("line, from_out, from_in", [
    ("a,b", False, True), ('a,"b', True, False), ('b",c', False, False), ('"a""b"', False, False), ('"a""', True, False),
    ('a"b,c', False, False), ('"",""', False, True), ('""', False, True), ('","', False, True), ('x,"', True, False), ('"a"b,"c', True, True),
])
def test_states_of_a_line(spark, line, from_out, from_in):
    row = spark.createDataFrame([(line,)], "v string").select(csv_files.ends_inside(F.col("v"), False), csv_files.ends_inside(F.col("v"), True))
    assert tuple(row.first()) == (from_out, from_in)


def test_a_large_file_with_newlines_is_read_by_all_cores(spark, tmp_path, small_splits):
    body = "a,b,c\n" + "".join(f'{i},"m\n{i}",x\n' for i in range(1000))
    (tmp_path / "m.csv").write_text(body)
    found = csv_files.read_csv_text(spark, str(tmp_path))
    assert "multiLine" not in found._jdf.queryExecution().toString()
    assert rows_of(found) == [(str(i), f"m\n{i}", "x") for i in range(1000)]
    lines = spark.read.text(str(tmp_path))
    assert lines.rdd.getNumPartitions() > 30


def test_a_stitched_file_with_another_header_is_refused(spark, tmp_path):
    (tmp_path / "0.csv").write_text("a,b\n1,2\n3,4\n5,6\n7,8\n")
    (tmp_path / "1.csv").write_text('b,a\n1,"2\n3"\n')
    with pytest.raises(Exception, match="header differs"):
        csv_files.read_csv_text(spark, str(tmp_path)).collect()


def test_the_last_row_of_a_split_file_counts(spark, tmp_path, small_splits):
    rows = "".join(f'{i % 7},p,failed,,,1,"m\n{i}",x\n' for i in range(500))
    (tmp_path / "chunk_00000.csv").write_text("pmid,pdf_path,status,json_path,md_path,processing_time,error_msg,processed_at\n" + rows)
    (tmp_path / "chunk_00001.csv").write_text("pmid,status,error_msg\n" + "".join(f"{i % 5 + 7},failed,{i}\n" for i in range(900)))
    last = {int(r.pmid): r.error_msg for r in keep_last(read_attempts(spark, str(tmp_path))).collect()}
    assert last == {**{i % 7: f"m\n{i}" for i in range(500)}, **{i % 5 + 7: str(i) for i in range(900)}}
