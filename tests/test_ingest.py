"""Ingest: headers by prefix, rescued values, inferred types, one-pass JSON, schema log."""

import gzip
import json
import time
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from assayline.sources import prefix
from assayline.sources import types as Y
from assayline.sources.files import Source, header_lines, ingest


def write(folder, files):
    for name, content in files.items():
        Path(folder, name).parent.mkdir(parents=True, exist_ok=True)
        Path(folder, name).write_bytes(content if isinstance(content, bytes) else content.encode())
    return str(folder)


def csv_rows(spark, folder, columns=("id", "x"), infer=False, **options):
    df = ingest(spark, Source("t", "csv", "*.csv*", columns, options=options), folder, infer_types=infer)
    return df, [{c: r[c] for c in df.columns if c not in ("_ingest_time", "_source_file", "_source_region")} for r in df.collect()]


# --- headers ----------------------------------------------------------------
@pytest.mark.parametrize("content, header", [
    (b"a,b\n1,2\n", "a,b"), (b"\n \t\n\r\na,b\r\n1,2", "a,b"), (b"a,b", "a,b"), (b"", None), (b"\n\n", None),
    (b"\xef\xbb\xbfa,b\n", "a,b"), (b"a," + b"x" * 100_000 + b"\n1,2\n", "a," + "x" * 100_000), (b"a,b\r1,2\r", "a,b")])
def test_first_line(tmp_path, content, header):
    write(tmp_path, {"f.csv": content, "f.csv.gz": gzip.compress(content)})
    assert prefix.first_line(f"file:{tmp_path}/f.csv", {}) == (header, True)
    assert prefix.first_line(f"{tmp_path}/f.csv.gz", {}) == (header, True)


def test_first_line_reads_a_prefix_only(tmp_path):
    read = []

    class Counting:
        def __init__(self, path):
            self.f = open(path, "rb")

        def read(self, n):
            read.append(n)
            return self.f.read(n)

        def __enter__(self):
            return self

        def __exit__(self, *_):
            self.f.close()
    write(tmp_path, {"f.csv": "a,b\n" + "1,2\n" * 500_000})
    assert prefix.first_line(f"{tmp_path}/f.csv", {}, Counting)[0] == "a,b"
    assert sum(read) == prefix.CHUNK


def test_files_that_tasks_cannot_open_are_read_by_spark(spark, tmp_path, monkeypatch):
    write(tmp_path, {"a.csv": "id,x\n1,2\n", "b.csv.bz2": __import__("bz2").compress(b"id,y\n3,4\n"), "c d%25 .csv": "x,id\n5,6\n"})
    rows = {r["path"].rsplit("/", 1)[1]: (r["header"], r["opened"]) for r in header_lines(
        spark, Source("t", "csv", "*.csv*"), str(tmp_path)).collect()}
    assert rows["b.csv.bz2"] == (None, False) and rows["c d%25 .csv"] == ("x,id", True)
    _, got = csv_rows(spark, str(tmp_path), ("id", "x", "y"))
    assert sorted((r["id"], r["x"], r["y"]) for r in got) == [("1", "2", None), ("3", None, "4"), ("6", "5", None)]
    assert prefix.first_line("viewfs://store/a.csv", {}) == (None, False)


# --- rescued values ---------------------------------------------------------
def test_surplus_and_broken_records_are_rescued(spark, tmp_path):
    write(tmp_path, {"a.csv": 'id,x\n1,5,7\n2,"a,b"\n3,"a",,"b ""c"" d"\n4\n5,"open\n6,"open,7\n7,say "hi"\n8,\n9,"q\\"s",10\n',
                     "b.csv": "id,x,extra\n10,1,e\n11,2\n12,3,,z\n"})
    _, got = csv_rows(spark, str(tmp_path))
    rescued = {r["id"]: json.loads(r["_rescued_data"]) if r["_rescued_data"] else None for r in got}
    assert rescued == {
        "1": {"_c2": "7"}, "2": None, "3": {"_c3": 'b "c" d'}, "4": None, "5": {"_corrupt_record": '5,"open'},
        "6": {"_corrupt_record": '6,"open,7'}, "7": None, "8": None, "9": {"_c2": "10"},
        "10": {"extra": "e"}, "11": None, "12": {"_c3": "z"}}
    x = {r["id"]: r["x"] for r in got}
    assert x["1"] == "5" and x["2"] == "a,b" and x["3"] == "a" and x["4"] is None and x["9"] == 'q"s'


def test_surplus_with_another_separator_and_long_values(spark, tmp_path):
    write(tmp_path, {"a.csv": f"id|x\n1|{'y' * 50_000}|\"{'z' * 200_000}\"|w\n"})
    _, (row,) = csv_rows(spark, str(tmp_path), sep="|")
    assert json.loads(row["_rescued_data"]) == {"_c2": "z" * 200_000, "_c3": "w"} and row["x"] == "y" * 50_000


# --- types ------------------------------------------------------------------
@pytest.mark.parametrize("values, name", [
    (["1", "-2", None, ""], "int"), (["1", "3000000000"], "bigint"), (["1", "2.5"], "double"), (["1e3", "3000000000"], "double"),
    (["2020-01-31"], "date"), (["2020-01-31", "2020-01-31 10:00:00"], "timestamp"), (["2020-02-31"], "string"),
    (["true", "FALSE"], "boolean"), (["true", "1"], "string"), (["1", "2020-01-31"], "string"), ([None, ""], "string"),
    (["1", "x"], "string"), (["1" * 30], "double"), (["NaN"], "string"), ([" 7 "], "int"), ([".5", "5."], "double")])
def test_types(spark, values, name):
    df = spark.createDataFrame([(v,) for v in values], "c string")
    assert Y.found_types(df) == {"c": name}
    cast = [r["c"] for r in Y.narrowed(df).collect()]
    assert all((v is None or not v.strip() and name != "string") == (c is None) for v, c in zip(values, cast))


def test_types_that_clash_over_files(spark, tmp_path):
    write(tmp_path, {"a.csv": "id,n,day\n1,1,2020-01-01\n", "b.csv": "n,id,day\n2.5,x7,2020-01-02\n", "c.csv": "day,id,n\nsoon,3000000000,\n"})
    df, got = csv_rows(spark, str(tmp_path), ("id", "n", "day"), infer=True)
    assert {c: t for c, t in df.dtypes if c in ("id", "n", "day")} == {"id": "string", "n": "double", "day": "string"}
    assert sorted((r["id"], r["n"], r["day"]) for r in got) == [
        ("1", 1.0, "2020-01-01"), ("3000000000", None, "soon"), ("x7", 2.5, "2020-01-02")]
    text, _ = csv_rows(spark, str(tmp_path), ("id", "n", "day"))
    kinds = {(r["file"].rsplit("/", 1)[1], r["column"]): Y.type_of(r["kinds"]) for r in Y.kinds_by_file(text).collect()}
    assert kinds["a.csv", "id"] == "int" and kinds["c.csv", "id"] == "bigint" and kinds["b.csv", "id"] == "string"


# --- JSON -------------------------------------------------------------------
def test_json_lines_in_one_pass(spark, tmp_path):
    rows = ['{"id":1,"x":1.50,"more":{"a":[1,2]}}', '{"ID":"2","x":null}', '{"id":1e5,"x":true,"y":null}', '{"x":[1, 2],"id":"a\\"b"}',
            '{"id":123456789012345678901.25,"x":"1.0"}', '{"in":{"x":7.0},"x":0.10,"id":"in"}', "", '{"id":9', "[1]", '"text"']
    write(tmp_path, {"a.json": "\n".join(rows) + "\n"})
    df = ingest(spark, Source("t", "json", "*.json", ("id", "x"), options={"multiLine": "false"}), str(tmp_path))
    got = sorted(((r["id"], r["x"], r["_rescued_data"]) for r in df.collect()), key=repr)
    assert got == sorted([
        ("1", "1.50", '{"more":"{\\"a\\":[1,2]}"}'), ("2", None, None), ("1e5", "true", None), ('a"b', "[1,2]", None),
        ("123456789012345678901.25", "1.0", None), ("in", "0.10", '{"in":"{\\"x\\":7.0}"}'),
        (None, None, '{"_corrupt_record":"{\\"id\\":9"}'), (None, None, '{"_corrupt_record":"[1]"}'),
        (None, None, '{"_corrupt_record":"\\"text\\""}')], key=repr)


def test_json_arrays(spark, tmp_path):
    write(tmp_path, {"a.json": '[{"id":1,"x":1.50,"more":2},\n{"id":2}]', "b.json": '{"id":9}'})
    df = ingest(spark, Source("t", "json", "*.json", ("id", "x", "y")), str(tmp_path))
    assert sorted((r["id"], r["x"], r["y"], r["_rescued_data"]) for r in df.collect()) == [
        ("1", "1.50", None, '{"more":"2"}'), ("2", None, None, None), ("9", None, None, None)]


def test_json_files_as_a_whole(spark, tmp_path):
    """Any layout and encoding; broken, empty and single-object files."""
    pretty = '[\n  {"id": 1,\n   "x": 1.50},\r\n\n {"id": 1e5, "x": "a\\nb"}\n]\n'
    write(tmp_path, {"a.json": pretty, "b.json": '{"id":9,"x":0.10}', "c.json": "", "d.json": " \n", "e.json": '[{"id":7}, {"id"', "f.json": "[]"})
    for name, code in (("g.json", "utf-16-le"), ("h.json", "utf-32-be"), ("i.json", "utf-8-sig")):
        number = "-2.00" if code == "utf-8-sig" else '"-2.00"'
        (tmp_path / name).write_bytes(f'[{{"id":"\u0100\U00010000"}},\n{{"id":{number}}}]'.encode(code))
    df = ingest(spark, Source("t", "json", "*.json", ("id", "x")), str(tmp_path))
    got = Counter((r["id"], r["x"]) for r in df.collect() if r["_source_file"][-6:] != "e.json")
    assert got == Counter([("1", "1.50"), ("1e5", "a\nb"), ("9", "0.10")] + 3 * [("\u0100\U00010000", None), ("-2.00", None)])
    broken = [r["_rescued_data"] for r in df.collect() if r["_source_file"][-6:] == "e.json"]
    assert any("_corrupt_record" in (r or "") for r in broken)


def test_numbers_of_json_arrays_without_a_read_for_each(spark, tmp_path):
    """60,000 numbers in a file with a checksum beside it took a read each, 15 s and more."""
    rows = spark.range(30_000, numPartitions=1).select(F.to_json(F.struct("id", (F.col("id") / 8).cast("decimal(20,3)").alias("x"))).alias("j"))
    rows.agg(F.concat(F.lit("["), F.array_join(F.collect_list("j"), ","), F.lit("]"))).write.text(str(tmp_path / "a"))
    start = time.time()
    df = ingest(spark, Source("t", "json", "*.txt", ("id", "x")), str(tmp_path / "a"))
    assert df.filter("x = cast(cast(id as bigint) / 8 as decimal(20,3)) and x like '%.___'").count() == 30_000
    assert time.time() - start < 8


# --- schema log -------------------------------------------------------------
def test_schema_log(spark, tmp_path):
    from pyspark.sql import types as T
    from assayline.sources import schema_log

    def schema(*names, kind=T.StringType()):
        return T.StructType([T.StructField(n, kind) for n in names])
    log = str(tmp_path / "log")
    assert len(schema_log.current(spark, log)) == 0
    schema_log.extend(spark, log, 0, schema("b", "a"))
    schema_log.extend(spark, log, 1, schema("A", "b"))
    assert not (tmp_path / "log" / "entry=1").exists()
    for _ in range(2):  # a batch that is run again
        assert schema_log.extend(spark, log, 2, schema("c", "a", "D")).names == ["b", "a", "c", "D"]
    assert schema_log.current(spark, log, before=2).names == ["b", "a"]
    assert schema_log.entries(spark, log).count() == 4
    with pytest.raises(ValueError):
        schema_log.extend(spark, log, 3, schema("a", kind=T.IntegerType()))


def test_reader_takes_the_schema_from_the_log(spark, tmp_path):
    from assayline.streaming import jobs
    src, out, mark = (f"{tmp_path}/{n}" for n in ("src", "out", "mark"))
    for i, text in enumerate(("a,b\n1,2\n", "b,c\n3,4\n", "d\n5\n")):
        write(src, {f"{i}.csv": text})
        jobs.bronze(spark, Source("t", "csv", "*.csv"), src, out, mark).awaitTermination()
    df = jobs.read_bronze(spark, out, mark)
    assert "mergeSchema" not in df._jdf.queryExecution().toString()
    assert sorted((r["a"], r["b"], r["c"], r["d"]) for r in df.collect() if r["a"]) == [("1", "2", None, None)]
    assert df.count() == 3 and df.filter("d = '5'").count() == 1 and df.filter("c = '4'").count() == 1
