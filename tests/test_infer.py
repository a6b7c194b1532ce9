from pyspark.sql import functions as F

from quarry.sources import infer


def _write(tmp_path, text):
    (tmp_path / "f.csv").write_text(text)
    return str(tmp_path / "f.csv")


def test_types_of_a_file_with_gaps(spark, tmp_path):
    path = _write(tmp_path, "a;b;c;d;e;f;g\n1;1;True;x;;-3;1\nNA; 2.5;FALSE;7;nan;;true\n-4;1e3;NULL;n/a;null;99999999999999999999;0\n")
    got = infer.read_csv_inferred(spark, path, sep=";")
    assert [t for _, t in got.dtypes] == ["bigint", "double", "boolean", "string", "double", "string", "string"]
    assert [tuple(r) for r in got.orderBy(F.col("a").asc_nulls_last()).collect()] == [
        (-4, 1000.0, None, None, None, "99999999999999999999", "0"),
        (1, 1.0, True, "x", None, "-3", "1"),
        (None, 2.5, False, "7", None, None, "true")]


def test_kinds_widen_in_any_order(spark, tmp_path):
    cases = {"1,2": "bigint", "1,2.0": "double", "2.0,1": "double", "true,1": "string", "true,False": "boolean",
             "1,x": "string", "inf,-Infinity": "double", ".5,5.": "double", "1.0d,2": "string", "NA,": "double",
             "9223372036854775807,1": "bigint", "9223372036854775808,1": "string", "0x10,1": "string", "+7,-7": "bigint"}
    for values, want in cases.items():
        path = _write(tmp_path, "k,v\n" + "".join(f"0,{v}\n" for v in values.split(",")))
        assert infer.infer_schema(infer.scan_text(spark, path))["v"].dataType.simpleString() == want, values


def test_a_file_without_rows_and_a_dotted_name(spark, tmp_path):
    got = infer.read_csv_inferred(spark, _write(tmp_path, "a,b\n"))
    assert got.dtypes == [("a", "double"), ("b", "double")] and got.count() == 0
    dotted = infer.scan_text(spark, _write(tmp_path, "a.b,c\n1,2\n"))
    assert infer.infer_schema(dotted)["a.b"].dataType.simpleString() == "bigint"


def test_types_come_from_one_aggregate(spark, tmp_path):
    path = _write(tmp_path, "a,b\n1,NA\n2,x\n")
    rows = {r.column_name: (r.data_type, r.n_rows, r.n_missing) for r in infer.type_report(infer.scan_text(spark, path)).collect()}
    assert rows == {"a": ("bigint", 2, 0), "b": ("string", 2, 1)}
