"""Cleaning and typing (P1-P14, F1-F2), restating the reference's unit cases."""

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType

from binscope.operators import clean as C
from binscope.operators import profile as A


def test_clean_dataframe_reference_case(spark):
    df = spark.createDataFrame(
        [("2,300", "", "..", 60), ("-200", "400", "-9..", 20), ("-2,450", "--", "-400", -90)],
        "col1 string, col2 string, col3 string, col4 int")
    out = C.clean_dataframe(df, ["col1"])
    types = {f.name: f.dataType for f in out.schema.fields}
    assert isinstance(types["col1"], LongType)          # all integers -> int
    assert isinstance(types["col2"], DoubleType)        # missing values -> float
    rows = out.orderBy("col4").collect()
    assert sum(r["col3"] is None for r in rows) == 2
    assert [r["col1"] for r in out.orderBy(F.desc("col4")).collect()][0] == 2300


def _probe(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    return C.infer_numeric(df)


def test_safe_to_numeric_mixed_stays_text(spark):
    out = _probe(spark, ["1", "2", "three", "4.5", "NaN"])
    assert isinstance(out.schema["x"].dataType, StringType)
    assert [r.x for r in out.collect()] == ["1", "2", "three", "4.5", "NaN"]


def test_safe_to_numeric_with_missing_is_double(spark):
    out = _probe(spark, ["1", "2", None, "4.5"])
    assert isinstance(out.schema["x"].dataType, DoubleType)
    assert sorted([r.x for r in out.collect()], key=lambda v: (v is None, v)) == [1.0, 2.0, 4.5, None]


def test_safe_to_numeric_invalid_and_pandas_rejects(spark):
    for vals in (["apple", "banana"], ["1", "NaN"], ["5d"], ["1f"], ["1,000"], [" "], ["0x10"]):
        assert isinstance(_probe(spark, vals).schema["x"].dataType, StringType), vals


def test_safe_to_numeric_accepts_pandas_shapes(spark):
    out = _probe(spark, [" 12 ", "+5", "1.", ".5", "1e3", "inf", "Infinity"])
    assert isinstance(out.schema["x"].dataType, DoubleType)
    vals = [r.x for r in out.collect()]
    assert vals[:5] == [12.0, 5.0, 1.0, 0.5, 1000.0] and vals[5] == float("inf")


def test_safe_to_numeric_empty_and_boolean(spark):
    empty = spark.createDataFrame([], "x string")
    assert C.infer_numeric(empty).count() == 0
    b = spark.createDataFrame([(True,), (False,)], "b boolean")
    assert C.infer_numeric(b).schema["b"].dataType.simpleString() == "boolean"
    assert C.numeric_columns(b) == []


def test_nullify_tokens(spark):
    df = spark.createDataFrame([("",), ("--",), ("a---b",), ("x..y",), ("-",), (".",), (" ",),
                                (None,), ("ok",)], "t string")
    got = [r.t for r in C.nullify_tokens(df).collect()]
    assert got == [None, None, None, None, "-", ".", " ", None, "ok"]


def test_top_n_reference_cases(spark):
    fruit = ["apple", "banana", "apple", "cherry", "apple", "banana", "banana", "cherry",
             "cherry", "cherry", "date", "fig"]
    df = spark.createDataFrame([(v,) for v in fruit], "v string")
    assert {r.value for r in A.top_n(df, "v", 3).collect()} == {"apple", "banana", "cherry"}
    small = spark.createDataFrame([("grape",), ("melon",), ("kiwi",)], "v string")
    assert {r.value for r in A.top_n(small, "v", 5).collect()} == {"grape", "melon", "kiwi"}
    assert A.top_n(spark.createDataFrame([], "v string"), "v", 3).count() == 0


def test_bucket_rare_keeps_null(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), ("c",), (None,)], "v string")
    keep = C.bucket_rare_fit(df, "v", 1)
    got = [r.v for r in C.bucket_rare_apply(df, "v", keep).collect()]
    assert got == ["a", "a", "other", "other", None]


def test_encode_label(spark):
    df = spark.createDataFrame([(">50K",), (">50K.",), ("<=50K..",), ("<=50K",), ("x",), (None,)],
                               "income string")
    assert [r.y for r in C.encode_label(df, "income", "y").collect()] == [1, 1, 0, 0, None, None]


def test_fill_missing_type_checked(spark):
    df = spark.createDataFrame([(1.0, "a"), (None, None)], "x double, s string")
    assert C.fill_missing(df, ["x"], None).collect() == df.collect()
    assert [r.x for r in C.fill_missing(df, ["x"], 0.0).collect()] == [1.0, 0.0]
    import pytest
    with pytest.raises(TypeError):
        C.fill_missing(df, ["s"], 0.0)


def test_sparse_row_filter_keeps_missing_gain(spark):
    df = spark.createDataFrame(
        [(1, 0.0, None, None), (2, None, None, None), (3, 0.0, 1.0, None), (4, 5.0, None, None)],
        "k int, `capital-gain` double, a double, b double")
    kept = sorted(r.k for r in C.filter_sparse_rows(df, key="k").collect())
    assert kept == [2, 3, 4]      # row 1: gain 0 and 2/3 missing; row 2: gain missing -> kept
    frac = {r.k: r.percentage_missing for r in C.row_missing_fraction(df, key="k").collect()}
    assert abs(frac[2] - 1.0) < 1e-12 and abs(frac[3] - 1 / 3) < 1e-12


def test_columns_by_pattern_and_missing_indicators(spark):
    cols = ["DaystoX", "A_HCC", "HCC_1", "CCS2", "x_CCS", "other"]
    assert C.columns_by_pattern(cols) == ["CCS2", "DaystoX", "HCC_1"]
    df = spark.createDataFrame([(1, None, "a")], "k int, x double, s string")
    out = C.missing_indicators(df, key="k")
    assert out.columns == ["k", "x", "s", "x_missing", "s_missing"]
    assert out.collect()[0]["x_missing"] == 1


def test_add_ids_unique_and_9_digits(spark, small_dir):
    cu = spark.read.parquet(f"{small_dir}/customer.parquet").select("c_custkey")
    ids = [r.census_id for r in C.add_ids(cu, "c_custkey").collect()]
    assert len(ids) == len(set(ids)) == cu.count()
    assert all(10 ** 8 <= i < 10 ** 9 for i in ids)


def test_compare_tables_reference_cases(spark):
    a = spark.createDataFrame([(1, 4), (2, 5), (3, 6)], "A long, B long")
    assert A.compare_tables(a, a)[0] == "equal"
    assert A.compare_tables(a, a.limit(2))[0] == "shape"
    assert A.compare_tables(a, a.withColumnRenamed("B", "C"))[0] == "columns"
    assert A.compare_tables(a, a.withColumn("B", F.col("B").cast("double")))[0] == "types"
    b = spark.createDataFrame([(1, 4), (2, 5), (3, 9)], "A long, B long")
    verdict, cells = A.compare_tables(a, b, key="A")
    assert verdict == "content"
    assert [(r.A, r.column, r.left, r.right) for r in cells.collect()] == [(3, "B", "6", "9")]
    assert A.compare_tables(a, b)[0] == "content"


def test_compare_tables_reads_only_buckets_that_differ(spark):
    rows = [(i, None if i % 7 == 0 else f"v{i}", None if i % 5 == 0 else f"v{i}", float("nan") if i % 11 == 0 else -0.0 if i % 2 else i / 3) for i in range(3000)]
    shape = "id long, x string, y string, z double"
    a = spark.createDataFrame(rows, shape)
    shuffled = spark.createDataFrame([(i, x, y, 0.0 if z == 0 else z) for i, x, y, z in reversed(rows)], shape)
    assert A.compare_tables(a, shuffled)[0] == A.compare_tables(a, shuffled, key="id")[0] == "equal"
    assert A.compare_tables(a, shuffled, key="id")[1].columns == ["id", "column", "left", "right"]
    swapped = spark.createDataFrame([(i, y, x, z) if i == 35 * 20 + 7 else (i, x, y, z) for i, x, y, z in rows], shape)  # x null, y not
    verdict, cells = A.compare_tables(a, swapped, key="id")
    assert verdict == "content" and sorted(tuple(r) for r in cells.collect()) == [(707, "x", None, "v707"), (707, "y", "v707", None)]
    assert A.compare_tables(a, swapped)[1].count() == 2
    # as multisets: the same rows in other numbers
    twice = lambda i, j: spark.createDataFrame([(i, "a"), (i, "a"), (j, "b"), (j, "b")], "id long, x string")
    assert A.compare_tables(twice(1, 2), spark.createDataFrame([(1, "a"), (1, "a"), (1, "a"), (2, "b")], "id long, x string"))[0] == "content"
    empty = a.where("false")
    assert A.compare_tables(empty, empty)[0] == A.compare_tables(empty, empty, key="id")[0] == "equal"
