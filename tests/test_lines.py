"""The parser table, line by line, plus formatting."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from tidemark.functions.lines import format_lines, parse_lines, reject_reason
from tidemark.spec import GENDER_ROW, SCORE_ROW

# (line, expected (id, text) or reject reason) for the (int, string) parser
TEXT_CASES = [
    ("1, male", (1, " male")),
    ("6,a,b", (6, "a")),
    ("+5,z", (5, "z")),
    ("8,,x", (8, "")),
    ("-3,q", (-3, "q")),
    ("007,k", (7, "k")),
    ("2147483647,max", (2147483647, "max")),
    ("-2147483648,min", (-2147483648, "min")),
    ("7", "missing_field"),
    ("8,", "missing_field"),
    ("8,,", "missing_field"),
    ("x, male", "bad_int"),
    (",q", "bad_int"),
    (" 1,a", "bad_int"),
    ("1 ,a", "bad_int"),
    (",", "bad_int"),
    ("", "bad_int"),
    ("x", "bad_int"),
    ("+,a", "bad_int"),
    ("3000000000,a", "bad_int"),
    ("2147483648,a", "bad_int"),
    ("1.5,a", "bad_int"),
    (None, "bad_int"),
]

INT_CASES = [
    ("1,87", (1, 87)),
    ("1,87,", (1, 87)),
    ("1,87,9", (1, 87)),
    ("4, 9", "bad_int"),
    ("4,9 ", "bad_int"),
    ("4", "missing_field"),
    ("4,", "missing_field"),
    ("x,9", "bad_int"),
    ("4,x", "bad_int"),
    ("4,3000000000", "bad_int"),
]


def _lines(spark, cases):
    return spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "pos long, value string")


@pytest.mark.parametrize("schema,cases", [(GENDER_ROW, TEXT_CASES), (SCORE_ROW, INT_CASES)])
def test_parse_table(spark, schema, cases):
    good, bad = parse_lines(_lines(spark, cases), schema, on_bad="divert", keep=("pos",))
    got_good = {r.pos: tuple(r)[1:] for r in good.collect()}
    got_bad = {r.pos: r.reason for r in bad.collect()}
    for i, (line, want) in enumerate(cases):
        if isinstance(want, tuple):
            assert got_good.get(i) == want, (line, got_good.get(i), got_bad.get(i))
        else:
            assert got_bad.get(i) == want, (line, got_good.get(i), got_bad.get(i))
    assert len(got_good) + len(got_bad) == len(cases)


def test_output_types(spark):
    good, _ = parse_lines(_lines(spark, TEXT_CASES), GENDER_ROW, on_bad="divert")
    assert [f.dataType for f in good.schema.fields] == [IntegerType(), StringType()]


def test_fail_mode_raises_on_first_bad_line(spark):
    df = _lines(spark, [("1,a", None), ("x,b", None)])
    with pytest.raises(Exception, match="bad record"):
        parse_lines(df, GENDER_ROW, on_bad="fail").collect()
    ok = parse_lines(_lines(spark, [("1,a", None)]), GENDER_ROW, on_bad="fail").collect()
    assert [tuple(r) for r in ok] == [(1, "a")]


def test_drop_mode_and_trim(spark):
    df = _lines(spark, [("1, male", None), ("bad", None)])
    rows = parse_lines(df, GENDER_ROW, on_bad="drop", trim=True).collect()
    assert [tuple(r) for r in rows] == [(1, "male")]


def test_reject_reason_column(spark):
    df = _lines(spark, [("1,a", None), ("1", None), ("q,1", None)])
    got = [r[0] for r in df.select(reject_reason(F.col("value"), GENDER_ROW)).orderBy("pos").collect()]
    assert got == [None, "missing_field", "bad_int"]


def test_other_separator(spark):
    schema = StructType([StructField("id", IntegerType()), StructField("t", StringType())])
    df = spark.createDataFrame([("3|x|",), ("4.5|y",)], "value string")
    good, bad = parse_lines(df, schema, on_bad="divert", sep="|")
    assert [tuple(r) for r in good.collect()] == [(3, "x")]
    assert [r.reason for r in bad.collect()] == ["bad_int"]


def test_format_lines(spark):
    df = spark.createDataFrame([(1, "male", 87), (2, None, 0)], "id int, gender string, score int")
    assert [r.value for r in format_lines(df, "id", "gender", ", ").collect()] == ["1, male", "2, null"]
    assert [r.value for r in format_lines(df, "id", "score", ",").collect()] == ["1,87", "2,0"]


def test_format_then_parse_round_trip(spark):
    df = spark.range(1, 200).select(F.col("id").cast("int").alias("id"),
                                    F.concat(F.lit("n"), F.col("id").cast("string")).alias("gender"))
    back = parse_lines(format_lines(df, "id", "gender", ","), GENDER_ROW, on_bad="fail")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


# ---------------------------------------------------------------- property test against a model

INT_MIN, INT_MAX = -2**31, 2**31 - 1


def _split_model(s):
    """String.split(","): inner and leading empties kept, trailing empties dropped."""
    if s == "":
        return [""]
    parts = s.split(",")
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def _int_model(t):
    """Integer.parseInt over ASCII: optional sign, at least one digit, 32-bit range; None if it throws."""
    body = t[1:] if t[:1] in ("+", "-") else t
    if not body or not body.isascii() or not body.isdigit():
        return None
    v = int(t)
    return v if INT_MIN <= v <= INT_MAX else None


def _parse_model(line, second_is_int):
    """(id, value) or a reject reason, fields checked left to right."""
    parts = _split_model(line)
    first = _int_model(parts[0]) if parts else None
    if first is None:
        return "bad_int"
    if len(parts) < 2:
        return "missing_field"
    if second_is_int:
        second = _int_model(parts[1])
        return "bad_int" if second is None else (first, second)
    return (first, parts[1])


def _random_lines(seed, n=400):
    import random
    rnd = random.Random(seed)
    alphabet = "0123456789,,,+- ax"
    lines = ["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(0, 9))) for _ in range(n)]
    lines += ["2147483647,1", "2147483648,1", "-2147483648,x", "-2147483649,x", "1,2147483648", "+0,-0"]
    return lines


@pytest.mark.parametrize("schema,second_is_int", [(GENDER_ROW, False), (SCORE_ROW, True)])
def test_parser_matches_split_and_parse_model(spark, schema, second_is_int):
    lines = _random_lines(7 if second_is_int else 3)
    df = spark.createDataFrame(list(enumerate(lines)), "pos long, value string")
    good, bad = parse_lines(df, schema, on_bad="divert", keep=("pos",))
    got = {r.pos: (r[1], r[2]) for r in good.collect()}
    got.update({r.pos: r.reason for r in bad.collect()})
    for pos, line in enumerate(lines):
        assert got[pos] == _parse_model(line, second_is_int), repr(line)
