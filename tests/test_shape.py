import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions import cells, names, schedule
from tidemark.functions.text import epoch_millis, guid_text, instant, iso_text
from tidemark.operators import envelope as env
from tidemark.operators import shape

GUID = "ba4afc12-f6dc-4394-b9d5-68f6dacf3b3b"


def value(spark, column):
    return spark.range(1).select(column).first()[0]


def expand(spark, pattern):
    return value(
        spark,
        names.expand_pattern(
            pattern, F.lit(GUID), F.lit("CustomerRecord"), instant("2024-07-05 03:03:55.123456"), F.lit("parquet")
        ),
    )


@pytest.mark.parametrize(
    ("pattern", "name"),
    [
        ("{StreamId:N}_{DataTime:yyyyMMddHHmmss}.{OutputFormat}", "ba4afc12f6dc4394b9d568f6dacf3b3b_20240705030355.parquet"),
        ("{StreamId}_{DataTime}.{OutputFormat:ToUpper}", GUID + "_2024-07-05T03:03:55.1234560+00:00.PARQUET"),
        ("{ContainerName}_{DataTime:yyyyMMddHHmmss}.{OutputFormat}", "CustomerRecord_20240705030355.parquet"),
        ("{ContainerName:ToUpper}{OutputFormat:TOLOWERINVARIANT}", "CustomerRecordparquet"),
        ("{StreamId:B}{StreamId:P}", "{" + GUID + "}(" + GUID + ")"),
        ("{DataTime:yyyy-MM-ddTHH.mm.ss.fff}", "2024-07-05T03.03.55.123"),
        ("{DataTime:ddd_MMM_tt}", "Fri_Jul_AM"),
        ("plain", "plain"),
        ("{Unknown}_{DataTime:s}", "{Unknown}_2024-07-05T03:03:55"),
    ],
)
def test_patterns(spark, pattern, name):
    assert expand(spark, pattern) == name


@pytest.mark.parametrize("pattern", ["{OutputFormat:Title}", "{StreamId:Q}", "{DataTime:q}", "{DataTime:FFF}"])
def test_patterns_that_mean_nothing_are_errors(spark, pattern):
    with pytest.raises(ValueError):
        expand(spark, pattern)


def test_iso_text_and_epoch(spark):
    t = instant("2024-08-20 22:16:00")
    assert value(spark, iso_text(t)) == "2024-08-20T22:16:00.0000000+00:00"
    assert value(spark, iso_text(t, "+05:00")) == "2024-08-21T03:16:00.0000000+05:00"
    assert value(spark, epoch_millis(t)) == 1724192160000


def test_guid_forms(spark):
    assert value(spark, guid_text(F.lit("{" + GUID.upper() + "}"), "D")) == GUID
    assert value(spark, guid_text(F.lit("no guid"), "N")) == "no guid"


def test_json_times(spark):
    for text, want in (
        ("2000-01-02 03:04:05", "2000-01-02T03:04:05"),
        ("2000-01-02 03:04:00", "2000-01-02T03:04:00"),
        ("2000-01-02 03:04:05.120000", "2000-01-02T03:04:05.12"),
    ):
        assert value(spark, cells.json_time(instant(text))) == want


@pytest.mark.parametrize(
    ("text", "kind"),
    [('{"a": 1}', "object"), (" [1, 2]", "array"), ("[1, 2", "text"), ("12", "text"), ("", "text"),
     ('"x"', "text"), ("plain", "text"), (None, None), ("{not json}", "text")],
)
def test_json_kind(spark, text, kind):
    assert value(spark, cells.json_kind(F.lit(text).cast("string"))) == kind


def test_null_columns_types_and_names():
    assert cells.column_type("Nullable<int>") == "int"
    assert cells.column_type("byte") == "smallint"
    assert cells.column_type("ushort") == "string"
    assert cells.column_type("decimal(18,2)?") == "decimal(18,2)"


def test_escaped_names_must_differ(spark):
    df = spark.range(1).select(F.lit(1).alias("user.age"), F.lit(2).alias("User_Age"))
    with pytest.raises(ValueError, match="user.age.*User_Age"):
        shape.escape_columns(df)
    assert shape.escape_columns(df.select("`user.age`")).columns == ["user_age"]


def test_marker_goes_last_and_initial_export_skips_removed(spark):
    df = spark.createDataFrame(
        [("1", "Removed", "x"), ("2", "Changed", "y"), ("3", None, "z")], "Id string, __ChangeType__ string, a string"
    )
    marked = shape.row_marker(df, first=False)
    assert marked.columns == ["Id", "a", "__rowMarker__"]
    assert [r[2] for r in marked.orderBy("Id").collect()] == ["2", "4", "4"]
    kept = shape.skip_removed(df, delta_mode=True, initial=True)
    assert [r[0] for r in kept.orderBy("Id").collect()] == ["2", "3"]
    assert shape.skip_removed(df, delta_mode=True, initial=False).count() == 3


def test_columns_are_ordered_with_the_id_first(spark):
    df = spark.range(1).select(F.lit(1).alias("b"), F.lit(1).alias("Id"), F.lit(1).alias("a.x"))
    assert env.order_columns(df).columns == ["Id", "a.x", "b"]


def test_every_field_is_nullable(spark):
    df = spark.range(3).select("id", F.lit("x").alias("a.b"))
    assert not df.schema["id"].nullable
    out = shape.nullable_schema(df)
    assert all(f.nullable for f in out.schema.fields) and out.count() == 3


@pytest.mark.parametrize(
    ("name", "ts", "previous", "following"),
    [
        ("Hourly", "2024-08-21 03:16:00", (21, 3), (21, 4)),
        ("Hourly", "2024-08-21 03:00:00", (21, 2), (21, 4)),
        ("daily", "2024-08-21 00:00:00", (20, 0), (22, 0)),
        ("WEEKLY", "2024-08-21 03:16:00", (19, 0), (26, 0)),
        ("Weekly", "2024-08-19 00:00:00", (12, 0), (26, 0)),
    ],
)
def test_schedule(spark, name, ts, previous, following):
    assert value(spark, schedule.previous_instant(instant(ts), name)) == dt.datetime(2024, 8, *previous)
    assert value(spark, schedule.next_instant(instant(ts), name)) == dt.datetime(2024, 8, *following)


def test_never_has_no_instants(spark):
    assert value(spark, schedule.next_instant(instant("2024-08-21 03:16:00"), "Never")) is None
    with pytest.raises(ValueError):
        schedule.next_instant(instant("2024-08-21 03:16:00"), "Yearly")


def test_text_that_does_not_parse_is_set_aside(spark):
    rows = [(1, "7", "2024-01-02"), (2, "x", None), (3, None, "soon"), (4, "7.5.1", "never"), (5, None, None)]
    df = spark.createDataFrame(rows, "k int, `a.n` string, t string")
    fits, aside = env.split_unparsed(env.parse_types(df, {"a.n": "int", "t": "DateTime"}))
    assert [(r["k"], r["a.n"], r["t"]) for r in fits.orderBy("k").collect()] == [(1, 7, dt.datetime(2024, 1, 2)), (5, None, None)]
    got = {r["k"]: (r["unparsed"], r["as_given"]) for r in aside.collect()}
    assert got == {2: (["a.n"], '{"a.n":"x"}'), 3: (["t"], '{"t":"soon"}'), 4: (["a.n", "t"], '{"a.n":"7.5.1","t":"never"}')}
    assert fits.columns == df.columns and env.parse_types(df.limit(0), {"t": "DateTime"}).count() == 0
