import datetime as dt

from pyspark.sql import functions as F

from aerolake.functions import coerce, dates, labels, messages


def test_delay_class_edges(spark):
    df = spark.createDataFrame([(x,) for x in [-100.0, -15.01, -15.0, -0.5, 0.0, 29.9, 30.0, 500.0, None]],
                               "d double")
    got = [r[0] for r in df.select(labels.delay_class("d")).collect()]
    assert got == [0.0, 0.0, 1.0, 1.0, 2.0, 2.0, 3.0, 3.0, None]


def test_delay_class_matches_bucketizer(spark):
    from pyspark.ml.feature import Bucketizer
    vals = [(float(x),) for x in range(-60, 61, 3)]
    df = spark.createDataFrame(vals, "d double")
    b = Bucketizer(splits=labels.DELAY_SPLITS, inputCol="d", outputCol="b").transform(df)
    rows = b.select("b", labels.delay_class("d").alias("c")).collect()
    assert all(r.b == r.c for r in rows)


def test_prediction_label_all_branches(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (2.0,), (3.0,), (None,), (4.0,), (2.5,)], "p double")
    got = [r[0] for r in df.select(labels.prediction_label("p")).collect()]
    assert got[:4] == [labels.CLASS_TEXT[i] for i in range(4)]
    assert got[4] == labels.MISSING_TEXT
    assert got[5] == "Unknown prediction value: 4"
    assert got[6] == "Unknown prediction value: 2.5"


def test_prediction_label_text_input(spark):
    df = spark.createDataFrame([("0",), ("3",), ("x",)], "p string")
    got = [r[0] for r in df.select(labels.prediction_label("p")).collect()]
    assert got == [labels.CLASS_TEXT[0], labels.CLASS_TEXT[3], "Unknown prediction value: x"]


def test_coerce_like_python(spark):
    texts = ["5", "5.0", " 5 ", "abc", "", "1e3", None, "-7"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select(coerce.try_int("t").alias("i"), coerce.try_double("t").alias("f")).collect()

    def py(fn, t):
        try:
            return fn(t)
        except (TypeError, ValueError):
            return None
    assert [r.i for r in rows] == [py(int, t) for t in texts]
    assert [r.f for r in rows] == [py(float, t) for t in texts]


def test_numbers_with_suffixes_and_odd_space(spark):
    texts = ["1d", "1f", "1D", "\t5", "5\n", " \x0b7", "nan", "+inf", "-Infinity", "1e400", ".5", "5.", "1e", "0x1", "\u00a06"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select(coerce.try_int("t").alias("i"), coerce.try_double("t").alias("f")).collect()

    def py(fn, t):
        try:
            return fn(t)
        except ValueError:
            return None
    ascii_texts = [(t, r) for t, r in zip(texts, rows) if t.isascii()]
    assert [r.i for _, r in ascii_texts] == [py(int, t) for t, _ in ascii_texts]
    assert [str(r.f) for _, r in ascii_texts] == [str(py(float, t)) for t, _ in ascii_texts]


def test_iso_day_is_the_day_as_written(spark):
    df = spark.createDataFrame([("2016-12-25T23:30:00-05:00",), ("2016-12-25T00:10:00+09:00",), ("2016-12-25",), ("2016-12-25 10:00:00",), ("2016-13-01",), ("x",)], "s string")
    day = dt.date(2016, 12, 25)
    assert [r.d for r in df.select(dates.iso_day("s").alias("d")).collect()] == [day] * 4 + [None] * 2


def test_date_parts_weekday_monday_zero(spark):
    df = spark.createDataFrame([(dt.date(2016, 12, 25),), (dt.date(2024, 1, 1),)], "d date")
    rows = df.select(*[c.alias(n) for n, c in dates.date_parts("d").items()]).collect()
    for r, d in zip(rows, [dt.date(2016, 12, 25), dt.date(2024, 1, 1)]):
        assert r.DayOfWeek == d.weekday()
        assert r.DayOfYear == d.timetuple().tm_yday
        assert r.DayOfMonth == d.day


def test_day_after(spark):
    df = spark.createDataFrame([("2024-01-31T10:00:00",), ("2016-12-25",), ("junk",)], "s string")
    rows = df.select(dates.iso_day("s").alias("d"), dates.day_after("s").alias("n")).collect()
    assert rows[0].d == dt.date(2024, 1, 31) and rows[0].n == dt.date(2024, 2, 1)
    assert rows[1].n == dt.date(2016, 12, 26)
    assert rows[2].d is None


def test_parse_request_malformed(spark):
    df = spark.createDataFrame([('{"Origin":"ATL","DepDelay":5.0,"FlightDate":"2016-12-25"}',),
                                ('{"Origin":"ATL","DepDelay":5.0',), ("not json",)], "value string")
    rows = df.select(messages.parse_request("value").alias("f")).select("f.*").collect()
    assert rows[0].Origin == "ATL" and rows[0].DepDelay == 5.0 and rows[0]._corrupt_record is None
    assert rows[1].Origin is None and rows[1]._corrupt_record is not None
    assert rows[2].Origin is None and rows[2]._corrupt_record == "not json"


def test_to_message_drops_nulls(spark):
    df = spark.createDataFrame([("a", None)], "x string, y double")
    assert df.select(messages.to_message("x", "y")).first()[0] == '{"x":"a"}'


def test_message_text_cast(spark):
    df = spark.createDataFrame([(bytearray(b'{"a":1}'),)], "value binary")
    assert df.select(messages.message_text("value")).first()[0] == '{"a":1}'


def test_message_time_stamp_keeps_microseconds(spark):
    import datetime as dt
    from aerolake import schemas
    ts = dt.datetime(2024, 1, 1, 0, 0, 7, 179575)
    df = spark.createDataFrame([("u1", ts)], "UUID string, Timestamp timestamp")
    text = df.select(messages.to_message("UUID", "Timestamp").alias("v"))
    back = text.select(F.from_json("v", schemas.REQUEST).alias("m")).select("m.Timestamp").first()[0]
    assert back == ts


def test_first_of_several_replies_in_topic_order(spark):
    from aerolake.operators import requests as rq

    rows = [("k", '{"UUID":"u","n":3}', 0, 3), ("k", '{"UUID":"u","n":1}', 0, 1), ("k", '["u"]', 0, 0), ("k", '{"UUID":"v"}', 0, 0), ("k", "broken", 0, 0), ("k", None, 0, 0)]
    msgs = spark.createDataFrame(rows, "key string, value string, partition int, offset long")
    assert [r["offset"] for r in rq.response_lookup(msgs, "u", order=["partition", "offset"]).collect()] == [1]
    assert rq.response_lookup(msgs, "w", order=["offset"]).count() == 0
    assert rq.response_lookup(msgs, "u").count() == 1
