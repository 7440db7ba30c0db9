import pytest
from pyspark.sql import functions as F

from staypath.functions import columns as C
from staypath.schema import DAY_PARTS
from tests.conftest import DAY, START


def value(spark, column, **fields):
    types = {str: "string", int: "bigint", float: "double", type(None): "string"}
    schema = ", ".join(f"{k} {types[type(v)]}" for k, v in fields.items())
    return spark.createDataFrame([tuple(fields.values())], schema).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize("agent,tokens", [
    ("Mozilla/5.0 (Windows NT 6.1; WOW64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/37.0.2062.103 Safari/537.36",
     ["Mozilla", "AppleWebKit", "Chrome", "Safari"]),
    ('"Mozilla/5.0 [en] (X11)"', ["Mozilla"]), ("", []), ("like", []), ("like/1 x", ["like", "x"]), ("a (b [c) d] e", ["a", "d]", "e"]),
    ("  lead  and\ttabs\n", ["lead", "and", "tabs"]), ("/odd //x a/b/c", ["", "", "a"]),
    ("(never closed Opera/9", ["(never", "closed", "Opera"]), ("no\u00a0break space", ["no", "break", "space"]),
    ("line (split\nover) two", ["line", "(split", "over)", "two"]), ("sep\x1carator (a b) x", ["sep", "arator", "x"]),
])
def test_agent_tokens(spark, agent, tokens):
    assert value(spark, C.agent_tokens("s"), s=agent) == tokens


def test_agent_tokens_of_nothing(spark):
    assert value(spark, C.agent_tokens("s"), s=None) is None


@pytest.mark.parametrize("location,codes", [
    ("New York-Newark-Jersey City, NY-NJ-PA", ["NJ", "NY", "PA"]),
    ("Town, NY-NY", ["NY"]), ("A, B C -D, E", ["BC", "D"]), ("Nowhere", None), ("Trailing,", [""]), (None, None),
])
def test_state_codes(spark, location, codes):
    assert value(spark, C.state_codes("s"), s=location) == codes


@pytest.mark.parametrize("hour", range(24))
def test_day_part(spark, hour):
    part = 3 if hour in (0, 19, 20, 21, 22, 23) else 0 if hour <= 6 else 1 if hour <= 12 else 2
    assert value(spark, C.day_part("ms"), ms=START + hour * 3_600_000 + 3_599_999) == DAY_PARTS[part]


def test_day_part_of_no_time(spark):
    assert value(spark, C.day_part("cast(ms as bigint)"), ms=None) is None


def test_days(spark):
    assert value(spark, C.day_text("ms"), ms=START + DAY - 1) == "2024-01-01"
    assert value(spark, C.day_text("ms"), ms=-1) == "1969-12-31"
    age = C.days_until(F.expr("date'2024-01-11'"), C.event_day("ms"))
    assert value(spark, age, ms=START + 5) == 10


def test_days_follow_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert value(spark, C.day_text("ms"), ms=START) == "2023-12-31"
        assert value(spark, C.day_part("ms"), ms=START) == DAY_PARTS[3]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_song_title(spark):
    assert value(spark, C.song_title("a", "s"), a="x", s="y") == "x - y"
    assert value(spark, C.song_title("a", "s"), a=None, s="y") is None


def test_ratio_of_zeros(spark):
    assert value(spark, C.ratio("a", "b", "r"), a=0, b=0) is None
    assert value(spark, C.ratio("a", "b", "r"), a=1, b=4) == 0.25


def test_recency_orders_and_keeps_flags(spark):
    big = 2**62
    events = [
        (None, 5, 1), (-5, None, 0), (-5, 0, 3), (0, None, 0), (0, 0, 0), (0, 0, 2), (0, big, 1), (1, 0, 0),
        (START, 2**20 - 2, 3), (START, 2**20 - 1, 0), (START, 2**20, 1), (2**41 - 1, 7, 2), (2**41, 0, 3),
    ]
    rows = spark.createDataFrame(
        [(i, *event) for i, event in enumerate(events)], "i int, t bigint, n bigint, f int"
    )
    keyed = rows.selectExpr("i", "f", f"{C.recency_sql('t', 'n', 'f')} as key")
    ordered = keyed.orderBy("key").selectExpr("i", "f", f"{C.recency_flags_sql('key')} as g").collect()
    assert [r["i"] for r in ordered] == list(range(len(events)))
    assert all(r["f"] == r["g"] for r in ordered)
    # the aggregate agrees with the largest row key of every prefix of the events
    for size in range(1, len(events) + 1):
        some = rows.where(f"i < {size}")
        top = some.agg(F.expr(f"{C.latest_sql('t', 'n', 'f')} as top")).first()["top"]
        assert top == keyed.where(f"i = {size - 1}").first()["key"]


@pytest.mark.parametrize("millis", [2**63 - 1, -(2**63), C.LAST_MILLIS + 1, C.FIRST_MILLIS - 1])
def test_junk_epoch_values_are_missing(spark, millis):
    for column in (C.event_day("ms"), C.day_text("ms"), C.day_part("ms")):
        assert value(spark, column, ms=millis) is None


@pytest.mark.parametrize("time,item", [(2**63 - 1, 5), (-(2**63), 5), (START, 2**63 - 1), (START, -(2**63)), (None, None)])
def test_recency_of_any_numbers(spark, time, item):
    rows = spark.createDataFrame([(time, item), (START - 1, 3)], "t bigint, i bigint")
    best = rows.agg(F.expr(f"{C.latest_sql('t', 'i', '1')} as v")).first()["v"]
    keys = [r["k"] for r in rows.select(F.expr(f"{C.recency_sql('t', 'i', '1')} as k")).collect()]
    assert best == max(keys) and (max(keys) == keys[0]) == (time == START)
