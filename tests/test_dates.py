from datetime import datetime

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from noticeflow.functions import dates

T = F.col("t")


def _python(value, fmt):
    try:
        return datetime.strptime(value, fmt)
    except ValueError:
        return None


GIVEN = [
    "2021/03/1512:30", "2021/3/512:30", "2021/3/5 7:4", "2021/03/05 07:04", "2021-03-05 10:00:00",
    "2021-03-05 10:00", "2021/13/05 10:00", "2021/02/30 10:00", "2021/03/05  10:00", "2021/03/05 10:00 ",
    "2021/03/05", "", "x", "2021/03/ 5 10:00", "2021/3/112:30", "0000/01/01 10:00", "2021/01/01 24:00",
    "2021-03-05 10:00:60", "2021-03-05T10:00:00", "99/01/01 10:00", "2021/03/05 1:2:3",
]
FORMATS = [
    dates.CREATED, dates.MODIFIED, dates.ISO_SECONDS, dates.ISO_MINUTES, dates.SLASH_SECONDS,
]


def test_parse_agrees_with_strptime(evaluate):
    got = evaluate(GIVEN, *[dates.parse(T, f) for f in FORMATS])
    assert got == [tuple(_python(g, f) for f in FORMATS) for g in GIVEN]


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.from_regex(r"\A20[0-9]{2}[/-][0-3]?[0-9][/-][0-3]?[0-9] ?[0-2]?[0-9]:[0-6]?[0-9]\Z"), min_size=5))
def test_parse_agrees_with_strptime_on_near_dates(evaluate, texts):
    got = evaluate(texts, *[dates.parse(T, f) for f in FORMATS])
    assert got == [tuple(_python(t, f) for f in FORMATS) for t in texts]


def test_two_formats_row_by_row(evaluate):
    got = evaluate(["2021-03-05 10:00:01", "2021-03-05 10:00", "no"], dates.parse_column("Vigencia", T))
    assert got == [datetime(2021, 3, 5, 10, 0, 1), datetime(2021, 3, 5, 10, 0), None]


def test_window_label_and_stamp(evaluate):
    at = dates.moment("2021-03-01 05:59:59")
    label = dates.run_partition(at)
    got = evaluate(
        ["x"], dates.midnight_before("2021-03-01 05:59:59", 1), label["year"], label["month"],
        dates.log_stamp(at),
    )
    assert got == [(datetime(2021, 2, 28), "2021", "02", "20210301 05:59:59")]
