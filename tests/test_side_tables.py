import pytest

from surgeline.functions import exprs
from surgeline.operators import explore
from surgeline.sources import side_tables as S


def write(tmp_path, text):
    path = tmp_path / "table.csv"
    path.write_text(text)
    return str(path)


EVENTS = "event_date,event_end_date,event_type,event_name,description,affected_compute_types,affected_segments,magnitude\n"


def test_lists_dates_and_quotes(spark, tmp_path):
    path = write(tmp_path, EVENTS + '2000-01-31,2000-02-01,spike,"Close, all",x,A; B ;C,All,+1.8x\n2000-03-01,,churn,Left,y,,"x;y",\n')
    table = S.read_side_table(spark, path, "event_log")
    rows = {r.event_name: r for r in table.rows.collect()}
    assert rows["Close, all"].affected_compute_types == ["A", "B", "C"] and str(rows["Close, all"].event_date) == "2000-01-31"
    assert rows["Left"].event_end_date is None and rows["Left"].affected_compute_types == [] and rows["Left"].magnitude == []
    assert table.rejected.collect() == []


def test_rows_that_do_not_fit_are_kept_apart(spark, tmp_path):
    head = "event_name,expected_date,compute_type,customer_segment,estimated_daily_hours,probability,notes\n"
    good = "Deal,2000-05-01,A,x,12.5,0.9,\n"
    bad = ["Month 13,2000-13-01,A,x,1,0.5,n\n", "Letters,2000-05-01,A,x,many,0.5,n\n", "Short,2000-05-01\n"]
    table = S.read_side_table(spark, write(tmp_path, head + good + "".join(bad)), "pipeline")
    assert [(r.event_name, r.estimated_daily_hours) for r in table.rows.collect()] == [("Deal", 12.5)]
    assert sorted(r[S.REJECTED] for r in table.rejected.collect()) == sorted(b.strip() for b in bad)


@pytest.mark.parametrize("head", ["date\n", "date,name\n", "holiday_name,date\n"])
def test_a_header_without_the_columns_stops_the_read(spark, tmp_path, head):
    with pytest.raises(Exception, match="(?i)header"):
        S.read_side_table(spark, write(tmp_path, head + "2000-01-01,New Year\n"), "holidays").rows.collect()


def test_empty_file_with_a_header(spark, tmp_path):
    table = S.read_side_table(spark, write(tmp_path, "date,holiday_name\n"), "holidays")
    assert table.rows.collect() == [] and table.rows.columns == ["date", "holiday_name"]


def test_written_and_read_again(spark, tmp_path):
    rows = [("2000-01-01", None, "spike", "a", "d", ["A", "B"], ["x"], ["+1x", "-2x"])]
    df = spark.createDataFrame(rows, "event_date string, event_end_date date, event_type string, event_name string, description string, affected_compute_types array<string>, affected_segments array<string>, magnitude array<string>")
    df = df.withColumn("event_date", df.event_date.cast("date"))
    S.write_side_table(df, str(tmp_path / "log"), "event_log")
    assert S.read_side_table(spark, str(tmp_path / "log"), "event_log").rows.collect() == df.collect()


def test_labels(spark):
    row = spark.createDataFrame([(1234567.0, -3.25)], "a double, b double").select(exprs.kilo("a"), exprs.signed_percent("b")).first()
    assert tuple(row) in {("1,235K", "-3.3%"), ("1,235K", "-3.2%")}


def test_too_many_members_are_refused(spark):
    daily = spark.range(explore.MEMBERS + 1).selectExpr("DATE'2000-01-01' AS date", "CAST(id AS STRING) AS compute_type", "1.0 AS compute_hours")
    with pytest.raises(ValueError, match="members"):
        explore.type_correlation(daily)
