import json

import pytest

from barlake.operators.quality import (
    CriticalQualityError,
    date_gaps,
    quality_results,
    run_quality_checks,
)
from barlake.sources.warehouse import QualityReport, write_quality_report

from .conftest import QUALITY_COLUMNS, d


def frame(spark, rows, schema=QUALITY_COLUMNS):
    return spark.createDataFrame(rows, schema)


def test_valid_rows_pass(spark, two_valid_rows):
    res = run_quality_checks(frame(spark, two_valid_rows))
    assert res["overall_passed"] is True
    assert all(c["passed"] for c in res["checks"].values())
    assert len(res["checks"]) == 9


def test_duplicates_fail_without_error(spark, two_valid_rows):
    rows = [two_valid_rows[0], (*two_valid_rows[0][:2], *two_valid_rows[1][2:])]
    res = run_quality_checks(frame(spark, rows))
    assert res["checks"]["duplicate_rows"] == {"passed": False, "failures": 2}
    assert res["overall_passed"] is False


def test_negative_price_is_critical(spark, two_valid_rows):
    bad = list(two_valid_rows[0])
    bad[5] = -1.0
    with pytest.raises(ValueError, match="Critical quality checks failed"):
        run_quality_checks(frame(spark, [tuple(bad), two_valid_rows[1]]))


def test_negative_price_counts_cells_and_names_columns(spark, two_valid_rows):
    bad = list(two_valid_rows[0])
    bad[2], bad[5] = -1.0, -1.0
    res = run_quality_checks(frame(spark, [tuple(bad), two_valid_rows[1]]), raise_on_critical=False)
    neg = res["checks"]["negative_prices"]
    assert neg["failures"] == 2 and neg["columns"] == ["open_price", "close_price"]


def test_zero_price_passes(spark, two_valid_rows):
    ok = list(two_valid_rows[0])
    ok[2] = 0.0
    ok[4] = 0.0
    res = run_quality_checks(frame(spark, [tuple(ok), two_valid_rows[1]]))
    assert res["checks"]["negative_prices"]["passed"]


def test_price_relationships(spark, two_valid_rows):
    bad = list(two_valid_rows[0])
    bad[4] = 999.0
    res = run_quality_checks(frame(spark, [tuple(bad), two_valid_rows[1]]))
    assert not res["checks"]["price_relationships"]["passed"]
    assert res["checks"]["price_relationships"]["failures"] >= 1


def test_null_operands_do_not_fail_relationships(spark, two_valid_rows):
    bad = list(two_valid_rows[0])
    bad[2] = None
    res = run_quality_checks(frame(spark, [tuple(bad), two_valid_rows[1]]))
    assert res["checks"]["price_relationships"]["passed"]


def test_lower_case_ticker_format(spark, two_valid_rows):
    bad = ("aapl", *two_valid_rows[0][1:])
    res = run_quality_checks(frame(spark, [bad, two_valid_rows[1]]))
    assert not res["checks"]["invalid_ticker_format"]["passed"]
    assert res["checks"]["invalid_ticker_format"]["examples"] == ["aapl"]


def test_null_and_blank_ticker_are_critical(spark, two_valid_rows):
    with pytest.raises(ValueError, match="null_tickers"):
        run_quality_checks(frame(spark, [(None, *two_valid_rows[0][1:]), two_valid_rows[1]]))
    res = run_quality_checks(
        frame(spark, [("  ", *two_valid_rows[0][1:]), two_valid_rows[1]]), raise_on_critical=False
    )
    assert res["checks"]["null_tickers"]["failures"] == 1


def test_null_dates_are_critical(spark, two_valid_rows):
    with pytest.raises(CriticalQualityError) as err:
        run_quality_checks(frame(spark, [("AAPL", None, *two_valid_rows[0][2:]), two_valid_rows[1]]))
    assert err.value.failed == ["null_dates"]


def test_date_gaps_more_than_five_days(spark):
    rows = [
        ("AAPL", d(2026, 1, 1), 1.0, 1.0, 1.0, 1.0, 1.0, 1),
        ("AAPL", d(2026, 1, 6), 1.0, 1.0, 1.0, 1.0, 1.0, 1),  # 5 days: fine
        ("AAPL", d(2026, 1, 13), 1.0, 1.0, 1.0, 1.0, 1.0, 1),  # 7 days: gap
        ("MSFT", d(2026, 1, 1), 1.0, 1.0, 1.0, 1.0, 1.0, 1),  # single row: skipped
        (None, d(2026, 3, 1), 1.0, 1.0, 1.0, 1.0, 1.0, 1),
    ]
    gaps = date_gaps(frame(spark, rows)).collect()
    assert [(g.ticker, g.gap_after, g.gap_calendar_days) for g in gaps] == [("AAPL", d(2026, 1, 6), 7)]


def test_fractional_volume_column_type(spark, two_valid_rows):
    schema = QUALITY_COLUMNS.replace("volume bigint", "volume double")
    rows = [(*two_valid_rows[0][:7], 10.5), (*two_valid_rows[1][:7], 3.0)]
    res = run_quality_checks(frame(spark, rows, schema))
    assert res["checks"]["column_types"]["failures"] == 1
    assert res["checks"]["column_types"]["issues"] == ["volume contains non-integer float values"]


def test_missing_columns(spark):
    df = spark.createDataFrame([("A",)], "ticker string")
    with pytest.raises(ValueError, match="need columns"):
        quality_results(df)


def test_report_json(spark, two_valid_rows, tmp_path):
    res = run_quality_checks(frame(spark, two_valid_rows))
    rep = QualityReport("test-batch-123", 2, 2, 0, 1.2345, res["checks"], res["overall_passed"])
    path = write_quality_report(spark, rep.document(), str(tmp_path))
    assert "test-batch-123" in path
    data = json.loads(open(path).read())
    for key in ("batch_id", "rows_extracted", "rows_inserted", "rows_skipped", "checks",
                "overall_passed", "execution_time_seconds"):
        assert key in data
    assert data["execution_time_seconds"] == 1.234 or data["execution_time_seconds"] == 1.235
    assert data["overall_passed"] is True
