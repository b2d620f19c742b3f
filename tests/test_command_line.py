import pytest

from sievelake.__main__ import months, parser


def test_months_cross_years():
    assert months((2024, 11), (2025, 2)) == [(2024, 11), (2024, 12), (2025, 1), (2025, 2)]
    assert months((2025, 1), (2025, 8)) == [(2025, month) for month in range(1, 9)]
    assert months((2025, 2), (2025, 1)) == []


def test_options():
    options = parser().parse_args(["series", "--first", "2025-01", "--last", "2025-08", "--lake", "s3a://b"])
    assert (options.first, options.last, options.lake, options.table) == ((2025, 1), (2025, 8), "s3a://b", None)
    assert parser().parse_args(["single", "--period", "2025-02"]).period == (2025, 2)


def test_bad_month_is_refused(capsys):
    with pytest.raises(SystemExit):
        parser().parse_args(["single", "--period", "2025-13"])
    assert "2025-13" in capsys.readouterr().err
