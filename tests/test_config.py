import json

import pytest

from tidemill.__main__ import main
from tidemill.config import Request, Settings
from tidemill.operators import tables


def test_settings_stay_within_their_bounds():
    assert Settings.from_environment({}) == Settings()
    got = Settings.from_environment({"TIDEMILL_ANALYSIS_QUOTA_7_DAYS": "0", "TIDEMILL_LIST_PAGE_SIZE": " 5", "TIDEMILL_LIST_MAX_PAGES": "99999", "TIDEMILL_LIST_ATTEMPTS": "x"})
    assert got == Settings(analysis_quota_7_days=1, list_attempts=4, list_page_size=20, list_max_pages=3000)


@pytest.mark.parametrize("bad", [{"market": "us"}, {"ticker": " "}, {"lookback_days": 0}, {"lookback_days": 31}, {"window_start": "2025-01-02", "window_end": "2025-01-02"}])
def test_bad_requests_are_not_made(bad):
    with pytest.raises(ValueError):
        Request(**({"market": "cn", "ticker": "600519"} | bad))
    assert Request("hk", "00700", 30, "2025-01-01", "2025-01-02").lookback_days == 30


def test_command_line(spark, tmp_path, capsys):
    data = str(tmp_path / "data")
    spark.createDataFrame([(1, "click", '{"k": 5}')], "event_id int, event_type string, props string").write.parquet(f"{data}/events.parquet")
    assert main(["queries"]) == 0 and "json_props" in capsys.readouterr().out.split()
    assert main(["run", "json_props", "--data", data]) == 0 and json.loads(capsys.readouterr().out) == {"event_id": 1, "k": 5}
    spark.createDataFrame([], "event_id int, event_type string, props string").write.mode("overwrite").parquet(f"{data}/events.parquet")
    assert main(["run", "json_props", "--data", data, "--out", str(tmp_path / "out"), "--require-rows"]) == 2
    assert main(["run", "nothing", "--data", data]) == 1
    assert main(["init-tables", str(tmp_path / "db")]) == 0 and capsys.readouterr().out.split()[-1] == list(tables.SCHEMAS)[-1]
