"""The command line runs the stages and the lookups."""

import contextlib
import io

from finlake.__main__ import main
from finlake.session import run_dir


def test_cli_all_then_lookups(spark, sf_dir):
    root = run_dir(spark, "t-cli")
    assert main(["all", "--root", root, "--sf-dir", sf_dir]) == 0
    assert main(["silver", "--root", root]) == 0  # nothing new: a no-op
    assert main(["gold", "--root", root]) == 0
    assert main(["publish", "--root", root]) == 0
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        main(["lookup", "costs-daily", "--root", root, "--org", "8",
              "--services", "genai,storage", "--start", "2024-01-05", "--end", "2024-01-25"])
        main(["lookup", "top-months", "--root", root, "--org", "8", "--n", "3"])
        main(["lookup", "monthly-revenue", "--root", root, "--org", "8", "--year", "1995"])
    text = out.getvalue()
    assert "daily_cost_usd" in text and "revenue_usd" in text
