"""A whole run over claims files: every table written, marts built once, failed checks raise and change nothing."""

import pytest
from test_claims_file import COLUMNS, FOUR_ROWS

from payerscope import session
from payerscope.operators import marts
from payerscope.plans import build
from payerscope.plans.run import QualityError, run_all
from payerscope.sources import sinks


def test_run_all_writes_everything_and_leaves_nothing_behind(spark, tmp_path, monkeypatch):
    (tmp_path / "claims.csv").write_text(FOUR_ROWS)
    out, built = str(tmp_path / "out"), []
    for name in marts.MARTS:
        once = build.WRITTEN_MARTS[name]
        monkeypatch.setitem(build.WRITTEN_MARTS, name, lambda s, name=name, once=once: built.append(name) or once(s))
    before = session.list_names(spark, session.shared_folder(spark))
    result = run_all(spark, str(tmp_path / "claims.csv"), out, 2025)
    assert session.list_names(spark, session.shared_folder(spark)) == before
    assert sorted(built) == sorted(marts.MARTS)
    assert len(result.checks) == 21 and {status for _, status, _, _ in result.checks} == {"PASS"}
    assert result.records["fact_claim"] == 4 and result.records["quality_report"] == 21 and result.kpis["claims"] == 4
    tables = sinks.read_tables(spark, out)
    assert set(marts.MARTS) | set(build.BASE_TABLES) <= set(tables) and tables["mart_high_cost_member"].count() == 3
    assert any(name.startswith("query_") for name in tables) and "model_high_cost_member_scores" in tables

    twice = FOUR_ROWS + FOUR_ROWS.splitlines()[1] + "\n"
    (tmp_path / "claims.csv").write_text(twice)
    with pytest.raises(QualityError, match="claim_id_unique"):
        run_all(spark, str(tmp_path / "claims.csv"), out, 2025)
    assert sinks.read_tables(spark, out)["fact_claim"].count() == 4
    assert session.list_names(spark, session.shared_folder(spark)) == before
    assert len(COLUMNS) == 20
