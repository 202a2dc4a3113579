"""A run date is checked before readers see it."""

from dataclasses import replace

import pytest

from claimsmith.operators import quality as Q
from claimsmith.plans import pipeline as P
from claimsmith.sources import io
from tests import golden as G


@pytest.fixture
def staged(spark, tmp_path):
    for name, rows in G.SOURCES.items():
        G.write_csv(str(tmp_path / f"{name}.csv"), rows)
    cfg = P.PipelineConfig(root=str(tmp_path / "lake"), run_date="2025-02-01", seed=G.GOLDEN_SEED, fail_on_error=True,
                           sources={n: {"primary": str(tmp_path / f"{n}.csv")} for n in G.SOURCES})
    P.ingest(spark, cfg)
    P.run_transformations(spark, cfg, "staging")
    return cfg


def claims(spark, cfg):
    return sorted((r.claim_sk, r.claim_id, r.claim_status) for r in P.read_published(spark, cfg, "fact_claims").collect())


def test_a_failing_check_leaves_the_former_run_readable(spark, staged):
    with pytest.raises(FileNotFoundError, match="no published version"):
        P.read_published(spark, staged, "fact_claims")
    assert {r.status for r in P.audited_run(spark, staged).collect()} == {"PASS"}
    first, rows = P.published(spark, staged).version, claims(spark, staged)
    assert len(rows) == 126
    # Statuses that the next run does not allow: its check fails, its tables exist, readers see the first run.
    strict = replace(staged, allowed_status=("void",))
    with pytest.raises(Q.QualityCheckFailed, match="status"):
        P.audited_run(spark, strict)
    assert P.published(spark, staged).version == first and claims(spark, staged) == rows
    # Without the gate the failures are recorded and the version becomes current.
    P.audited_run(spark, replace(strict, fail_on_error=False))
    second = P.published(spark, staged)
    assert second.version > first and claims(spark, staged) == rows
    assert {r.table_name: r.row_count for r in P.curated_row_counts(spark, second).collect()}["fact_claims"] == 126
    # An open reader keeps its version; old versions can go, the current one can't.
    with pytest.raises(ValueError, match="current"):
        P.drop_version(spark, staged, second.version)
    P.drop_version(spark, staged, first)
    assert claims(spark, staged) == rows
    with pytest.raises(FileNotFoundError):
        io.read_run_partition(spark, replace(staged, version=first).curated_root, "fact_claims", staged.run_date)


def test_publications_of_dates_are_apart(spark, tmp_path):
    log = str(tmp_path / "log")
    assert io.published_versions(spark, log).count() == 0
    for date, version in (("2025-01-01", "v1"), ("2025-01-02", "v1"), ("2025-01-01", "v3"), ("2025-01-01", "v2")):
        io.publish_version(spark, log, date, version)
    assert io.current_version(spark, log, "2025-01-01") == "v3" and io.current_version(spark, log, "2025-01-02") == "v1"
    assert io.new_version() < io.new_version()
