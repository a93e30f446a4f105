"""Hot-key paths give the same answers as the plain windows.

With the per-key limit lowered to a few rows, most patients count as "hot",
so their visits go through the bucketed global order and the halo blocks."""

import pytest

from admitlab.oracle.compare import compare, duck
from admitlab.oracle.registry import oracle_sql
from admitlab.operators.sequence import hot_keys
from admitlab.plans import intervals
from admitlab.plans.registry import jobs
from admitlab.sources.tables import encounters
from sf_dirs import SF_SMALL

PER_PATIENT = ["visit_gap", "visit_gap_context", "revisit_detail", "frequent_flyers", "care_episodes",
               "gap_distribution_5", "bill_delta", "bill_trends", "visit_sequence"]


@pytest.fixture
def low_limit(monkeypatch):
    monkeypatch.setattr(intervals, "MAX_ROWS_PER_KEY", 9)


def test_hot_keys_exact(spark):
    enc = encounters(spark, SF_SMALL)
    hot = hot_keys(enc, "patient_key", 9)
    counts = {r[0]: r[1] for r in enc.groupBy("patient_key").count().collect()}
    assert hot == sorted(k for k, c in counts.items() if c > 9)
    assert hot  # the fixture has patients with more than 9 visits


@pytest.mark.parametrize("key", PER_PATIENT)
def test_hot_path_matches_oracle(spark, low_limit, key):
    r = compare(key, jobs()[key](spark, SF_SMALL), duck(SF_SMALL), oracle_sql()[key])
    assert r.ok and r.exact, r.detail
