"""A cross-section of the registered queries against their oracle on the smallest data.
``tests/oracle.py`` compares all of them."""

from __future__ import annotations

import pytest

import oracle
from strataline.suite.all import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
SAMPLE = ("typed_staging", "stable_surrogate", "ordered_surrogate", "dedupe_latest", "dup_surplus", "vault_link",
          "dq_results", "dq_monthly_results", "scd2_build", "replay_months", "fact_trusted", "kpi_movement",
          "recon_three_state")


@pytest.fixture(scope="module")
def connection():
    return oracle.connect(FOLDER)


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_its_oracle(spark, connection, name):
    assert oracle.compare(QUERIES[name](spark, FOLDER), connection, ORACLES[name]) is None


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
