"""Every query with SQL gives the same rows as DuckDB."""

import pytest

from atrium.plans.registry import ORACLE_SQL, QUERIES
from tests import oracle

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_same_rows(spark, con, name):
    assert oracle.difference(spark, con, QUERIES[name], ORACLE_SQL[name], SF) == ""


#: Held against plain Python in test_brute_force, test_memory and test_streams.
PLAIN = {
    "b12_error_boxes", "e21_optimal_pairs", "e22_global_links", "e23_assigned_costs", "e24_global_over_groups", "g42_hota", "g42_mota", "h20_live_identities", "h20_live_stream", "h22_undone_swaps", "h23_remembered_crops", "n1_frame_loop",
    "k1_constrained_merge", "k7_face_veto", "k11_fused_graph", "k12_greedy_replay", "k13_topology_comparison", "k19_resolved_identities", "k20_dossiers", "n5_forgotten_identities",
}


def test_the_rest_is_compared_elsewhere():
    assert set(QUERIES) - set(ORACLE_SQL) == PLAIN


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert e.queries().keys() >= e.oracle_sql().keys()
