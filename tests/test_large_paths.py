"""The ways taken beyond the size checks give the same rows.

Every size check fails here and a few rows already fill a task, so joins are
shuffled, hot keys are split off and numbering runs per range.
"""

import pytest

from tests import test_oracle
from tests.test_oracle import QUERIES, SQL, canonical
from tidemark.functions import ranges
from tidemark.operators import joins, latest, scd2, upsert
from tidemark.sinks import tables as tables_module

con = test_oracle.con


@pytest.mark.parametrize(
    "name",
    [
        "upsert_columns", "upsert_fact", "update_matched", "scd2_apply", "scd2_apply_compat", "scd2_rebuild",
        "surrogate_key", "lead_next", "latest_flag", "latest_flag_end_ts", "latest_flag_successor_end",
        "table_delete", "join_generated", "join_changed", "code_table_encode", "pending_tables",
        "upsert_partitioned_nulls", "replace_by_bu_nulls_frames", "gold_dim_null_keys", "code_table_encode_nulls", "ml_roc_points", "ml_area_under_roc",
    ],
)
def test_matches_sql_without_broadcast(spark, tables, con, monkeypatch, name):
    for module in (joins, latest, scd2, upsert):
        monkeypatch.setattr(module, "fits_broadcast", lambda df: False)
    monkeypatch.setattr(ranges, "ROWS_PER_BUCKET", 20)
    monkeypatch.setattr(tables_module, "MAX_TOUCHED", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = QUERIES[name](spark, tables)
        got = canonical(df.columns, df.collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    result = con.execute(SQL[name])
    assert got == canonical([c[0] for c in result.description], result.fetchall())
